"""Rows that break a rule, kept with the rules they break instead of being dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadcycle.sources import versions

KEPT, QUARANTINED, BROKEN = "kept", "quarantined", "broken"

Rules = Mapping[str, Column]


def judged(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows with a list of the rules each breaks, in the order of the rules.

    A rule is a condition; as in a filter, one that is null is broken.
    """
    marks = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    found = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return df.withColumn(BROKEN, found)


def rule_counts(df: DataFrame) -> DataFrame:
    """rule, rows: how many of the judged rows break each rule that any breaks."""
    return df.select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def write_judged(df: DataFrame, rules: Rules, path: str) -> dict[str, int]:
    """Writes kept and quarantined rows in one pass over them, and gives the number of rows that break each rule.

    Both are committed together with the counts (also ``rows`` and ``kept``, of all rows), so no reader sees one without the other.
    """
    spark, seen = df.sparkSession, Observation()
    rows = judged(df, rules)
    counts = [F.count_if(F.array_contains(BROKEN, name)).alias(f"r{i}") for i, name in enumerate(rules)]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(BROKEN) == 0).alias("kept"), *counts)
    folder = versions.stage_part(rows.withColumn("__kept", F.size(BROKEN) == 0), path, "all", partition_by=["__kept"])
    found = seen.get
    told = {"rows": found["rows"], "kept": found["kept"]} | {name: found[f"r{i}"] for i, name in enumerate(rules)}
    # a folder is there only if a row went into it
    parts = {KEPT: f"{folder}/__kept=true" if found["kept"] else None}
    parts[QUARANTINED] = f"{folder}/__kept=false" if found["rows"] > found["kept"] else None
    versions.commit(spark, path, parts, rows.schema, {KEPT: told, QUARANTINED: told}, whole=True)
    return told


def kept(spark: SparkSession, path: str) -> DataFrame:
    """The rows that break no rule, as they came."""
    return versions.read(spark, path, [KEPT]).drop(BROKEN)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The other rows, each with the rules it breaks."""
    return versions.read(spark, path, [QUARANTINED])
