"""The daily run: each layer is read from the table below it and written as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from loadcycle.operators import facts, quarantine
from loadcycle.plans.presentation import presentation
from loadcycle.plans.raw import haul_cycles
from loadcycle.plans.stage import SLICE_BY, StageOptions, judged_stage, stage_cycles
from loadcycle.sources.scratch import own_scratch
from loadcycle.sources.tables import read_table, write_table

LOAD_START = "tiempo_inicio_carga_carguio"


def write_raw(tables: Mapping[str, DataFrame], path: str, low, high, mode: str = "overwrite", fmt: str = "parquet", **how) -> None:
    """The wide cycles, and beside them what the stage must know of all of them, counted on the way.

    Scratch tables made for them go when they are written.
    """
    spark = next(iter(tables.values())).sparkSession
    before = facts.load(spark, path) if mode == "append" else None
    with own_scratch(spark):
        observed = facts.Observed(haul_cycles(tables, low, high, **how), SLICE_BY)
        write_table(observed.rows, path, mode, fmt)
    found = observed.facts()
    facts.save(spark, path, found if before is None else before.plus(found, spark))


def write_stage(
    spark: SparkSession, raw: str, path: str, options: StageOptions = StageOptions(), mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Each file is sorted by load start; readers that filter on it skip row groups."""
    with own_scratch(spark):
        stage = stage_cycles(read_table(spark, raw, fmt), options, facts.load(spark, raw))
        write_table(stage, path, mode, fmt, sort_by=[LOAD_START] if LOAD_START in stage.columns else [])


def write_judged_stage(spark: SparkSession, raw: str, path: str, options: StageOptions = StageOptions(), fmt: str = "parquet") -> dict[str, int]:
    """The stage layer and, beside it, the cycles it leaves out with the rules they break (``quarantine.kept``, ``.quarantined``).

    One pass writes both; the number of cycles that break each rule comes back.
    """
    with own_scratch(spark):
        df, rules = judged_stage(read_table(spark, raw, fmt), options, facts.load(spark, raw))
        return quarantine.write_judged(df, rules, path)


def write_presentation(spark: SparkSession, stage: str, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    write_table(presentation(read_table(spark, stage, fmt)), path, mode, fmt)


def run(
    tables: Mapping[str, DataFrame], folder: str, low, high, options: StageOptions = StageOptions(), fmt: str = "parquet", **how
) -> DataFrame:
    """All three layers of the cycles between the bounds, below ``folder``; returns the presentation table."""
    spark = next(iter(tables.values())).sparkSession
    raw, stage, shown = (f"{folder.rstrip('/')}/{layer}" for layer in ("raw", "stage", "presentation"))
    with own_scratch(spark):
        write_raw(tables, raw, fmt=fmt, low=low, high=high, **how)
        write_stage(spark, raw, stage, options, fmt=fmt)
        write_presentation(spark, stage, shown, fmt=fmt)
    return read_table(spark, shown, fmt)
