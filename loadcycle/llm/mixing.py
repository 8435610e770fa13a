"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source gets a target number of words; each document an expected number of copies. The whole part of that number
is certain. For the rest, documents are ranked by their random odds divided by their inclusion odds, and the first
ones are taken until the source's target is met: an unequal-probability sample of fixed size, measured in words.
The place in the ranking where a source is full is found in two rounds of sums over 1,024 ranges of the rank and one
window over a single cell, so no source is sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcycle.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 1024


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: str, text: str, seed: str) -> Column:
    """A number between 0 and 1 that depends on the id and the seed (without an id: on the text) and on nothing else."""
    who = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(F.lit(seed), who).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _same(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """Inner join in which null matches null; the right side's keys go."""
    renamed = right.select(*[F.col(c).alias(f"__{c}" if c in names else c) for c in right.columns])
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"__{n}"))
    return left.join(renamed, on).drop(*[f"__{n}" for n in names])


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """source, source_size, target. One row per source goes through one window, never the documents.

    The sources, by code point and null last, weigh as ``weights`` say, again and again. They share ``share`` times
    all sizes; none gets more than ``most`` times its own, and what it leaves goes to the others by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    rows = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    full_first = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = F.coalesce(F.sum("cap").over(full_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(full_first.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) * F.lit(share) - before) / rest)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(
        full_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def _levels(rows: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """source, favour, whole, part, need: copies for sure, the chance of one more, and the words still to be found."""
    sums = _same(rows.groupBy("source", "favour").agg(F.sum("size").alias("words")), goals, "source")
    by = Window.partitionBy("source").orderBy(F.col("favour").desc())
    before = F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * F.lit(most)
    rest = F.sum(F.col("favour") * F.col("words")).over(by.rowsBetween(0, Window.unboundedFollowing))
    scale = F.when(rest > 0, (F.col("target") - before) / rest)
    sums = sums.withColumn("scale", scale)
    fits = F.when(F.col("scale") * F.col("favour") <= F.lit(most), F.col("scale"))
    chosen = F.first(fits, ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    copies = F.least(F.lit(float(most)), F.coalesce(chosen * F.col("favour"), F.lit(float(most))))
    sums = sums.withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0.0)))
    sums = sums.withColumn("whole", F.floor("copies")).withColumn("part", F.col("copies") - F.floor("copies"))
    certain = F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("source"))
    return sums.withColumn("need", F.col("target") - certain).select("source", "favour", "whole", "part", "need")


def _rank(u: Column, part: Column) -> Column:
    """Random odds over inclusion odds."""
    return F.when((part > 0) & (part < 1), (u / (1 - u)) / (part / (1 - part)))


def _cell(rank: Column) -> Column:
    return F.floor(rank / (1 + rank) * F.lit(float(CELLS * CELLS)))


def mixing_plan(
    df: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix-1",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", favour_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The documents' narrow rows (doc_id, source, size, favour, u) and one row per source and favour.

    The second has source_size, target, whole, part and the place where the source is full (x, full_rank, full_id):
    a document takes ``whole`` copies and one more if its rank is not beyond that place. ``favour_col`` holds
    positive relative chances of the documents in a source, in a moderate number of distinct values (null: 1).

    Null texts have size 0 and take nothing that counts; null sources form a source of their own, the last one. Rows
    that share an id share their random number and are taken together. The same input gives the same mix always.
    A very long text is one number, its size. Other columns, of any name, are passed over. An empty table gives two empty tables.
    """
    favour = F.coalesce(F.col(favour_col).cast("double"), F.lit(1.0)) if favour_col else F.lit(1.0)
    rows = cut(df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        word_count(text_col).alias("size"), favour.alias("favour"), uniform(id_col, text_col, seed).alias("u"),
    ), "mix-rows")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goals = cut(goals, "mix-goals")
    levels = cut(_levels(rows, goals, most), "mix-levels")
    ranked = _same(rows, levels, "source", "favour").filter("part > 0 and need > 0").select(
        "source", "size", "need", _rank(F.col("u"), F.col("part")).alias("rank"),
        F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("id"),
    )
    ranked = ranked.withColumn("x", _cell(F.col("rank"))).withColumn("x1", F.floor(F.col("x") / CELLS))

    def full(cells: DataFrame, by: str, base: Column) -> DataFrame:
        """Of the cells, the first in which the source is full, and the words before it."""
        run = Window.partitionBy("source").orderBy(by)
        cells = cells.withColumn("before", base + F.sum("words").over(run) - F.col("words"))
        cells = cells.withColumn("last", F.lead(by).over(run).isNull()).filter(F.col("before") < F.col("need"))
        return cells.filter((F.col("before") + F.col("words") >= F.col("need")) | F.col("last"))

    wide = ranked.groupBy("source", "need", "x1").agg(F.sum("size").alias("words"))
    wide = full(wide, "x1", F.lit(0)).select("source", "x1", F.col("before").alias("base"))
    near = _same(ranked, wide, "source", "x1")
    narrow = near.groupBy("source", "need", "base", "x").agg(F.sum("size").alias("words"))
    narrow = full(narrow, "x", F.col("base")).select("source", "x", F.col("before").alias("so_far"))
    inside = _same(ranked, narrow, "source", "x")
    run = Window.partitionBy("source").orderBy("rank", "id")  # rows equal in both count as one
    unit = F.sum("size").over(Window.partitionBy("source", "rank", "id"))
    after = F.col("so_far") + F.sum("size").over(run)
    place = F.when(after - unit / 2 <= F.col("need"), F.struct("rank", "id"))
    ends = inside.withColumn("place", place).groupBy("source").agg(
        F.max("x").alias("x"), F.max("place.rank").alias("full_rank"), F.max("place").alias("place")
    ).select("source", "x", "full_rank", F.col("place.id").alias("full_id"))
    renamed = ends.select(F.col("source").alias("__s"), "x", "full_rank", "full_id")
    plan = _same(levels.drop("need"), goals, "source").join(renamed, F.col("source").eqNullSafe(F.col("__s")), "left")
    return rows, cut(plan.drop("__s"), "mix-plan")


def _copies(u: Column, doc_id: Column, plan: str = "") -> Column:
    """How often the mix takes a document; ``plan`` is the struct that holds the plan's columns, if any."""
    whole, part, x, end, end_id = (F.col(plan + c) for c in ("whole", "part", "x", "full_rank", "full_id"))
    rank, id_ = _rank(u, part), F.coalesce(doc_id, F.lit((1 << 63) - 1))
    cell = _cell(rank)
    in_time = (cell < x) | ((cell == x) & ((rank < end) | ((rank == end) & (id_ <= end_id))))
    return (whole + F.when(in_time, 1).otherwise(0)).cast("int")


def mix_report(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken, one row per document."""
    both = _same(rows, plan, "source", "favour")
    both = both.withColumn("copies", _copies(F.col("u"), F.col("doc_id")))
    return both.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed rows: each document as often as the mix takes it, with its own columns. Texts are not shuffled."""
    seed, favour = how.get("seed", "mix-1"), how.get("favour_col")
    _, plan = mixing_plan(df, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    plan = plan.select(
        F.col("source").alias("__source"), F.col("favour").alias("__favour"),
        F.struct("whole", "part", "x", "full_rank", "full_id").alias("__plan"),
    )
    own = F.coalesce(F.col(favour).cast("double"), F.lit(1.0)) if favour else F.lit(1.0)
    both = df.withColumn("__own", own).join(
        plan, F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__favour"))
    )
    copies = _copies(uniform(id_col, text_col, seed), F.col(id_col).cast("long"), "__plan.")
    repeated = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return both.withColumn("__copies", copies).filter("__copies > 0").withColumn("__copy", repeated).select(*df.columns)
