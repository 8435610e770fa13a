"""Exact duplicates, combined in three steps that all compare whole texts.

Texts are equal when they agree after every character of ``[\\x20\\x09-\\x0D]`` is deleted. Equal texts of one task are
combined before anything moves; what is left meets by digest; digests that hold a large share of all rows are dealt
over salts by the task they come from, and the winners of the salts meet last. The whole text is a grouping key in
each step, so a digest that two texts share never joins them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcycle.llm.common import ROW_HASH, cut, join_hot, keep_rows, per_text, row_hash

_SPACE = b" \t\n\x0b\x0c\r"

#: A digest with more than one in so many rows is dealt over salts; so there are at most that many of them.
HOT_SHARE = 1024
SALTS = 64


def sha256_hex(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def _facts(df: DataFrame, digest: Callable[[bytes], str], id_col: str, text_col: str) -> DataFrame:
    """doc_id, text hash, code points and digest of each row."""
    rows = df.select(
        F.col(id_col).alias("doc_id"), row_hash(text_col).alias(ROW_HASH),
        F.coalesce(F.length(F.col(text_col)), F.lit(0)).alias("n"), F.col(text_col).alias("text"),
    )

    def make():
        return lambda text: (digest((text or b"").translate(None, _SPACE)),)

    return per_text(rows, make, "digest string", id_col="doc_id", text_col="text", keep=[ROW_HASH, "n"])


def _contents(df: DataFrame, digest: Callable[[bytes], str], id_col: str, text_col: str) -> DataFrame:
    """doc_id, text hash, code points, digest and the text without white space."""

    def make():
        def one(text: bytes | None) -> tuple:
            content = (text or b"").translate(None, _SPACE)
            return digest(content), content

        return one

    rows = df.select(
        F.col(id_col).alias("doc_id"), row_hash(text_col).alias(ROW_HASH),
        F.coalesce(F.length(F.col(text_col)), F.lit(0)).alias("n"), F.col(text_col).alias("text"),
    )
    return per_text(
        rows, make, "digest string, content binary", id_col="doc_id", text_col="text", keep=[ROW_HASH, "n"]
    )


def _best():
    """The longest original, then the smallest id; a row without an id comes after those with one."""
    return F.struct((-F.col("n")).alias("minus_n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))


def duplicate_classes(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], str] = sha256_hex
) -> DataFrame:
    """One row per input row: doc_id, __row_hash, digest, keep_id, group_size and kept.

    Null texts count as empty, and empty texts are equal to each other. A null id loses against any id. Of rows that
    repeat in id and length, the one with the smallest text hash is kept, so each class keeps one row; rows that
    repeat in everything are told apart by nothing, and exactly one of them has ``kept``. An empty table gives none.
    """
    facts = cut(_facts(df, digest, id_col, text_col), "dedup-facts")
    total = facts.count()
    hot = facts.groupBy("digest").count().filter(F.col("count") > total / HOT_SHARE + 1).select("digest")
    hot = cut(hot, "dedup-hot")
    contents = _contents(df, digest, id_col, text_col).join(
        F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left"  # at most HOT_SHARE rows
    )
    salt = F.when(F.col("hot"), F.spark_partition_id() % SALTS).otherwise(F.lit(-1))
    merged = (
        contents.withColumn("salt", salt).groupBy("digest", "salt", "content")
        .agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("rows"))
        # from here on only the hot contents are compared again
        .select("digest", "salt", "best", "rows", F.when(F.col("salt") >= 0, F.col("content")).alias("content"))
    )
    merged = cut(merged, "dedup-merged")
    combined = (
        merged.filter("salt >= 0").groupBy("digest", "content")
        .agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))
    )
    winners = combined.select("digest", "best", "rows").unionByName(
        merged.filter("salt < 0").select("digest", "best", "rows")
    )
    shared = winners.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():  # every digest stands for one text
        found = join_hot(facts, winners, "digest", hot)
    else:
        shared = cut(shared, "dedup-shared")
        alone = join_hot(facts, winners.join(shared, "digest", "left_anti"), "digest", hot)
        texts = cut(_contents(df, digest, id_col, text_col).join(shared, "digest", "left_semi"), "dedup-collided")
        classes = texts.groupBy("digest", "content").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("rows"))
        found = alone.unionByName(texts.join(classes, ["digest", "content"]).drop("content"))
    first = Window.partitionBy("doc_id", "digest", "n").orderBy(ROW_HASH)
    return found.select(
        "doc_id", ROW_HASH, "digest", F.col("best.id").alias("keep_id"), F.col("rows").alias("group_size"),
        (
            F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("n") == -F.col("best.minus_n"))
            & (F.row_number().over(first) == 1)
        ).alias("kept"),
    )


def deduplicate(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = duplicate_classes(df, id_col=id_col, text_col=text_col).filter("kept")
    return keep_rows(df, kept, id_col, text_col)


