"""Records of quoted CSV files, found by many tasks.

A line break ends a record if the quotes before it, from the beginning of the file, are even in number. The lines of each piece of a
file, some thousands of lines of a block, are counted by themselves; a running sum over the pieces, a row each, tells every piece
whether it begins inside a quoted field and which record goes on in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_WHERE = ["file", "block", "piece"]

#: Lines that one group holds at the most, so that no task needs a whole block at once.
LINES = 1 << 14


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the block the file was cut at, its piece and place and the number of its quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"),
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes"),
    )
    # a task reads its blocks from first to last line, so pieces follow each other as their lines do
    return lines.withColumn("piece", F.floor(F.col("line") / LINES))


def _pieces(lines: DataFrame) -> DataFrame:
    """A row per piece: whether it begins inside a quoted field."""
    sums = lines.groupBy(*_WHERE).agg(F.sum("quotes").alias("quotes"))
    before = W.partitionBy("file").orderBy("block", "piece").rowsBetween(W.unboundedPreceding, -1)
    return sums.select(*_WHERE, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("open"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, number, record: every record with its line breaks; numbers count from 1 in the block it begins in.

    A group of lines in one task is a piece, or the lines of one record.
    """
    lines = _lines(spark, path)
    here = W.partitionBy(*_WHERE).orderBy("line")
    earlier = F.coalesce(F.sum("quotes").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = lines.join(_pieces(lines), _WHERE).withColumn("begins", ((F.col("open") + earlier) % 2 == 0).cast("int"))
    marked = marked.withColumn("number", F.sum("begins").over(here.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # a piece's records count on from those of the block's pieces before it; its lines before its first record belong to
    # the last record that began in a piece before it
    ends = marked.groupBy(*_WHERE).agg(F.max("number").alias("own"))
    so_far = W.partitionBy("file", "block").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("passed", F.coalesce(F.sum("own").over(so_far), F.lit(0)))
    before = W.partitionBy("file").orderBy("block", "piece").rowsBetween(W.unboundedPreceding, -1)
    last = F.struct(F.col("block").alias("block"), (F.col("passed") + F.col("own")).alias("number"))
    owner = F.last(F.when(F.col("own") > 0, last), True)
    owners = ends.select(*_WHERE, "passed", owner.over(before).alias("owner"))
    begun = F.struct(F.col("block").alias("block"), (F.col("passed") + F.col("number")).alias("number"))
    whole = marked.join(owners, _WHERE).select(
        "file", F.col("block").alias("at"), "line", "text", F.when(F.col("number") > 0, begun).otherwise(F.col("owner")).alias("of"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line", "text"))), lambda x: x["text"]), "\n")
    return whole.groupBy("file", "of").agg(joined.alias("record")).select("file", "of.block", "of.number", "record")
