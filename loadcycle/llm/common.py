"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.sources.scratch import cut, scratch_path, together

__all__ = [
    "cut", "scratch_path", "together", "columns", "per_text", "per_texts", "row_hash", "keep_rows", "join_hot", "fold", "sampled", "small_batches",
    "tables",
]

ROW_HASH = "__row_hash"

#: Whole texts that one Arrow batch may hold. Spark's own 10,000 would be a gigabyte of texts of 100 kB, several times over
#: in the buffers of executor and worker.
BATCH_TEXTS = 1000

#: Salts over which a class is dealt when a sample of it is taken.
SAMPLE_SALTS = 32


def tables(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a row without an id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def small_batches(spark) -> None:
    """Lowers the session's Arrow batches to ``BATCH_TEXTS`` rows; a smaller setting of the caller's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_TEXTS:
        spark.conf.set(key, str(BATCH_TEXTS))


def candidates(rows: DataFrame, label: str, key: Column, per_salt: int) -> DataFrame:
    """For each label, all rows whose hash of ``key`` lies below a limit that leaves ``per_salt`` in each salt (``__salt``),
    or all rows. Rows that repeat in label and key come once.

    The limit follows from a count of the label's rows, so some three times the rows wanted leave the tasks, however many
    tasks there are. Where that leaves a salt too few, or repeats do, the limit is raised.
    """
    hashed = rows.withColumn("__key", key).withColumn("__h", F.xxhash64("__key"))
    hashed = hashed.withColumn("__salt", F.pmod("__h", F.lit(SAMPLE_SALTS)))
    counts = cut(rows.groupBy(label).agg(F.count(F.lit(1)).alias("__rows")), "label-counts")
    share = 3.0
    while True:
        reach = F.lit(share * per_salt * SAMPLE_SALTS) / F.col("__rows")
        near = (reach >= 1) | (F.col("__h").cast("double") < (reach - 0.5) * 2.0**64)
        kept = hashed.join(counts, label).filter(near).drop("__rows").dropDuplicates([label, "__h", "__key"])
        kept = cut(kept, "sample-candidates")
        full = kept.groupBy(label, "__salt").count().filter(F.col("count") >= per_salt)
        full = full.groupBy(label).agg(F.count(F.lit(1)).alias("__full"))
        few = (reach < 1) & (F.coalesce("__full", F.lit(0)) < SAMPLE_SALTS)
        if counts.join(full, label, "left").filter(few).isEmpty():
            return kept
        share *= 8


def sampled(rows: DataFrame, label: str, key: Column, per_label: int) -> DataFrame:
    """A bounded sample of each label, with a column ``place`` that numbers it in a fixed order.

    Rows are dealt over salts by the hash of ``key`` and each salt gives as many of its smallest hashes as the others, so that
    all together give ``per_label`` (rounded up to whole rows per salt) at the most. Rows that repeat in label and key count
    once; rows without a label take no part. Rows above a limit on the hash go before any are shuffled (see ``candidates``).
    """
    share = -(-per_label // SAMPLE_SALTS)
    order = Window.partitionBy(label, "__salt").orderBy("__h", "__key")
    numbered = candidates(rows, label, key, share).withColumn("__nth", F.row_number().over(order))
    place = (F.col("__nth") - 1) * SAMPLE_SALTS + F.col("__salt") + 1
    return numbered.filter(F.col("__nth") <= share).select(*rows.columns, place.cast("int").alias("place"))


def per_text(
    df: DataFrame, make: Callable[[], Callable[[bytes | None], tuple]], schema: str, *, id_col: str, text_col: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """One output row per input row: the id, the ``keep`` columns and what the function says of the whole text.

    ``make`` runs once per task and gives the function, which gets the text as UTF-8 bytes or None. The rows
    never leave their partition, so nothing is shuffled and a lost task is simply run again.
    """
    keep = keep or []
    small_batches(df.sparkSession)
    source = df.select(
        F.col(id_col).cast("long").alias("doc_id"), *[F.col(c) for c in keep],
        F.col(text_col).cast("string").cast("binary").alias("__text"),
    )
    out = T.StructType([*source.schema.fields[:-1], *columns(schema).fields])
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, arrow = None, None
        for batch in batches:
            function = function or make()
            texts = batch.column(batch.num_columns - 1)
            rows = [function(t.as_py()) for t in texts]
            found = list(zip(*rows)) or [()] * (len(names) - batch.num_columns + 1)
            arrow = arrow or to_arrow(out)
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(batch.num_columns - 1)]
            columns += [
                pa.array(list(c), arrow.field(i).type) for i, c in enumerate(found, batch.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, out)


def per_texts(
    df: DataFrame, make: Callable[[], Callable[[list[bytes | None]], list[tuple]]], schema: str, size: int, *, id_col: str,
    text_col: str, keep: list[str] | None = None,
) -> DataFrame:
    """As ``per_text``, with a function of several texts at once: as many of a batch as hold ``size`` bytes together."""
    keep = keep or []
    small_batches(df.sparkSession)
    source = df.select(
        F.col(id_col).cast("long").alias("doc_id"), *[F.col(c) for c in keep],
        F.col(text_col).cast("string").cast("binary").alias("__text"),
    )
    out = T.StructType([*source.schema.fields[:-1], *columns(schema).fields])
    names = [f.name for f in out.fields]

    def groups(texts: pa.Array) -> Iterator[list[bytes | None]]:
        held, bytes_held = [], 0
        for text in texts:
            held.append(text.as_py())
            bytes_held += len(held[-1] or b"")
            if bytes_held >= size:
                yield held
                held, bytes_held = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, arrow = None, None
        for batch in batches:
            function = function or make()
            rows = [row for texts in groups(batch.column(batch.num_columns - 1)) for row in function(texts)]
            found = list(zip(*rows)) or [()] * (len(names) - batch.num_columns + 1)
            arrow = arrow or to_arrow(out)
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(batch.num_columns - 1)]
            columns += [
                pa.array(list(c), arrow.field(i).type) for i, c in enumerate(found, batch.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, out)


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "string": T.StringType(), "binary": T.BinaryType(), "ints": T.ArrayType(T.IntegerType()),
}


def columns(told: str) -> T.StructType:
    """``"a long, b string"`` as a schema, also where no session is at hand."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in told.split(","))])


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def row_hash(text_col: str) -> Column:
    """Tells rows with one id (or none) apart by their text."""
    return F.xxhash64(F.col(text_col))


def _whole_hash(docs: DataFrame) -> Column:
    """A hash of the whole row, maps by their JSON."""
    return F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema])


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text hash are in ``kept`` (columns doc_id and __row_hash), each once.

    Null ids match null ids. Rows that repeat in id and text come out once: of those that differ in other columns, the one
    with the smallest hash of the whole row. The join and the choice have the same plain keys, so texts are shuffled once.
    """
    key = ["__no_id", "__id", ROW_HASH]

    def keys(own: str) -> list[Column]:
        return [F.col(own).isNull().alias("__no_id"), F.coalesce(F.col(own).cast("long"), F.lit(0)).alias("__id")]

    marked = docs.select(
        *keys(id_col), row_hash(text_col).alias(ROW_HASH), _whole_hash(docs).alias("__all"), F.struct(*docs.columns).alias("__row"),
    )
    found = marked.join(kept.select(*keys("doc_id"), ROW_HASH), key, "left_semi")
    return found.groupBy(*key).agg(F.min_by("__row", "__all").alias("__row")).select("__row.*")


def join_hot(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join with ``right``, which has one row per key, in which the keys of ``hot`` are not shuffled.

    ``hot`` holds few keys by its making (those with more than a set share of all rows), so their rows of
    ``right`` are broadcast and the rows of a hot key stay in as many tasks as they come from.
    """
    few = F.broadcast(hot.select(key))
    rest = left.join(few, key, "left_anti").join(right, key)
    return rest.unionByName(left.join(few, key, "left_semi").join(F.broadcast(right.join(few, key, "left_semi")), key))
