"""Readers and writers. The table format is a parameter, so a Delta jar on the class path is used as ``delta``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.sources import csv_records, manifest
from loadcycle.sources.manifest import wider
from loadcycle.sources.scratch import shuffles_released

__all__ = [
    "key_ranges", "read_csv", "read_jdbc", "read_parquet", "read_parquet_folder", "read_table", "run_query", "use_time_zone", "wider",
    "write_table",
]


def use_time_zone(spark: SparkSession, zone: str) -> None:
    """Zone in which instants are shown and parsed for this session."""
    spark.conf.set("spark.sql.session.timeZone", zone)


def _nanos_as_long(spark: SparkSession) -> None:
    """Lets Spark read nanosecond columns, which it refuses otherwise, as whole numbers."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")


def _moments(df: DataFrame, nanoseconds: Sequence[str]) -> DataFrame:
    """The named columns as wall-clock times, whether they came as nanoseconds or as timestamps."""

    def moment(name: str):
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, T.LongType):
            micros = F.expr(f"(`{name}` - pmod(`{name}`, 1000L)) div 1000L")
            return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
        return value.cast("timestamp_ntz")

    return df.withColumns({c: moment(c) for c in nanoseconds if c in df.columns})


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, nanoseconds: Sequence[str] = ()
) -> DataFrame:
    """A Parquet file or folder of one schema. ``nanoseconds`` names the times that were written at that unit."""
    if nanoseconds:
        _nanos_as_long(spark)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _moments(reader.parquet(path), nanoseconds)


def read_parquet_folder(spark: SparkSession, folder: str, nanoseconds: Sequence[str] = ()) -> DataFrame:
    """Every ``.parquet`` file of a folder, columns matched by name, missing ones null.

    A column that is a whole number in some files and a fraction in others (a writer that turns
    gaps into fractions does that) gets the wider type. The footers are read once, in tasks.
    """
    if nanoseconds:
        _nanos_as_long(spark)
    return _moments(manifest.read_files(spark, folder, manifest.written_manifest(spark, folder, nanoseconds)), nanoseconds)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, line_breaks: bool = True) -> DataFrame:
    """CSV with a header line, its columns found by name, in the declared types.

    Quotes inside a quoted field are doubled. A value that does not fit its type, a declared column that the
    header lacks, and files whose headers differ raise an error; further columns are passed over. Large files are read by
    many tasks: with ``line_breaks``, where a quoted field may hold one, the records are found first
    (``csv_records``), without it lines are records.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
    header = reader.csv(path).columns
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"the header lacks {missing}")
    kinds = {f.name: f.dataType for f in wanted}
    found = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    if line_breaks:
        rows = _parsed(csv_records.records(spark, path), header, found)
    else:
        rows = reader.schema(found).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in wanted])


def _parsed(records: DataFrame, header: list[str], found: T.StructType) -> DataFrame:
    """Records as columns, without each file's first one, which must be the header."""
    options = {"escape": '"', "mode": "FAILFAST"}
    text = F.rtrim(F.col("record"), F.lit("\r"))
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i, _ in enumerate(header)])
    own = F.from_csv(text, F.lit(names.simpleString()[7:-1].replace(":", " ")), {"escape": '"'})
    same = F.array(*[own[f"c{i}"] for i, _ in enumerate(header)]) == F.array(*[F.lit(c) for c in header])
    first = (F.col("block") == 0) & (F.col("number") == 1)
    checked = F.when(~F.coalesce(same, F.lit(False)), F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean"))
    rows = records.where(F.when(first, F.coalesce(checked, F.lit(False))).otherwise(text != ""))
    types = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in found)
    return rows.select(F.from_csv(text, F.lit(types), options).alias("r")).select("r.*")


def key_ranges(column: str, low: int, high: int, parts: int) -> list[str]:
    """Predicates that cut a numeric key into ``parts`` disjoint ranges covering every row, nulls too."""
    step = max(1, -(-(high - low + 1) // parts))
    edges = list(range(low + step, high + 1, step))
    if not edges:
        return ["1 = 1"]
    first = f"{column} < {edges[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [first, *middle, f"{column} >= {edges[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A relational table, one partition per predicate. Credentials come in ``properties``, never from code."""
    options = dict(properties or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.jdbc(url, table, properties=options)


def run_query(tables: Mapping[str, DataFrame], text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """SQL over named DataFrames; ``{name}`` stands for a table and ``:name`` for a bound value."""
    session = next(iter(tables.values())).sparkSession
    return session.sql(text, args=dict(args or {}), **tables)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    partitions: int | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Write lazily computed rows. ``mode`` is overwrite, append or errorifexists."""
    out = df if partitions is None else df.repartition(partitions)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    with shuffles_released(df.sparkSession):
        out.write.format(fmt).mode(mode).save(path)
