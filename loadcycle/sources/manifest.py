"""Folders of many Parquet files whose columns and types drift.

The footers are read in tasks, one row per file, and kept as a manifest: file, size, time, rows, schema and the commit that first
saw it. The next commit reads the footers of new and changed files only. The types of a column in all files are merged by
aggregation, and files are scanned together as long as one read schema fits them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.operators.relational import union_by_name
from loadcycle.sources.scratch import cut

MANIFEST = "file string, size long, modified timestamp, rows long, schema string, commit long"
_FOOTERS = "file string, size long, modified timestamp, rows long, schema string"

# The footer's key under which Spark keeps a file's schema, and the stores that tasks open by themselves.
_OWN_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_STORES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}

_WIDTH = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both; text where they have nothing in common."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = a.simpleString(), b.simpleString()
    if all(n in _WIDTH for n in names):
        wide = max(names, key=_WIDTH.index)
        return T.DoubleType() if wide == "float" else a if wide == names[0] else b
    if {*names} <= {"timestamp", "timestamp_ntz", "date"}:
        return T.TimestampNTZType()
    if any(isinstance(t, T.DecimalType) for t in (a, b)) and any(n in _WIDTH for n in names):
        return T.DoubleType()
    return T.StringType()


def _read_as(kind: T.DataType, target: T.DataType) -> bool:
    """Whether the Parquet reader itself widens one type to the other."""
    names = kind.simpleString(), target.simpleString()
    return kind == target or names in {
        ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
        ("int", "bigint"), ("int", "double"), ("float", "double"),
    }


# Footers ------------------------------------------------------------------------------------

def _schema_of(footer, nanoseconds: Sequence[str]) -> T.StructType:
    """A file's schema as Spark reads it: as Spark wrote it, or from the columns' own types."""
    from pyspark.sql.pandas.types import from_arrow_type

    told = (footer.metadata or {}).get(_OWN_SCHEMA)
    if told:
        return T.StructType.fromJson(json.loads(told))
    physical = {c.path.split(".")[0]: c.physical_type for c in map(footer.schema.column, range(len(footer.schema)))}
    fields = []
    for column in footer.schema.to_arrow_schema():
        if physical.get(column.name) == "INT96":
            kind = T.TimestampType()
        elif pa.types.is_timestamp(column.type) and column.type.unit == "ns" and column.name in nanoseconds:
            kind = T.LongType()  # as the reader gives it
        elif pa.types.is_dictionary(column.type):
            kind = from_arrow_type(column.type.value_type, True)
        else:
            kind = from_arrow_type(column.type, True)
        fields.append(T.StructField(column.name, kind))
    return T.StructType(fields)


def footers(files: DataFrame, scheme: str, nanoseconds: Sequence[str] = ()) -> DataFrame:
    """The footer of each file, read in tasks: from the file's end where tasks can open the store, else from all its bytes."""
    named = [*nanoseconds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        for batch in batches:
            found = []
            for i, file in enumerate(batch.column("file").to_pylist()):
                if scheme in _STORES:
                    store, path = fs.FileSystem.from_uri(f"{_STORES[scheme]}://{_without_scheme(file)}")
                    footer = parquet.ParquetFile(store.open_input_file(path)).metadata
                else:
                    footer = parquet.ParquetFile(pa.BufferReader(batch.column("content")[i].as_buffer())).metadata
                found.append((footer.num_rows, _schema_of(footer, named).json()))
            rows, schemas = zip(*found) if found else ((), ())
            kept = [batch.column(c) for c in ("file", "size", "modified")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(rows, pa.int64()), pa.array(schemas, pa.string())],
                names=["file", "size", "modified", "rows", "schema"],
            )

    return files.mapInArrow(run, _FOOTERS)


def _without_scheme(file: str) -> str:
    """The address and path of a file's URI, its escapes undone."""
    from urllib.parse import unquote

    rest = file.split(":", 1)[1] if ":" in file else file
    return unquote("/" + rest.lstrip("/") if not rest.startswith("//") or rest.startswith("///") else rest[2:])


def _scheme(spark: SparkSession, folder: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getUri().getScheme()


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Every Parquet file of a folder, with its bytes in a column that is read only if asked for."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content"
    )


def read_manifest(
    spark: SparkSession, folder: str, before: DataFrame | None = None, nanoseconds: Sequence[str] = ()
) -> DataFrame:
    """One row per file of the folder as it is now, with the commit that first saw it as it is.

    With the manifest of an earlier commit only the footers of new and changed files are read.
    """
    scheme, files = _scheme(spark, folder), _files(spark, folder)
    if scheme in _STORES:
        files = files.drop("content")
    if before is None:
        return footers(files, scheme, nanoseconds).withColumn("commit", F.lit(1).cast("long"))
    key = ["file", "size", "modified"]
    number = before.agg(F.coalesce(F.max("commit"), F.lit(0)).alias("last"))
    added = footers(files.join(before, key, "left_anti"), scheme, nanoseconds)
    added = added.withColumn("commit", (number.scalar() + 1).cast("long"))
    return before.join(files.select(*key), key, "left_semi").select(*added.columns).unionByName(added)


# Types --------------------------------------------------------------------------------------

def schemas(manifest: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    """The distinct schemas and their files, by the first file of each. One aggregate; as many rows come back as schemas."""
    rows = manifest.groupBy("schema").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return [(T.StructType.fromJson(json.loads(r["schema"])), r["files"]) for r in sorted(rows, key=lambda r: r["files"])]


def merged_schema(found: Sequence[T.StructType]) -> T.StructType:
    """All columns of all schemas, each with the narrowest type that holds those of all."""
    kinds: dict[str, T.DataType] = {}
    for schema in found:
        for f in schema:
            kinds[f.name] = wider(kinds.get(f.name, T.NullType()), f.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def scans(found: list[tuple[T.StructType, list[str]]], target: T.StructType) -> list[tuple[T.StructType, list[str]]]:
    """Files that one read schema fits, and that schema; the largest group first.

    Only columns whose type in some file the reader cannot widen by itself part the files; a file without the column goes with any.
    """
    wanted = {f.name: f.dataType for f in target}
    apart = {f.name for schema, _ in found for f in schema if not _read_as(f.dataType, wanted[f.name])}
    groups: dict[tuple, list[str]] = {}
    for schema, files in found:
        own = {f.name: f.dataType for f in schema if f.name in apart}
        key = tuple((name, own.get(name, wanted[name])) for name in target.names if name in apart)
        groups.setdefault(key, []).extend(files)
    read = [
        (T.StructType([T.StructField(f.name, dict(key).get(f.name, f.dataType)) for f in target]), files) for key, files in groups.items()
    ]
    return sorted(read, key=lambda g: -len(g[1]))


def read_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The files of a manifest as one table: columns by name, missing ones null, types widened."""
    found = schemas(manifest)
    target = merged_schema([schema for schema, _ in found])
    groups = scans(found, target)
    reader, path, parts = spark.read.option("pathGlobFilter", "*.parquet"), F.col("_metadata.file_path"), []
    for i, (schema, files) in enumerate(groups):
        rows = reader.schema(schema).parquet(folder)
        if len(groups) > 1:  # the largest group is told by the files of the others, so the plan holds as few names as can be
            rows = rows.where(path.isin(files) if i else ~path.isin([f for _, other in groups[1:] for f in other]))
        by_folder = [F.col(f"`{c}`") for c in rows.columns if c not in target.names]  # told by the names of subfolders
        parts.append(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target], *by_folder))
    return union_by_name(parts) if parts else spark.createDataFrame([], target)


def written_manifest(spark: SparkSession, folder: str, nanoseconds: Sequence[str] = ()) -> DataFrame:
    """The manifest as a scratch table, so that its uses read no footer again."""
    return cut(read_manifest(spark, folder, nanoseconds=nanoseconds), "manifest")
