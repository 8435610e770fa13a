"""Many files whose columns and types drift: footers in tasks, few jobs, commits."""

import json

import pyarrow as pa
import pytest
from pyarrow import parquet
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.sources import manifest
from loadcycle.sources import tables as io
from tests.test_facts import jobs_of


@pytest.fixture
def many(tmp_path):
    """2,000 files of six schemas, as other writers make them."""
    for i in range(2000):
        columns = {"id": pa.array([i], pa.int64()), "load": pa.array([i / 2] if i % 2 else [i], pa.float64() if i % 2 else pa.int64())}
        if i % 3 == 0:
            columns["only here"] = pa.array([f"t{i}"])
        if i % 5 == 0:
            columns["small"] = pa.array([i], pa.int32())
        elif i % 5 == 1:
            columns["small"] = pa.array([i], pa.int64())
        parquet.write_table(pa.table(columns), tmp_path / f"{i:05}.parquet")
    return str(tmp_path)


def test_many_files_in_two_jobs(spark, many):
    """One job reads the footers, one aggregate of the manifest tells the schemas; then the table is two scans."""
    found, jobs = jobs_of(spark, lambda: manifest.written_manifest(spark, many))
    assert jobs == 1
    table, jobs = jobs_of(spark, lambda: manifest.read_files(spark, many, found))
    assert jobs <= 2  # the two stages of the aggregate
    assert table.schema.simpleString() == "struct<id:bigint,load:double,only here:string,small:bigint>"
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    sums, jobs = jobs_of(spark, lambda: table.agg(F.count("id"), F.sum("load"), F.count("only here"), F.sum("small")).first())
    assert jobs <= 2
    ids = range(2000)
    assert tuple(sums) == (2000, sum(i / 2 if i % 2 else i for i in ids), 667, sum(i for i in ids if i % 5 < 2))


def test_a_commit_reads_new_and_changed_files_only(spark, tmp_path, monkeypatch):
    for i in range(3):
        parquet.write_table(pa.table({"a": [i]}), tmp_path / f"{i}.parquet")
    first = manifest.written_manifest(spark, str(tmp_path))
    parquet.write_table(pa.table({"a": [1.5, 2.5]}), tmp_path / "1.parquet")
    parquet.write_table(pa.table({"b": ["x"]}), tmp_path / "3.parquet")
    (tmp_path / "2.parquet").unlink()
    asked = []
    plain = manifest.footers
    monkeypatch.setattr(manifest, "footers", lambda files, *more: asked.append(files.count()) or plain(files, *more))
    second = manifest.cut(manifest.read_manifest(spark, str(tmp_path), first), "manifest")
    assert asked == [2]
    commits = {r.file.rsplit("/", 1)[1]: (r.commit, r.rows) for r in second.collect()}
    assert commits == {"0.parquet": (1, 1), "1.parquet": (2, 2), "3.parquet": (2, 1)}
    rows = manifest.read_files(spark, str(tmp_path), second)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(0.0, None), (1.5, None), (2.5, None), (None, "x")], key=repr)


def test_footers_from_bytes_are_the_same(spark, many):
    files = manifest._files(spark, many).orderBy("file").limit(40)
    near = manifest.footers(files.drop("content"), "file").collect()
    assert sorted(manifest.footers(files, "viewfs").collect()) == sorted(near)


def test_types_of_other_writers(spark, tmp_path):
    kinds = {
        "day": pa.array([1], pa.date32()), "zoned": pa.array([1], pa.timestamp("us", "UTC")), "wall": pa.array([1], pa.timestamp("us")),
        "words": pa.array(["a"]).dictionary_encode(), "price": pa.array([1], pa.decimal128(9, 2)), "list": pa.array([[1]], pa.list_(pa.int32())),
        "a.b c": pa.array([True]),
    }
    parquet.write_table(pa.table(kinds), tmp_path / "x.parquet")
    found = manifest.written_manifest(spark, str(tmp_path)).first()
    assert T.StructType.fromJson(json.loads(found.schema)).simpleString() == spark.read.parquet(str(tmp_path)).schema.simpleString()
    row = io.read_parquet_folder(spark, str(tmp_path)).first()
    assert row["words"] == "a" and row["a.b c"] is True and row["list"] == [1]


def test_merged_types():
    long, double, text, day = T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
    first = T.StructType([T.StructField(n, k) for n, k in zip("abcd", (long, T.IntegerType(), text, day))])
    second = T.StructType([T.StructField(n, k) for n, k in zip("dbcae", (T.TimestampNTZType(), long, long, double, day))])
    merged = manifest.merged_schema([first, second])
    assert merged.names == list("abcde") and [f.dataType for f in merged] == [double, long, text, T.TimestampNTZType(), day]
    groups = manifest.scans([(first, ["x", "y"]), (second, ["z"])], merged)
    assert [files for _, files in groups] == [["x", "y"], ["z"]]
    assert [f.dataType for f in groups[0][0]] == [long, long, text, day, day]  # b is widened by the reader


def test_subfolders_told_by_name(spark, tmp_path):
    spark.range(10).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(str(tmp_path / "t"))
    rows = io.read_parquet_folder(spark, str(tmp_path / "t"))
    assert rows.columns == ["id", "part"] and rows.agg(F.sum("part")).first()[0] == 5


def test_nanosecond_files_of_tasks_without_rows(spark, tmp_path):
    from checks.queries import _write_nanoseconds

    rows = spark.range(3).repartition(8).selectExpr("id as event_id", "timestampadd(SECOND, id, timestamp_ntz'2024-01-01 00:00:00') as ts")
    _write_nanoseconds(rows, str(tmp_path / "times"))
    found = io.read_parquet_folder(spark, str(tmp_path / "times"), nanoseconds=["ts"])
    assert sorted((r.event_id, r.ts.second) for r in found.collect()) == [(0, 0), (1, 1), (2, 2)]
