"""Run every registered query next to its SQL and compare columns, types and values.

    python -m checks.compare [table folder] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import all_oracles
from checks.queries import all_queries


def local_session(cpus: str = "8") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loadcycle")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("SCRATCH_DIR", "/tmp/checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(table: pa.Table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t).replace("large_", "")


def differences(left: pa.Table, right: pa.Table) -> str | None:
    """What differs between two results, ``None`` when nothing does."""
    (left_names, left_rows), (right_names, right_rows) = _rows(left), _rows(right)
    if left_names != right_names:
        return f"columns {sorted(set(left_names) ^ set(right_names))}"
    kinds = [(n, _kind(left.schema.field(n).type), _kind(right.schema.field(n).type)) for n in left_names]
    if any(a != b for _, a, b in kinds):
        return f"types {[k for k in kinds if k[1] != k[2]]}"
    if len(left_rows) != len(right_rows):
        return f"rows {len(left_rows)} against {len(right_rows)}"
    for a, b in zip(left_rows, right_rows):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(left_names, a, b) if x != y]
            return f"values {cells[:4]}"
    return None


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def check(spark: SparkSession, db, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    df = all_queries()[name](spark, sf_dir)
    got = df.toArrow()
    sql = all_oracles().get(name)
    if sql is None:
        return df, f"ran, {got.num_rows} rows, no SQL"
    return df, differences(got, db.sql(sql).to_arrow_table()) or f"same, {got.num_rows} rows"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, db, bad = local_session(), connect(sf_dir), 0
    for name in names or all_queries():
        start = time.time()
        try:
            _, verdict = check(spark, db, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            verdict = f"failed: {str(error)[:600]}"
        bad += not verdict.startswith(("same", "ran"))
        print(f"{name:24s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
