"""Facts laid out by their join key, so that joins and picks per key move none of their rows.

A table is written in buckets of its key, each bucket one sorted file, and says so in a small file beside it. Read by that, its
scan is already partitioned as joins on the key and windows over it ask for; only the other side is shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.sources import scratch

FILE = "_layout.json"

#: The keys by which the raw layer joins its two large facts, and the order in which it picks one row of each.
FACTS = {"tp_palas": ("id_palas", "id"), "ta_datacarga_sensores": ("id_cargadescarga", "id")}


def _name(path: str) -> str:
    """A table name for a path, the same in every session."""
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def write_bucketed(df: DataFrame, path: str, key: str, order: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write rows in buckets of ``key``, sorted by it and then by ``order``; the table as it is read back.

    By default there are as many buckets as shuffle partitions, so the other side of a join meets them as they are. Rows
    without a key can match nothing; they lie in one bucket.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [key, *([order] if order else [])]
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    writer = df.repartition(count, F.col(_quoted(key))).write.format("parquet").bucketBy(count, key).sortBy(*sort)
    writer.option("path", path).mode("overwrite").saveAsTable(_name(path))
    layout = {"key": key, "sort": sort, "buckets": count, "schema": df.schema.jsonValue()}
    scratch.write_text(spark, f"{path}/{FILE}", json.dumps(layout))
    return spark.table(_name(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table by the layout that lies beside it, also in a session that did not write it."""
    path = path.rstrip("/")
    told = scratch.read_text(spark, f"{path}/{FILE}")
    if told is None:
        raise ValueError(f"{path} has no layout beside it")
    layout = json.loads(told)
    if not spark.catalog.tableExists(_name(path)):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["schema"]))
        sort = ", ".join(map(_quoted, layout["sort"]))
        spark.sql(
            f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({_quoted(layout['key'])}) SORTED BY ({sort})"
            f" INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(_name(path))


def write_facts(tables: Mapping[str, DataFrame], folder: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables of the raw layer, its two large facts laid out by their join keys below ``folder``."""
    laid = {
        name: write_bucketed(tables[name], f"{folder.rstrip('/')}/{name}", key, order, buckets) for name, (key, order) in FACTS.items()
    }
    return {**tables, **laid}
