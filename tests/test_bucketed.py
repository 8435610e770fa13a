"""Facts laid out by their join keys: no row of them moves, and nothing else changes."""

import re

import pytest
from pyspark.sql import functions as F

from checks.mine_tables import PERIOD, mine
from loadcycle.operators import relational as rel
from loadcycle.plans import raw
from loadcycle.sources import bucketed
from loadcycle.sources.scratch import scratch_path


@pytest.fixture(scope="module")
def facts(spark, small):
    return bucketed.write_facts(mine(spark, small), scratch_path(spark, "facts"))


@pytest.fixture
def no_broadcast(spark):
    """Tables of the size of these would be broadcast; those the layout is for are not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _moved(df, table):
    """Whether rows of a table's scan pass an exchange, by the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan" in line and table in line)
    depth = len(re.match(r"[ :+|*()\d-]*", lines[scan])[0])
    for line in reversed(lines[:scan]):
        at = len(re.match(r"[ :+|*()\d-]*", line)[0])
        if at < depth:
            depth = at
            if "Exchange" in line:
                return True
    return False


def test_versions_are_picked_where_they_lie(spark, facts, no_broadcast):
    table = facts["tp_palas"]
    loads = facts["tp_cargadescarga"].select("id_palas").where("id_palas IS NOT NULL").distinct()
    asked = table.join(loads, "id_palas", "left_semi")
    versions = rel.latest_per_key(asked, "id_palas", "id").select("id_palas", "id_equipo")
    joined = facts["tp_cargadescarga"].select("id", "id_palas").join(versions, "id_palas")
    scan = re.search(r"bucketed_\w+", versions._jdf.queryExecution().executedPlan().toString())[0]
    assert not _moved(versions, scan) and not _moved(joined, scan)
    plain = rel.latest_per_key(spark.read.parquet(*table.inputFiles()), "id_palas", "id")
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == facts["tp_cargadescarga"].join(plain.select("id_palas").distinct(), "id_palas", "left_semi").count()


def test_sensor_rows_join_the_wide_cycles_where_they_lie(spark, facts, no_broadcast):
    passes = rel.latest_per_key(rel.alive(facts["ta_datacarga_sensores"]), "id_cargadescarga", "id").alias("passes")
    cycles = facts["tp_cargadescarga"].select("id", "id_cargadescarga").alias("cycle")
    wide = rel.left_join_spreading_nulls(cycles, passes, "cycle.id_cargadescarga", "passes.id_cargadescarga", "cycle.id")
    scan = re.search(r"bucketed_\w+", passes._jdf.queryExecution().executedPlan().toString())[0]
    assert not _moved(wide, scan)


def test_raw_cycles_are_the_same(spark, small, facts):
    plain = raw.haul_cycles(mine(spark, small), *PERIOD)
    laid = raw.haul_cycles(facts, *PERIOD)
    assert laid.schema == plain.schema
    key = [F.xxhash64(*[F.col(f"`{f.name}`") for f in plain.schema]).alias("h")]
    assert sorted(r.h for r in laid.select(*key).collect()) == sorted(r.h for r in plain.select(*key).collect())


def test_a_layout_is_read_in_another_session(spark, tmp_path):
    path = str(tmp_path / "odd names")
    rows = spark.range(100).select(F.col("id").alias("the key"), F.lit(1).alias("a.b"), (F.col("id") * 2).alias("n"))
    bucketed.write_bucketed(rows, path, "the key", "n", 3)
    spark.sql(f"DROP TABLE {bucketed._name(path)}")  # the catalogue of another session does not know it
    again = bucketed.read_bucketed(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))
    assert "Exchange" not in again.groupBy("the key").count()._jdf.queryExecution().executedPlan().toString()
    bucketed.write_bucketed(rows.limit(5), path, "the key", None, 2)  # in place of the old one
    assert bucketed.read_bucketed(spark, path).count() == 5
    with pytest.raises(ValueError, match="no layout"):
        bucketed.read_bucketed(spark, str(tmp_path))


def test_rows_without_a_key_match_nothing(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, None), (4, 6)], "id long, k long")
    right = spark.createDataFrame([(5, "x"), (None, "never")], "k long, v string")
    # a right key that happens to be the place of a left row without one
    clash = left.where("k IS NULL").select(F.xxhash64("id").alias("k"), F.lit("clash").alias("v"))
    found = rel.left_join_spreading_nulls(left.alias("l"), right.unionByName(clash).alias("r"), "l.k", "r.k", "l.id")
    assert sorted((r.id, r.v) for r in found.select("l.id", "r.v").collect()) == [(1, "x"), (2, None), (3, None), (4, None)]
