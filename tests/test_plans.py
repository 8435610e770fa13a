"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.mine_tables import PERIOD, mine
from checks.queries import all_queries as queries
from loadcycle.operators import cleaning, ordered
from loadcycle.operators import relational as rel
from loadcycle.plans import raw
from loadcycle.sources.scratch import cut


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", list(queries()))
def test_no_python_no_cross_join(spark, small, name):
    plan = _plan(queries()[name](spark, small))
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_one_row_per_key_drops_losers_before_the_shuffle(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = _plan(rel.keep_one(lines, ["l_orderkey"], [F.col("l_extendedprice").desc()]))
    assert re.search(r"WindowGroupLimit.*Final(.|\n)*Exchange(.|\n)*WindowGroupLimit.*Partial", plan)


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = _plan(queries()["min_date"](spark, small))
    assert "GreaterThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_top_rows_need_no_full_sort(spark, small):
    assert "TakeOrderedAndProject" in _plan(queries()["topk"](spark, small))


def test_mode_counts_before_the_shuffle(spark, small):
    plan = _plan(cleaning.mode_of(spark.read.parquet(f"{small}/orders.parquet"), "o_orderpriority"))
    assert "partial_count" in plan and "TakeOrderedAndProject" in plan


def test_ordered_work_moves_all_rows_to_one_task_nowhere(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", "user_id", "ts")
    lag = ordered.previous_in_group(events, "ts", ["user_id"], ["ts", "event_id"], "p")
    assert "SinglePartition" not in _plan(lag)
    # the forward fill runs one unpartitioned window, over its one-row-per-slice summary
    fill = _plan(ordered.fill_forward(events, ["ts"], "event_id"))
    assert fill.count("Exchange SinglePartition") == 1
    single = fill[fill.index("Exchange SinglePartition"):]
    assert "Aggregate(keys=[__slice" in single.split("Scan")[0]


def test_slices_split_a_group_with_a_third_of_the_rows(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"))
    bounds = ordered.slice_bounds(df, ["id"], 40)
    sliced = ordered._sliced(df, ["id"], bounds)
    assert sliced.groupBy("g", "__slice").count().agg(F.max("count")).first()[0] <= 2 * 30_000 / 40


def test_wide_cycles_are_shuffled_for_keys_only(spark, small):
    """Small dimensions are broadcast by their true size; only the three keys move the wide rows."""
    plan = _plan(queries()["raw_cycles"](spark, small))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    moved_for_dimensions = [x for x in wide if re.search(r"hashpartitioning\((id_equipo|id_factor|id_turno|id_descarga)", x)]
    assert not moved_for_dimensions


def test_a_hot_key_is_split_in_the_join(spark):
    """A third of the left rows share one key; adaptive execution splits that partition."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        left = cut(spark.range(60_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.rand(1).alias("w")
        ).repartition(12), "hot")
        right = cut(spark.range(60_000).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v")), "right")
        joined = rel.left_lookup(left, right, "k", "r")
        assert "skew=true" in _final_plan(joined) and joined.count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_derived_mine_grows_with_the_tables(spark, small):
    facts = {"tp_cargadescarga": "orders", "tp_palas": "orders", "ta_datacarga_sensores": "lineitem", "tp_estados": "events"}
    tables = mine(spark, small)
    for name, source in facts.items():
        assert tables[name].count() >= spark.read.parquet(f"{small}/{source}.parquet").count()


def test_plans_of_the_raw_layer_before_they_are_written(spark, small):
    """The steps that do the work: no cross join, the period in the scan's filters, losers dropped before the shuffle."""
    tables, low, high = mine(spark, small), *[F.lit(p).cast("timestamp_ntz") for p in PERIOD]
    types = cut(raw.state_types(tables), "types")
    loads = raw.joined_loads(tables, low, high)
    plans = {
        "loads": _plan(loads),
        "shovels": _plan(raw.shovel_loads(loads, ordered.slice_bounds(loads, ["tiempo_inicio_carga_carguio", "load_id"]))),
        "log": _plan(raw.states_that_count(tables, low, high)),
        "states": _plan(raw.current_states(tables, types)),
    }
    for plan in plans.values():
        assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|SinglePartition", plan)
    assert "WindowGroupLimit" in plans["states"] and "WindowGroupLimit" in plans["loads"]
    assert "partial_max_by" in plans["log"]


def test_the_period_is_filtered_in_the_scan(spark, small):
    table = cut(mine(spark, small)["tp_cargadescarga"], "cycles")
    plan = _plan(rel.strictly_between(table, "tiem_llegada", *[F.lit(p).cast("timestamp_ntz") for p in PERIOD]))
    assert "GreaterThan(tiem_llegada" in plan and "LessThan(tiem_llegada" in plan


def test_the_mine_is_read_from_the_supplied_tables(spark, small):
    for rows in mine(spark, small).values():
        assert all(small in file for file in rows.inputFiles())


def test_the_wide_cycles_move_by_their_id_only(spark, small):
    """What belongs to a cycle is found by narrow rows and comes to the cycle; the wide rows are not dealt by a second key."""
    plan = _plan(raw.haul_cycles(mine(spark, small), *PERIOD))
    assert "hashpartitioning(__at" not in plan and "hashpartitioning(__key" in plan


def test_rows_of_other_keys_stay_out_of_the_shuffle(spark):
    rows = spark.range(20_000).select((F.col("id") % 10_000).alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 1L AS id"))
    keys = spark.range(0, 10_000, 50).select(F.col("id").cast("int").alias("key")).unionByName(spark.sql("SELECT CAST(NULL AS INT) AS key"))
    found = rel.with_keys_of(rows, "k", keys, "key")
    assert found.where("k % 50 = 0").count() == 400 and found.count() < 500
    assert found.columns == rows.columns and "hashpartitioning(k" not in _plan(found)
    assert rel.with_keys_of(rows, "k", keys.limit(0), "key").count() == 0
    assert rel.with_keys_of(rows, "k", keys.selectExpr("CAST(key AS STRING) AS key"), "key").count() == 20_000
