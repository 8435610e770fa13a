"""Sliced windows against plain windows and brute force, on skewed and tied data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loadcycle.operators import intervals, ordered

START = dt.datetime(2024, 1, 1)


def _log(rows=3000, seed=7):
    """One group holds a third of the rows, one instant holds a third of that group, times may be null."""
    pick = random.Random(seed)
    out = []
    for i in range(rows):
        group = 1 if i % 3 == 0 else pick.choice([2, 3, 4, None])
        second = 500 if group == 1 and i % 9 == 0 else pick.randrange(0, 20_000)
        moment = None if i % 97 == 0 else START + dt.timedelta(seconds=second, microseconds=pick.randrange(3))
        out.append((i, group, moment, None if i % 11 == 0 else i * 10))
    return out


@pytest.mark.parametrize("slices", [1, 2, 37])
def test_previous_equals_plain_lag(spark, slices):
    df = spark.createDataFrame(_log(), "id long, g long, t timestamp_ntz, v long").repartition(5)
    bounds = ordered.slice_bounds(df, ["t", "id"], slices)
    got = ordered.previous_in_group(df, "v", ["g"], ["t", "id"], "p", bounds)
    window = W.partitionBy("g").orderBy(F.col("t").asc_nulls_last(), "id")
    want = df.withColumn("p", F.lag("v").over(window))
    assert sorted(got.select("id", "p").collect()) == sorted(want.select("id", "p").collect())


def test_a_hot_instant_is_cut_by_the_tie_column(spark):
    rows = [(i, 1, START if i % 3 else START + dt.timedelta(seconds=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g long, t timestamp_ntz")
    bounds = ordered.slice_bounds(df, ["t", "id"], 20)
    largest = ordered._sliced(df, ["t", "id"], bounds).groupBy("g", "__slice").count().agg(F.max("count")).first()[0]
    assert bounds.heavy and largest < 400
    got = ordered.previous_in_group(df, "id", ["g"], ["t", "id"], "p", bounds)
    want = df.withColumn("p", F.lag("id").over(W.partitionBy("g").orderBy("t", "id")))
    assert sorted(got.select("id", "p").collect(), key=str) == sorted(want.select("id", "p").collect(), key=str)


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_running_sums_equal_plain_window(spark, slices):
    rows = [(i, i % 3 % 2, (i * 7919) % 100_003, i % 5 - 2) for i in range(2500)]
    df = spark.createDataFrame(rows, "id long, g long, at long, n long").repartition(4)
    got = ordered.running_sums(df, ["n"], ["g"], ["at", "id"], ordered.slice_bounds(df, ["at"], slices))
    window = W.partitionBy("g").orderBy("at", "id").rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("n", F.sum("n").over(window)).select(*df.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def _gappy(spark, rows):
    return spark.createDataFrame(rows, "k long, a timestamp_ntz, b timestamp_ntz")


@pytest.mark.parametrize("slices", [1, 4, 60])
def test_fill_forward_equals_single_window(spark, slices):
    pick = random.Random(3)
    rows = []
    for k in range(0, 4000, 2):
        a = None if k < 6 or pick.random() < 0.6 else START + dt.timedelta(seconds=pick.randrange(10_000))
        b = None if k < 3000 else START + dt.timedelta(minutes=k)  # no value at all in the first slices
        rows.append((k, a, b))
    df = _gappy(spark, rows).repartition(6)
    got = ordered.fill_forward(df, ["a", "b"], "k", 3000, ordered.slice_bounds(df, ["k"], slices))
    window = W.orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    want = df.select("k", *[
        F.coalesce(c, F.last(c, True).over(window) + F.expr("INTERVAL 3 SECOND")).alias(c) for c in ("a", "b")
    ])
    assert sorted(got.collect()) == sorted(want.collect())


def test_two_nulls_in_a_row_get_the_same_value_and_leading_nulls_stay(spark):
    df = _gappy(spark, [(0, None, None), (1, START, None), (2, None, None), (3, None, None)])
    got = {r.k: r.a for r in ordered.fill_forward(df, ["a"], "k", 3000).collect()}
    later = START + dt.timedelta(seconds=3)
    assert got == {0: None, 1: START, 2: later, 3: later}


def test_fill_forward_with_one_key_on_a_third_of_the_rows(spark):
    rows = [(5, None if i % 2 else START, None) for i in range(300)] + [(i, None, None) for i in range(6, 600)]
    got = ordered.fill_forward(_gappy(spark, rows), ["a"], "k", 3000).collect()
    assert len(got) == len(rows)
    assert {r.a for r in got} == {START, START + dt.timedelta(seconds=3)}


def test_rows_of_a_heavy_key_go_to_many_tasks(spark):
    rows = [(5 if i % 3 else i, None if i % 2 else START, None) for i in range(3000)]
    df = _gappy(spark, rows).repartition(6)
    bounds = ordered.slice_bounds(df, ["k"])
    assert bounds.heavy == (5.0,)
    filled = ordered.fill_forward(df, ["a"], "k", 3000, bounds)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__copy" in plan
    assert filled.count() == 3000 and filled.where("a IS NULL").count() == 0


def _brute_ready(states, group, since, to):
    own = sorted((t, i, r) for i, g, t, r in states if g == group)
    total = dt.timedelta()
    for (t, _, ready), nxt in zip(own, own[1:] + [(dt.datetime.max, 0, False)]):
        if ready:
            total += max(min(nxt[0], to) - max(t, since), dt.timedelta())
    return total.total_seconds()


@pytest.mark.parametrize("slices", [1, 25])
def test_ready_seconds_against_brute_force(spark, slices):
    pick = random.Random(11)
    states = []
    for i in range(900):
        group = 1 if i % 3 == 0 else pick.randrange(2, 5)
        states.append((i, group, START + dt.timedelta(seconds=pick.randrange(0, 5 * 86_400, 40)), pick.random() < 0.5))
    spans = []
    for i in range(400):
        since = START + dt.timedelta(seconds=pick.randrange(-1000, 6 * 86_400), microseconds=i)
        spans.append((i, pick.choice([1, 1, 2, 3, 4, 99]), since, since + dt.timedelta(seconds=pick.randrange(-50, 90_000))))
    spans += [(1000, None, START, START), (1001, 1, None, START)]
    log = spark.createDataFrame(states, "id long, g long, t timestamp_ntz, r boolean")
    rows = spark.createDataFrame(spans, "id long, g long, a timestamp_ntz, b timestamp_ntz")
    bounds = ordered.slice_bounds(log, ["t"], slices)
    changes = intervals.ready_changes(log, "g", "t", "r", "id", bounds)
    got = intervals.ready_seconds(rows, changes, "id", "g", {"s": ("a", "b")}, bounds).collect()
    assert len(got) == len(spans)
    for r in got:
        if r.g is None or r.a is None:
            assert r.s is None
        else:
            assert r.s == pytest.approx(max(0.0, _brute_ready(states, r.g, r.a, r.b)), abs=1e-6)


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_ids_beyond_the_exact_doubles(spark, slices):
    """500 ids from 2**62 on, the second column falling: slices follow the ids themselves."""
    rows = [(2**62 + i, i % 2, 1000 - i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g long, tie long, n long").repartition(4)
    bounds = ordered.slice_bounds(df, ["id", "tie"], slices)
    window = W.partitionBy("g").orderBy("id", "tie")
    got = ordered.previous_in_group(df, "n", ["g"], ["id", "tie"], "p", bounds)
    want = df.withColumn("p", F.lag("n").over(window))
    assert sorted(got.select("id", "p").collect(), key=str) == sorted(want.select("id", "p").collect(), key=str)
    sums = ordered.running_sums(df, ["n"], ["g"], ["id", "tie"], bounds)
    want = df.withColumn("n", F.sum("n").over(window.rowsBetween(W.unboundedPreceding, 0)))
    assert sorted(sums.collect()) == sorted(want.select(*df.columns).collect())


def test_ids_of_both_signs_far_apart(spark):
    ids = [-(2**63) + 1, -(2**60), -5, 0, 7, 2**61, 2**62, 2**62 + 1, 2**63 - 1]
    df = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id long, n long").repartition(3)
    got = ordered.previous_in_group(df.withColumn("g", F.lit(1)), "n", ["g"], ["id", "n"], "p", ordered.slice_bounds(df, ["id", "n"], 5))
    assert {r.n: r.p for r in got.collect()} == {k: k - 1 if k else None for k in range(len(ids))}


def test_slices_of_one_month_in_a_long_history(spark):
    """The cuts come from the rows asked for, so the month is spread however long the history is."""
    rows = [(i, START + dt.timedelta(hours=i)) for i in range(40 * 720)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
    month = df.where((F.col("t") >= F.lit(START + dt.timedelta(days=300))) & (F.col("t") < F.lit(START + dt.timedelta(days=330))))
    bounds = ordered.slice_bounds(month, ["t", "id"], 16)
    sizes = [r["count"] for r in ordered._sliced(month, ["t", "id"], bounds).groupBy("__slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 3 * 720 / 16


def test_both_branches_of_the_salted_join(spark):
    rows = [(5 if i % 3 else i, None if i % 2 else START, None) for i in range(900)]
    df = _gappy(spark, rows).repartition(6)
    heavy = ordered.slice_bounds(df, ["k"], 40)
    plain = ordered.Bounds(heavy.cuts)
    assert heavy.heavy and not plain.heavy
    both = [sorted(ordered.fill_forward(df, ["a"], "k", 3000, b).collect(), key=str) for b in (heavy, plain)]
    assert both[0] == both[1]
