"""Facts of a layer: taken while it is written, added up over parts, used without a job."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks.mine_tables import PERIOD, mine
from loadcycle.operators import facts, ordered
from loadcycle.plans import layers, stage
from loadcycle.sources.scratch import scratch_path


def jobs_of(spark, work):
    """What the work returns, and how many jobs it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture(scope="module")
def mixed(spark):
    n = F.col("id")
    return spark.range(0, 1000, 1, 7).select(
        "id", F.when(n % 10 < 3, F.lit(1.5)).when(n % 10 == 3, F.lit(float("nan"))).alias("gaps"),
        F.when(n % 4 == 0, "2024-01-02 03:04:05").when(n % 4 == 1, "02/01/2024").when(n % 4 == 2, "no date").alias("some date"),
        F.when(n % 2 == 0, F.lit("word")).alias("word"), F.lit(None).cast("string").alias("none"),
    )


def test_facts_taken_on_the_way_are_those_of_a_pass(spark, mixed):
    observed = facts.Observed(mixed, ["id"])
    path = scratch_path(spark, "observed")
    observed.rows.write.parquet(path)
    found, plain = observed.facts(), facts.column_facts(mixed, True, ["id"])
    assert (found.rows, found.present, found.parsed, found.dated) == (plain.rows, plain.present, plain.parsed, plain.dated)
    assert found.dates == ("some date",)
    assert found.nulls() == {"id": 0, "gaps": 700, "some date": 500, "word": 500, "none": 1000}
    assert found.nulls(find_dates=False)["some date"] == 250
    facts.save(spark, path, found)
    facts.save(spark, path, found)  # in place of the one that is there
    assert facts.load(spark, path) == found
    assert spark.read.parquet(path).count() == 1000
    assert facts.load(spark, scratch_path(spark, "nowhere")) is None


def test_facts_of_parts_add_up(spark, mixed):
    parts = [mixed.where("id < 100"), mixed.where("id >= 100 AND id < 900").drop("word"), mixed.where("id >= 900")]
    found, n = facts.ColumnFacts(), 0
    for part in parts:
        found, n = found.plus(facts.column_facts(part, True, ["id"]), spark), n + 1
    whole = facts.column_facts(mixed, True, ["id"])
    assert found.rows == whole.rows and found.dates == whole.dates and found.parsed["some date"] == whole.parsed["some date"]
    assert found.present["word"] == 100 and found.sparse() == ["word", "none"]
    bounds = ordered.sketched_bounds(spark, mixed.schema["id"].dataType, found.sketches["id"], 10)
    assert [round(c / 100) for c in bounds.cuts] == list(range(1, 10))


def test_bounds_from_a_sketch_need_no_job(spark, mixed):
    told = facts.column_facts(mixed, False, ["id"]).sketches["id"]
    kind = mixed.schema["id"].dataType
    bounds, jobs = jobs_of(spark, lambda: ordered.sketched_bounds(spark, kind, told))
    assert jobs == 0 and len(bounds.cuts) > 10
    _, jobs = jobs_of(spark, lambda: ordered.merged_sketch(spark, told, told))
    assert jobs == 0
    far = facts.column_facts(spark.range(10).select((F.col("id") + F.lit(1 << 60)).alias("id")), False, ["id"])
    assert ordered.sketched_bounds(spark, kind, far.sketches["id"]) is None  # not exact as doubles: a pass it is
    none = facts.column_facts(mixed.limit(0), False, ["id"])
    assert none.rows == 0 and not ordered.slice_bounds(mixed.limit(0), ["id"]).cuts


def test_the_stage_starts_no_job_for_what_the_raw_layer_says(spark, small):
    path = scratch_path(spark, "raw")
    layers.write_raw(mine(spark, small), path, *PERIOD)
    raw, found = spark.read.parquet(path), facts.load(spark, path)
    cleaned, jobs = jobs_of(spark, lambda: stage.complete(raw, stage.StageOptions(), found))
    assert jobs == 0
    again, jobs = jobs_of(spark, lambda: stage.complete(raw, stage.StageOptions()))
    assert jobs > 0
    assert cleaned.schema == again.schema
    reduced, jobs = jobs_of(spark, lambda: stage.drop_sparse_only(raw, facts=found))
    assert jobs == 0 and reduced.columns == stage.drop_sparse_only(raw).columns


def test_appended_rows_add_their_facts(spark, small):
    path, tables = scratch_path(spark, "raw"), mine(spark, small)
    middle = "2024-01-15 00:00:00"
    layers.write_raw(tables, path, PERIOD[0], middle)
    first = facts.load(spark, path).rows
    layers.write_raw(tables, path, middle, PERIOD[1], mode="append")
    found, raw = facts.load(spark, path), spark.read.parquet(path)
    plain = facts.column_facts(raw, True)
    assert 0 < first < found.rows == raw.count()
    assert found.present == plain.present and found.parsed == plain.parsed
