"""What the layers move and leave on disk: wide rows only where they must, shuffle files and scratch tables not longer than needed."""

import os

import pytest
from pyspark.sql import functions as F

from checks.mine_tables import PERIOD, mine
from loadcycle.functions import times
from loadcycle.operators import facts, ordered
from loadcycle.operators import relational as rel
from loadcycle.plans import layers, stage
from loadcycle.plans.presentation import presentation
from loadcycle.plans.raw import haul_cycles
from loadcycle.sources.scratch import _RELEASE, cut, scratch_path, shuffles_released


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(os.path.basename(path).startswith("shuffle_") for path in found.split("\n"))


@pytest.fixture(scope="module")
def raw(spark, small):
    path = scratch_path(spark, "raw")
    layers.write_raw(mine(spark, small), path, *PERIOD)
    return path


def test_a_written_table_leaves_no_shuffle_files(spark):
    spark.conf.unset(_RELEASE)
    spark._jvm.System.gc()
    before = _shuffle_files(spark)
    held = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    written = cut(held, "counts")
    assert _shuffle_files(spark) <= before and written.count() == 100
    assert spark.conf.get(_RELEASE, None) in (None, "false")
    with shuffles_released(spark), shuffles_released(spark):
        assert spark.conf.get(_RELEASE) == "true"
    assert spark.conf.get(_RELEASE, None) in (None, "false")


def test_the_raw_layer_leaves_no_scratch_tables(spark, small):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    path = scratch_path(spark, "raw")
    before = set(os.listdir(folder))
    layers.write_raw(mine(spark, small), path, *PERIOD)
    new = set(os.listdir(folder)) - before
    assert new == {os.path.basename(path)}


def test_the_stage_reads_the_raw_layer_and_no_copy_of_it(spark, raw):
    """Rules and the choice of columns reach the scan; the wide rows are not written once more."""
    staged = stage.stage_cycles(spark.read.parquet(raw), facts=facts.load(spark, raw))
    plan = staged._jdf.queryExecution().toString()
    assert os.path.basename(raw) in " ".join(staged.inputFiles())
    optimized = plan[plan.index("== Optimized Logical Plan =="):plan.index("== Physical Plan ==")]
    assert "tonelajevims" in optimized and "Union" in optimized
    shown = _plan(staged.select("tiempo_inicio_carga_carguio"))
    assert "velocidadgpsvacio" not in shown and "coorzniveldescarga" not in shown.split("ReadSchema")[1].split("repeated")[0]


def test_only_rows_with_a_gap_move_for_the_fill(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("t"), F.lit("x").alias("wide"))
    df = cut(df, "gaps")
    filled = ordered.fill_forward(df, ["t"], "id", 1000, ordered.slice_bounds(df, ["id"]))
    union, plan = _plan(filled), filled._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in union and plan.index("Union") < plan.index("Join LeftOuter")
    left = plan[plan.index("Join LeftOuter"):].split("\n")[1]
    assert "Filter" in left and "isnull(t" in left
    assert filled.where("t IS NULL").count() == 1 and filled.count() == 1000  # nothing before the first id


def test_rows_that_may_be_equal_go_to_one_side(spark):
    odd = spark.range(2000).select("id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("y"))
    twice = odd.unionByName(odd.where("id % 50 = 0"))
    single, repeated = rel.split_by_marks(twice, ["id", "x", "y"], rel.repeated_marks(twice, ["id", "x", "y"]))
    assert repeated.where("id % 50 = 0").count() == 80 and repeated.count() < 100
    assert single.count() + repeated.count() == 2040 and single.where("id % 50 = 0").count() == 0
    assert "hashpartitioning(id" not in _plan(single) and single.columns == twice.columns
    none = twice.limit(0)
    assert [x.count() for x in rel.split_by_marks(none, ["x"], rel.repeated_marks(none, ["x"]))] == [0, 0]


def test_duplicates_of_raw_cycles_go_with_and_without_gaps(spark, raw):
    df = spark.read.parquet(raw)
    # rows without an id, twice, and all rows twice; without an id, the cycle 0 is its own duplicate
    nameless = df.where("id_ciclo_acarreo % 20 = 0").withColumn("id_ciclo_acarreo", F.lit(None).cast("long"))
    some = df.unionByName(nameless)
    once, _ = stage.judged_stage(cut(some, "some"))
    twice, _ = stage.judged_stage(cut(some.unionByName(some).unionByName(nameless), "twice"))
    assert df.where("id_ciclo_acarreo = 0").count() == 1
    key = ["id_ciclo_acarreo", "id_cargadescarga_ciclo", "tiempo_llegada_camion", "tiempo_inicio_carga_carguio"]
    found = [sorted(map(tuple, x.select(key).collect()), key=str) for x in (once, twice)]
    assert found[0] == found[1] and len(found[0]) == df.count() + nameless.count() - 1


def test_an_id_whose_newest_cycle_has_no_factor_goes(spark, small):
    tables = dict(mine(spark, small))
    cycles = tables["tp_cargadescarga"]
    chosen = haul_cycles(tables, *PERIOD).select(F.min("id_ciclo_acarreo")).first()[0]
    newer = cycles.where((F.col("id") == chosen) & F.col("tiem_llegada").between(*PERIOD)).orderBy(F.desc("tiem_llegada")).limit(1)
    newer = newer.withColumns({"tiem_llegada": F.expr("tiem_llegada + INTERVAL 1 SECOND"), "id_factor": F.lit(99).cast("long")})
    tables["tp_cargadescarga"] = cycles.unionByName(newer)
    assert haul_cycles(tables, *PERIOD).where(F.col("id_ciclo_acarreo") == chosen).count() == 0


def test_every_text_that_can_be_read_as_a_time_passes_the_cheap_test(spark):
    texts = ["2024-01-02", " 2024-01-02 03:04:05", "\t02/01/2024", "2024", "+2024-01-02", "-0001-01-01", "T12:30:00", "12:30", "\u00012024-01-02",
             "2024-01-02T03:04:05Z", "word", "", "  ", "Ñ2024-01-02", " 2024-01-02", "x 2024-01-02", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    read, passed = times.parse_wall_time(F.col("t")).isNotNull(), F.coalesce(times.may_be_time(F.col("t")), F.lit(False))
    assert rows.where(read & ~passed).count() == 0 < rows.where(read & passed).count()
    assert rows.where(F.col("t") == "word").where(passed).count() == 0


def _new_tables(spark, work):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    work()
    return {name for name in set(os.listdir(folder)) - before if os.listdir(f"{folder}/{name}")}


def test_the_judged_stage_leaves_its_own_table_only(spark, raw):
    path = scratch_path(spark, "judged")
    new = _new_tables(spark, lambda: layers.write_judged_stage(spark, raw, path, stage.StageOptions(min_passes=4)))
    assert {name for name in new if not name.startswith("run-")} == {os.path.basename(path)}


def test_rules_of_the_presentation_reach_the_scan_of_the_raw_layer(spark, raw):
    shown = presentation(stage.stage_cycles(spark.read.parquet(raw), facts=facts.load(spark, raw)))
    assert os.path.basename(raw) in " ".join(shown.inputFiles())
    filters = [line for line in _plan(shown).split("\n") if "PushedFilters" in line and "tonelajevims" in line.split("ReadSchema")[0]]
    assert filters


def test_fewest_passes_without_dates_read_the_raw_layer(spark, raw):
    options = stage.StageOptions(min_passes=4, find_dates=False)
    staged = stage.stage_cycles(spark.read.parquet(raw), options, facts.load(spark, raw))
    assert os.path.basename(raw) in " ".join(staged.inputFiles())
    plain = stage.stage_cycles(spark.read.parquet(raw), options)  # without facts, gaps are looked for in every text that becomes a time
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect()))


def test_joins_of_small_tables_copy_few_values(spark, small):
    """Every joined row holds packed rows and keys, not a hundred columns."""
    top = haul_cycles(mine(spark, small), *PERIOD)._jdf.queryExecution().optimizedPlan()
    assert top.output().size() == 156
    assert top.children().head().output().size() < 30


def test_counts_and_dates_are_observed_apart(spark, raw):
    observed = facts.Observed(spark.read.parquet(raw), ["id_ciclo_acarreo"])
    assert _plan(observed.rows).count("CollectMetrics") == 2
    observed.rows.write.format("noop").mode("overwrite").save()
    assert observed.facts().rows == facts.load(spark, raw).rows
