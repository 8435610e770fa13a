"""Small frames for the rules that decide correctness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.functions import numbers, text, times
from loadcycle.operators import cleaning, outliers
from loadcycle.operators import relational as rel
from loadcycle.plans import classify
from loadcycle.plans.presentation import consolidate
from loadcycle.sources import tables as io
from loadcycle.sources.scratch import scratch_path


def _value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def _column(df, name):
    return [r[name] for r in df.collect()]


# Numbers ------------------------------------------------------------------------------------

def test_zero_divisors(spark):
    one, zero = F.lit(1.0), F.lit(0.0)
    assert _value(spark, numbers.percentage(one, zero)) is None
    assert _value(spark, numbers.hourly_rate(one, zero)) is None
    assert _value(spark, numbers.ratio_or_zero(one, zero)) == 0.0


def test_dry_tonnes_fractional_and_truncated(spark):
    tenths, factor = F.lit(2555).cast("long"), F.lit(1700).cast("long")
    assert _value(spark, numbers.dry_tonnes(tenths, factor)) == pytest.approx(434.35)
    assert _value(spark, numbers.dry_tonnes(tenths, factor, integer_division=True)) == 255


@pytest.mark.parametrize("value, rounded", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (2.51, 3.0)])
def test_half_even(spark, value, rounded):
    assert _value(spark, numbers.round_half_even(F.lit(value))) == rounded


# Lists --------------------------------------------------------------------------------------

@pytest.mark.parametrize("value, tonnes, legacy", [
    ("[600 650]", 125.0, 125.0), ("[60.5 65.25]", 12.575, 713.0), ("{600,650}", 125.0, 125.0), ("0", 0.0, 0.0), ("", 0.0, 0.0),
])
def test_pass_tonnage_of_text(spark, value, tonnes, legacy):
    assert _value(spark, text.pass_tonnage(F.lit(value), T.StringType())) == pytest.approx(tonnes)
    assert _value(spark, text.pass_tonnage(F.lit(value), T.StringType(), legacy_digits=True)) == pytest.approx(legacy)


def test_pass_tonnage_of_arrays_and_bytes(spark):
    array = F.array(F.lit(60.5), F.lit(65.0), F.lit(None).cast("double"))
    kind = T.ArrayType(T.DoubleType())
    assert _value(spark, text.pass_tonnage(array, kind)) == pytest.approx(12.55)
    assert _value(spark, text.pass_tonnage(array, kind, legacy_digits=True)) == pytest.approx(67.0)
    assert _value(spark, text.pass_tonnage(F.encode(F.lit("{600,650}"), "UTF-8"), T.BinaryType())) == 125.0
    assert _value(spark, text.pass_tonnage(F.lit(None).cast("string"), T.StringType())) == 0.0


@pytest.mark.parametrize("value, count", [("{1,2,3}", 3), ("{7}", 1), ("{}", 0), (None, 0)])
def test_element_count_of_bytes(spark, value, count):
    assert _value(spark, text.element_count(F.encode(F.lit(value).cast("string"), "UTF-8"), T.BinaryType())) == count


def test_element_count_of_arrays(spark):
    kind = T.ArrayType(T.DoubleType())
    assert _value(spark, text.element_count(F.array(F.lit(1.0), F.lit(2.0)), kind)) == 2
    assert _value(spark, text.element_count(F.lit(None).cast(kind), kind)) == 0


# Times --------------------------------------------------------------------------------------

@pytest.mark.parametrize("value, moment", [
    ("2024-01-02 03:04:05.678", dt.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ("2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02", dt.datetime(2024, 1, 2)),
    ("13/02/2024", dt.datetime(2024, 2, 13)),
    ("13/02/2024 10:00:00", dt.datetime(2024, 2, 13, 10)),
    ("2024-01-02 03:04:05-05:00", dt.datetime(2024, 1, 2, 8, 4, 5)),
    ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("soon", None), ("2024-13-45", None), (None, None),
])
def test_parse_wall_time(spark, value, moment):
    assert _value(spark, times.parse_wall_time(F.lit(value).cast("string"))) == moment


def test_parsing_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        io.use_time_zone(spark, "America/New_York")
        assert _value(spark, times.parse_wall_time(F.lit("2024-03-10 02:30:00"))) == dt.datetime(2024, 3, 10, 2, 30)
        assert _value(spark, times.parse_wall_time(F.lit("2024-03-10 02:30:00Z"))) == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        io.use_time_zone(spark, before)


def test_zone_shift_and_difference(spark):
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    assert _value(spark, times.to_zone(noon, "America/Lima")) == dt.datetime(2024, 1, 1, 7)
    assert _value(spark, times.seconds_between(times.shift(noon, 999), noon)) == 0.999


# Cleaning -----------------------------------------------------------------------------------

def test_sparse_is_strictly_above(spark):
    df = spark.range(100).select(
        "id", F.when(F.col("id") >= 81, 1).alias("c81"), F.when(F.col("id") >= 80, 1).alias("c80"),
        F.when(F.col("id") >= 80, F.lit(1.0)).otherwise(F.lit(float("nan"))).alias("nan80"),
        F.when(F.col("id") >= 81, F.lit(1.0)).otherwise(F.lit(float("nan"))).alias("nan81"),
    )
    once = cleaning.drop_sparse_columns(df)
    assert once.columns == ["id", "c80", "nan80"]
    assert cleaning.drop_sparse_columns(once).columns == once.columns


def test_unreadable_dates_count_as_nulls(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 10, "2024-01-01").otherwise("later").alias("d"))
    facts = cleaning.column_facts(df, find_dates=True)
    assert facts.dates == ("d",) and facts.nulls()["d"] == 90 and facts.sparse() == ["d"]
    assert cleaning.column_facts(df).sparse() == []


def test_empty_frame_keeps_its_columns(spark):
    df = spark.createDataFrame([], "a long, b string")
    assert cleaning.drop_sparse_columns(df).columns == ["a", "b"]
    assert {r.percent for r in cleaning.null_profile(df).collect()} == {None}


def test_mode_takes_the_lowest_of_a_tie_and_skips_nulls(spark):
    df = spark.createDataFrame([(v, n) for v, n in zip("bbaac", [1.0, float("nan"), None, float("nan"), None])] + [(None, None)] * 5,
                               "s string, n double")
    assert _column(cleaning.mode_of(df, "s"), "value") == ["a"]
    assert _column(cleaning.impute_mode(df, ["n"]), "n") == [1.0] * 10
    empty = spark.createDataFrame([(None,), (None,)], "x string")
    assert _column(cleaning.impute_mode(empty, ["x"]), "x") == [None, None]


def test_fill_zero_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None, None, float("nan"))],
                               "n long, s string, f boolean, t timestamp_ntz, a array<long>, x double")
    assert cleaning.fill_zero(df).first() == (0, "0", False, None, None, 0.0)
    assert cleaning.fill_zero(df, skip=["s", "f"]).first()[1:3] == (None, None)


def test_dedup_does_not_depend_on_input_order(spark):
    rows = [(i // 3, float(i % 2), f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double, note string")
    first = cleaning.drop_duplicates_first(df, cleaning.comparable_columns(df), [], [])
    mixed = df.orderBy(F.rand(5)).repartition(7)
    second = cleaning.drop_duplicates_first(mixed, cleaning.comparable_columns(df), [], [])
    assert sorted(first.collect()) == sorted(second.collect())
    assert first.count() == len({(k, x) for k, x, _ in rows})


def test_flags(spark):
    df = spark.createDataFrame([("True", True), ("True", True), ("False", False), (None, None), (None, None), (None, None)],
                               "t string, b boolean")
    assert _column(cleaning.normalize_flag(df, ["t"]), "t") == [True, True, False, True, True, True]
    assert _column(cleaning.normalize_flag(df, ["b"]), "b") == [True, True, False, True, True, True]
    # nulls vote: '0' wins the text column, False the boolean one
    assert _column(cleaning.normalize_flag(df, ["t"], legacy_zero=True), "t") == [True, True, False, False, False, False]
    assert _column(cleaning.normalize_flag(df, ["b"], legacy_zero=True), "b") == [True, True, False, False, False, False]
    mostly = spark.createDataFrame([(True,), (True,), (True,), (False,), (None,)], "b boolean")
    assert _column(cleaning.normalize_flag(mostly, ["b"], legacy_zero=True), "b") == [True] * 5


def test_casts_cut_fractions_and_unreadable_flags_become_null(spark):
    df = spark.createDataFrame([(2.9, "no idea"), (-2.9, "False")], "n double, f string")
    got = cleaning.cast_columns(df, {"n": "long", "f": "boolean", "absent": "long"})
    assert got.collect() == [(2, None), (-2, False)]


# Relations ----------------------------------------------------------------------------------

def test_deleted_newest_version_takes_the_parent_out(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "p long")
    versions = spark.createDataFrame([(1, 10, None), (1, 11, "x"), (2, 12, "x"), (2, 13, None)], "k long, id long, tiem_elimin string")
    kept = rel.left_lookup(parents, rel.latest_per_key(versions, "k", "id"), "p", "k").where(F.col("tiem_elimin").isNull())
    assert sorted(kept.select("p", "id").collect(), key=str) == [(2, 13), (3, None)]


def test_state_rewrite_keeps_rows_with_passes(spark):
    df = spark.createDataFrame([("DELAY", 0), ("DELAY", 2), ("READY", 0), ("OTHER", 3), (None, 1)], "s string, n long")
    assert sorted(outliers.keep_ready(df, "s", "n").collect()) == [("READY", 1), ("READY", 2), ("READY", 3)]


def test_bounds_are_excluded(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x long")
    assert _column(rel.strictly_between(df, "x", 1, 3), "x") == [2]
    assert _column(rel.after(df, "x", 2), "x") == [3]


def test_top_rows_put_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "x long")
    assert _column(rel.first_rows(df, "x", 2), "x") == [1, 2]


def test_names_are_cleaned(spark):
    assert rel.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `c(d)` int")).columns == ["a_b", "c_d_"]


# Files and learning -------------------------------------------------------------------------

def test_write_modes(spark):
    path, df = scratch_path(spark, "modes"), spark.range(10)
    io.write_table(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        io.write_table(df, path)
    io.write_table(df, path, mode="append")
    assert io.read_table(spark, path).count() == 20
    io.write_table(df, path, mode="overwrite", partitions=3)
    assert io.read_parquet(spark, path).count() == 10


def test_only_parquet_files_are_read(spark):
    path = scratch_path(spark, "mixed")
    io.write_table(spark.range(3), path)
    spark.range(4).write.mode("append").csv(path)
    assert io.read_parquet_folder(spark, path).count() == 3


def test_consolidation_refuses_its_own_input(spark):
    for output in ("/data/in", "/data/in/out", "/data"):
        with pytest.raises(ValueError):
            consolidate(spark, "/data/in", output)


@pytest.mark.parametrize("low, high, parts", [(0, 9, 3), (5, 5, 4), (1, 100, 7)])
def test_key_ranges_cover_every_row_once(spark, low, high, parts):
    df = spark.range(low - 3, high + 4).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    ranges = io.key_ranges("id", low, high, parts)
    assert len(ranges) <= parts
    assert sum(df.where(p).count() for p in ranges) == df.count()


def test_query_with_bound_values(spark):
    got = io.run_query({"t": spark.range(10)}, "SELECT id FROM {t} WHERE id < :top", {"top": 3})
    assert _column(got, "id") == [0, 1, 2]


def test_split_is_stable_and_about_four_fifths(spark):
    df = spark.range(20_000)
    train, test = classify.split_by_key(df, "id")
    again, _ = classify.split_by_key(df.repartition(9), "id")
    assert train.count() + test.count() == 20_000 and abs(train.count() / 20_000 - 0.8) < 0.02
    assert train.exceptAll(again).count() == 0


def test_logistic_regression_learns(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 >= 10).cast("int").alias("y"))
    train, test = classify.split_by_key(df, "id")
    assert classify.accuracy(classify.fit_logistic(train, ["x"], "y"), test, "y") > 0.95


def test_a_model_scores_rows_after_the_session_observed_a_query(spark):
    from pyspark.sql import Observation

    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    df = spark.range(40).select("id", F.col("id").cast("double").alias("x"), (F.col("id") >= 20).cast("int").alias("y"))
    scored = classify.fit_logistic(df, ["x"], "y").transform(df)
    assert {r.id for r in scored.collect() if r.prediction != r.y} <= {19, 20}
