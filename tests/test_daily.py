"""Days added one by one, and tables whose parts are replaced all at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.mine_tables import mine
from loadcycle.operators import facts
from loadcycle.plans import daily, raw, stage
from loadcycle.plans.presentation import presentation
from loadcycle.sources import versions
from loadcycle.sources.scratch import scratch_path
from tests import mine_fixture as by_hand

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def _hashes(df):
    return sorted(r[0] for r in df.select(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])).collect())


@pytest.fixture(scope="module")
def three_days(spark, small):
    folder, changed = scratch_path(spark, "days"), []
    for day in DAYS:
        changed.append(daily.refresh(mine(spark, small), folder, day))
    return folder, changed


def test_days_one_by_one_are_one_run_over_all(spark, small, three_days):
    folder, changed = three_days
    assert changed[0] == DAYS[:1] and all(c[-1] == d for c, d in zip(changed, DAYS))
    assert any(len(c) > 1 for c in changed)  # cycles of an evening that load after midnight
    whole = raw.haul_cycles(mine(spark, small), "2023-12-31 23:59:59.999999", "2024-01-04 00:00:00")
    got = versions.read(spark, daily.Layers(spark, folder).raw)
    assert got.schema.simpleString() == whole.schema.simpleString() and _hashes(got) == _hashes(whole)


def test_facts_of_days_add_up_and_the_stage_is_that_of_one_run(spark, three_days):
    layers = daily.Layers(spark, three_days[0])
    rows, found = versions.read(spark, layers.raw), layers.facts()
    plain = facts.column_facts(rows, True)
    assert (found.rows, found.present, found.dates) == (plain.rows, plain.present, plain.dates)
    staged = stage.stage_cycles(rows, facts=found)
    assert _hashes(staged) == _hashes(stage.stage_cycles(rows))


def test_the_last_day_again_changes_nothing(spark, small, three_days):
    folder, _ = three_days
    layers = daily.Layers(spark, folder)
    before, number = _hashes(versions.read(spark, layers.raw)), versions.current(spark, layers.raw).number
    daily.refresh(mine(spark, small), folder, DAYS[-1])
    assert _hashes(versions.read(spark, layers.raw)) == before
    assert versions.current(spark, layers.raw).number == number + 1
    with pytest.raises(ValueError, match="days come in order"):
        daily.refresh(mine(spark, small), folder, DAYS[0])


def test_what_crosses_midnight(spark):
    """A load after midnight reaches its cycle of the evening before; an id that arrives again leaves its first day."""
    tables = by_hand.tables(spark)
    first, second = by_hand.DAY.strftime("%Y-%m-%d"), (by_hand.DAY + dt.timedelta(days=1)).strftime("%Y-%m-%d")
    again = tables["tp_cargadescarga"].where("id = 1").limit(1)
    moved = {c: F.col(c) + F.expr("INTERVAL 1 DAY") for c in ("tiem_llegada", "tiem_carga", "tiem_acarreo")}
    late = tables["tp_cargadescarga"].where("id = 11").limit(1).withColumns(
        {"id": F.lit(50).cast("long"), "id_palas": F.lit(3).cast("long")}
        | {c: F.col(c) + F.expr("INTERVAL 2 HOURS") for c in ("tiem_llegada", "tiem_carga", "tiem_acarreo")}
    )
    tables["tp_cargadescarga"] = tables["tp_cargadescarga"].unionByName(again.withColumns(moved)).unionByName(late)
    folder = scratch_path(spark, "midnight")
    daily.refresh(tables, folder, first)
    path = daily.Layers(spark, folder).raw
    evening = {r.id_ciclo_acarreo for r in versions.read(spark, path, [first]).collect()}
    assert 1 in evening
    assert daily.refresh(tables, folder, second) == [first, second]
    assert {r.id_ciclo_acarreo for r in versions.read(spark, path, [first]).collect()} == evening - {1}
    whole = raw.haul_cycles(tables, by_hand.DAY - dt.timedelta(microseconds=1), by_hand.DAY + dt.timedelta(days=2))
    assert _hashes(versions.read(spark, path)) == _hashes(whole)


def test_all_layers_of_a_day(spark, small):
    folder = scratch_path(spark, "one-day")
    shown = daily.run(mine(spark, small), folder, "2024-01-05")
    layers = daily.Layers(spark, folder)
    assert _hashes(shown) == _hashes(presentation(versions.read(spark, layers.stage)))
    assert shown.count() > 0


# Versions -----------------------------------------------------------------------------------

def _fails_half_way(df):
    """Rows of which some tasks are written before one of them fails."""
    return df.withColumn("n", F.when(F.spark_partition_id() < 5, F.col("n")).otherwise(F.raise_error(F.lit("killed")).cast("long")))


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(0, 100, 1, 8).select(F.col("id").alias("n"))
    versions.replace(rows, path)
    old = versions.read(spark, path)
    with pytest.raises(Exception, match="killed"):
        versions.replace(_fails_half_way(rows.withColumn("n", F.col("n") + 1000)), path)
    assert versions.read(spark, path).agg(F.sum("n")).first()[0] == 4950
    again = versions.replace(rows.withColumn("n", F.col("n") + 1), path)
    assert again.agg(F.sum("n")).first()[0] == 5050
    assert old.agg(F.sum("n")).first()[0] == 4950  # a reader that began before still reads what it began with
    assert len(versions.clean(spark, path)) == 2 and versions.clean(spark, path) == []
    assert versions.read(spark, path).agg(F.sum("n")).first()[0] == 5050


def test_parts_are_committed_together(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(10).select(F.col("id").alias("n"))
    with pytest.raises(ValueError, match="no commit"):
        versions.read(spark, path)
    a, b = versions.stage_part(rows, path, "a"), versions.stage_part(rows, path, "b")
    versions.commit(spark, path, {"a": a, "b": b}, rows.schema, {"a": 1, "b": 2})
    assert versions.read(spark, path).count() == 20 and versions.read(spark, path, ["a", "x"]).count() == 10
    versions.commit(spark, path, {"a": None}, rows.schema)
    assert versions.current(spark, path).told == {"b": 2} and versions.read(spark, path, ["a"]).count() == 0
    assert versions.read(spark, path).count() == 10
