"""Modes in two passes, rows in quarantine, trees of any depth, quoted CSV in many tasks."""

import pytest
from pyspark.sql import functions as F

from loadcycle.operators import cleaning, quarantine, trees
from loadcycle.sources import csv_records, versions
from loadcycle.sources import tables as io
from tests.test_facts import jobs_of

# Modes --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def values(spark):
    n = F.col("id")
    return spark.range(0, 20_000, 1, 5).select(
        (n % 7).alias("even"), F.when(n % 2 == 0, F.lit("b")).when(n % 4 == 1, F.lit("a")).alias("word"),
        F.when(n % 10 < 4, F.lit(2.5)).when(n % 10 < 8, F.lit(1.5)).when(n % 10 == 8, F.lit(float("nan"))).alias("tie"),
        n.alias("distinct"), F.lit(None).cast("long").alias("none"), (n % 3 == 0).alias("flag"),
        F.when(n % 100 < 30, F.lit(-1)).otherwise(n).alias("one of many"), F.when(n == 5, F.lit(4)).alias("single"),
        (n % 3000).cast("int").alias("flat"), F.date_add(F.lit("2024-01-01").cast("date"), (n % 3).cast("int")).alias("day"),
    )


def test_modes_are_those_of_a_count_of_all_values(spark, values):
    found = spark.range(1).select(*[m.alias(c) for c, m in cleaning.modes(values, values.columns).items()])
    assert found.schema.simpleString() == values.schema.simpleString()
    want = {c: (cleaning.mode_of(values, c).first() or [None])[0] for c in values.columns}
    assert found.first().asDict() == want
    assert want["tie"] == 1.5 and want["even"] == 0 and want["distinct"] == 0 and want["single"] == 4


def test_all_modes_in_two_passes(spark, values):
    proven = ["even", "word", "tie", "flag", "one of many"]
    found, jobs = jobs_of(spark, lambda: cleaning.modes(values, proven))
    assert jobs <= 4  # two aggregates of a map and a final stage each
    assert not any("subquery" in str(m).lower() for m in found.values())
    seen = cleaning.modes(values, ["distinct", "flat"])
    plan = values.select(*[m.alias(c) for c, m in seen.items()])._jdf.queryExecution().toString()
    assert "scalar-subquery" in plan.lower()  # what a sketch cannot prove is counted


def test_modes_of_nothing(spark, values):
    none = values.limit(0)
    found = spark.range(1).select(*[m.alias(c) for c, m in cleaning.modes(none, none.columns).items()])
    assert set(found.first()) == {None}
    assert cleaning.modes(values, []) == {}


# Quarantine ---------------------------------------------------------------------------------

@pytest.fixture
def rules(spark):
    return {k: F.expr(v) for k, v in {"big": "n >= 10", "not three": "n % 3 != 0", "known": "v IS NOT NULL", "low": "v < 50"}.items()}


def _numbers(spark):
    return spark.range(0, 100, 1, 6).select(F.col("id").alias("n"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))


def test_kept_and_quarantined_are_the_input(spark, tmp_path, rules):
    rows, path = _numbers(spark), str(tmp_path / "q")
    told, jobs = jobs_of(spark, lambda: quarantine.write_judged(rows, rules, path))
    assert jobs == 1
    good, bad = quarantine.kept(spark, path), quarantine.quarantined(spark, path)
    plain = rows
    for rule in rules.values():
        plain = plain.where(rule)
    assert sorted(good.collect()) == sorted(plain.collect()) and good.columns == rows.columns
    assert sorted(good.unionByName(bad.drop("broken")).collect(), key=repr) == sorted(rows.collect(), key=repr)
    assert told == {"rows": 100, "kept": good.count(), "big": 10, "not three": 34, "known": 20, "low": 60}
    assert {r.rule: r.rows for r in quarantine.rule_counts(bad).collect()} == {k: told[k] for k in rules}
    assert bad.where("n = 0").first().broken == ["big", "not three", "known", "low"]
    assert versions.current(spark, path).told["kept"] == told


@pytest.mark.parametrize("rule, good", [("true", 100), ("false", 0), ("CAST(NULL AS BOOLEAN)", 0)])
def test_one_side_may_be_empty(spark, tmp_path, rule, good):
    path, rule = str(tmp_path / "q"), F.expr(rule)
    quarantine.write_judged(_numbers(spark), {"only": rule}, path)
    assert quarantine.kept(spark, path).count() == good and quarantine.quarantined(spark, path).count() == 100 - good
    quarantine.write_judged(_numbers(spark).limit(0), {"only": rule}, path)
    assert quarantine.kept(spark, path).count() == quarantine.quarantined(spark, path).count() == 0
    assert quarantine.write_judged(_numbers(spark), {}, path) == {"rows": 100, "kept": 100}


# Trees --------------------------------------------------------------------------------------

def _tree(spark):
    rows = [(1, 0, "r"), (2, 1, "a"), (3, 2, "b"), (4, 3, "c"), (5, 4, "d"), (6, None, "lone"), (7, 99, "orphan"), (8, 7, "below")]
    rows += [(10, 11, "x"), (11, 12, "y"), (12, 10, "z"), (13, 12, "hang"), (14, 14, "self")]
    return spark.createDataFrame(rows, "id long, up long, name string")


def test_places_in_a_tree(spark):
    found = {r.node: (r.level, r.top, r.kind, r.path) for r in trees.tree_report(_tree(spark), "id", "up", "name", 0).collect()}
    assert found[5] == (4, 1, "tree", "r/a/b/c/d") and found[1] == (0, 1, "tree", "r") and found[6] == (0, 6, "tree", "lone")
    assert found[7] == (0, 7, "orphan", "orphan") and found[8] == (1, 7, "orphan", "orphan/below")
    assert {n: found[n][2] for n in (10, 11, 12, 13, 14)} == {n: "loop" for n in (10, 11, 12, 13, 14)}
    assert found[13][0] == 3 and found[14] == (0, 14, "loop", "self")
    assert len(found) == 13


def test_closure_has_each_ancestor_once(spark):
    found = {(r.node, r.ancestor): r.distance for r in trees.closure(_tree(spark), "id", "up").collect()}
    assert {a: d for (n, a), d in found.items() if n == 5} == {4: 1, 3: 2, 2: 3, 1: 4}
    assert {a: d for (n, a), d in found.items() if n == 13} == {12: 1, 10: 2, 11: 3}
    assert trees.closure(_tree(spark).limit(0), "id", "up").count() == 0


def test_a_chain_too_deep_is_an_error_not_a_cut(spark):
    chain = spark.range(30).selectExpr("id", "id - 1 AS up", "CAST(id AS STRING) AS name")
    assert trees.closure(chain, "id", "up").count() == 30 * 29 // 2
    with pytest.raises(Exception, match="(?i)recursion"):
        trees.closure(chain, "id", "up", levels=10).count()


# CSV ----------------------------------------------------------------------------------------

@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_quoted_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    """Records lie across blocks, one over several of them; quotes are doubled, lines end either way."""
    rows = [(i, ('say "x", ' + "line\n" * (i % 4) + ("deep\n" * 1500 if i == 40 else "")) if i % 3 else f"plain {i}", i / 4) for i in range(300)]
    for name, end in (("a", "\n"), ("b", "\r\n")):
        text = "note,extra,key,price" + end
        for key, note, price in rows:
            shown = '"' + note.replace('"', '""') + '"' if key % 3 else note
            text += f"{shown},{key},{key},{price}{end}"
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    found = io.read_csv(spark, str(tmp_path / "a.csv"), "key long, note string, price double")
    assert csv_records._lines(spark, str(tmp_path / "a.csv")).select("block").distinct().count() > 5
    assert sorted(map(tuple, found.collect())) == rows
    both = io.read_csv(spark, str(tmp_path / "*.csv"), "key long, note string, price double")
    assert sorted(map(tuple, both.collect())) == sorted(rows * 2)


def test_headers_must_agree_and_values_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n")
    assert [tuple(r) for r in io.read_csv(spark, str(tmp_path), "v long, k long").collect()] == [(2, 1)]
    (tmp_path / "b.csv").write_text("v,k\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        io.read_csv(spark, str(tmp_path), "v long, k long").collect()
    (tmp_path / "b.csv").write_text("k,v\n1,two\n")
    with pytest.raises(Exception, match="(?i)malformed|cannot be cast|two"):
        io.read_csv(spark, str(tmp_path), "v long, k long").collect()
    (tmp_path / "b.csv").write_text("k,v\n")
    assert io.read_csv(spark, str(tmp_path), "v long, k long").count() == 1


@pytest.mark.parametrize("lines", [1, 3])
def test_quoted_records_go_on_over_pieces(spark, tmp_path, monkeypatch, lines):
    monkeypatch.setattr(csv_records, "LINES", lines)
    notes = ["plain", 'a "quoted"\nline\n\n\nand more', "x,y", "\n\n", "end"]
    cells = ["n,note\n"] + [f'{i},"{n.replace(chr(34), chr(34) * 2)}"\n' for i, n in enumerate(notes)]
    (tmp_path / "a.csv").write_text("".join(cells))
    (tmp_path / "b.csv").write_text("".join(cells[:2]))
    found = io.read_csv(spark, str(tmp_path), "n int, note string")
    assert sorted((r.n, r.note) for r in found.collect()) == sorted([*enumerate(notes), (0, "plain")])
    numbers = csv_records.records(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(r.number for r in numbers) == [1, 2, 3, 4, 5, 6]
    pieces = csv_records._lines(spark, str(tmp_path / "a.csv")).groupBy("file", "block", "piece").count()
    assert pieces.agg({"count": "max"}).first()[0] <= lines
