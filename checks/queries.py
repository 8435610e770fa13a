"""One query per operator over the supplied tables. Every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.mine_tables import PERIOD, machines, mine
from loadcycle.functions import numbers, text, times
from loadcycle.operators import cleaning, facts, intervals, ordered, outliers, quarantine, trees
from loadcycle.operators import relational as rel
from loadcycle.plans import classify, daily, layers
from loadcycle.plans.presentation import consolidate, presentation
from loadcycle.plans.raw import haul_cycles
from loadcycle.plans.stage import StageOptions, drop_sparse_only, stage_cycles
from loadcycle.sources import bucketed, manifest, versions
from loadcycle.sources import tables as io
from loadcycle.sources.scratch import cut, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return io.read_parquet(spark, f"{d}/{name}.parquet")


# Joins --------------------------------------------------------------------------------------

@_query
def left_dim_join(spark, d):
    orders, customer = _t(spark, d, "orders"), _t(spark, d, "customer")
    joined = rel.left_lookup(orders, customer, "o_custkey", "c_custkey")
    return rel.select_as(joined, {"order_id": "o_orderkey", "customer": "c_name", "segment": "c_mktsegment"})


@_query
def filtered_dim_join(spark, d):
    customer = _t(spark, d, "customer").withColumn(
        "tiem_elimin", F.when(F.col("c_custkey") % 9 == 4, F.lit("2023-06-01").cast("timestamp_ntz"))
    )
    joined = rel.left_lookup(_t(spark, d, "orders"), rel.alive(customer), "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@_query
def role_playing(spark, d):
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name")
    items = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    supplier = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    buyer, seller = rel.with_role(nation, "n_nationkey", "buyer"), rel.with_role(nation, "n_nationkey", "seller")
    df = rel.left_lookup(items, supplier, "l_suppkey", "s_suppkey")
    df = rel.left_lookup(df, seller, "s_nationkey", "n_nationkey_seller")
    df = rel.left_lookup(df, orders, "l_orderkey", "o_orderkey")
    df = rel.left_lookup(df, customer, "o_custkey", "c_custkey")
    df = rel.left_lookup(df, buyer, "c_nationkey", "n_nationkey_buyer")
    return df.select("l_orderkey", "l_partkey", "l_linenumber", "n_name_buyer", "n_name_seller")


def _machines(spark, d):
    return machines(_t(spark, d, "region"), _t(spark, d, "nation"), _t(spark, d, "supplier"))


@_query
def hierarchy(spark, d):
    tree = rel.three_level_tree(rel.alive(_machines(spark, d)), "id", "id_flota", "nombre", "isflota")
    return tree.select("id", "nombre", "id_secundario", "secundario", "id_principal", "principal")


@_query
def latest_per_key(spark, d):
    newest = rel.latest_per_key(_t(spark, d, "orders"), "o_custkey", "o_orderkey")
    joined = rel.left_lookup(_t(spark, d, "customer"), newest, "c_custkey", "o_custkey")
    kept = joined.where(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != "P"))
    return kept.select("c_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@_query
def lookup_two_levels(spark, d):
    start = _t(spark, d, "customer").select(
        "c_custkey", (F.lit(100) + F.col("c_nationkey")).cast("long").alias("place")
    )
    named = rel.names_up_the_tree(
        start, _machines(spark, d), "id", "id_flota", "nombre", "place", "nation_name", "region_name"
    )
    return named.select("c_custkey", "nation_name", "region_name")


@_query
def fanout_cut(spark, d):
    lines = _t(spark, d, "lineitem")
    order = rel.total_order(lines, [F.col("l_extendedprice").desc()], ["l_orderkey", "l_extendedprice"])
    top = rel.keep_one(lines, ["l_orderkey"], order)
    joined = rel.left_lookup(_t(spark, d, "orders"), top, "o_orderkey", "l_orderkey")
    return joined.select("o_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "o_totalprice")


@_query
def ready_time(spark, d):
    events = _t(spark, d, "events")
    states = events.select("user_id", "ts", "event_id", (F.col("event_type") == "view").alias("ready"))
    day = F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz")
    days = events.select("user_id", day.alias("day")).distinct()
    days = days.withColumn("next_day", times.shift(F.col("day"), 86_400_000))
    days = days.withColumn("row", F.col("user_id") * 100_000 + F.date_diff(F.col("day"), F.lit("2000-01-01")))
    bounds = ordered.slice_bounds(events, ["ts"])
    changes = cut(intervals.ready_changes(states, "user_id", "ts", "ready", "event_id", bounds), "changes")
    timed = intervals.ready_seconds(days, changes, "row", "user_id", {"seconds": ("day", "next_day")}, bounds)
    return timed.select("user_id", "day", "seconds")


# One row per key, neighbours ----------------------------------------------------------------

@_query
def state_per_key(spark, d):
    events = _t(spark, d, "events")
    last = rel.keep_one(events, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()])
    return last.select("user_id", "event_id", "ts", "event_type")


@_query
def prev_event(spark, d):
    events = _t(spark, d, "events").select("event_id", "user_id", "ts")
    return ordered.previous_in_group(events, "ts", ["user_id"], ["ts", "event_id"], "previous_ts")


# Filters and projections --------------------------------------------------------------------

@_query
def period_filter(spark, d):
    return io.run_query(
        {"events": _t(spark, d, "events")},
        "SELECT event_id, user_id, ts, value FROM {events} WHERE ts > CAST(:low AS TIMESTAMP_NTZ) AND ts < CAST(:high AS TIMESTAMP_NTZ)",
        {"low": "2024-01-05 00:00:00", "high": "2024-01-20 12:00:00"},
    )


@_query
def fleet_filter(spark, d):
    bounds = [F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-20 12:00:00")]
    found = rel.period_of_fleets(_t(spark, d, "events"), "ts", *bounds, "user_id", [5, 6, 7])
    return found.select("event_id", "user_id", "ts")


@_query
def outlier_filters(spark, d):
    lines = _t(spark, d, "lineitem")
    df = outliers.at_least(lines, "l_linenumber", 2)
    df = outliers.not_zero(df, "l_discount")
    df = outliers.above(df, "l_quantity", 5)
    df = outliers.above(df, "l_tax", 0)
    df = outliers.in_band(df, "l_extendedprice", 18000, 40000)
    return df.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@_query
def dimension_filters(spark, d):
    nation = _t(spark, d, "nation").withColumn("even", F.col("n_nationkey") % 2 == 0)
    nation = nation.where((F.col("n_regionkey") != 0) & F.col("even"))
    joined = rel.left_lookup(_t(spark, d, "customer"), nation, "c_nationkey", "n_nationkey").select("*")
    return joined.where(F.col("n_name").isNotNull()).select("c_custkey", "c_name", "n_name", "n_regionkey")


@_query
def min_date(spark, d):
    found = rel.after(_t(spark, d, "orders"), "o_orderdate", F.lit("1997-05-28 00:00:00").cast("timestamp_ntz"))
    return found.select("o_orderkey", "o_orderdate")


@_query
def state_rewrite(spark, d):
    events = _t(spark, d, "events").withColumns({
        "state": F.when(F.col("event_type") == "error", "DELAY").otherwise(F.col("event_type")),
        "passes": F.floor("value").cast("long") % 6,
    })
    kept = outliers.keep_ready(events, "state", "passes")
    ratio = numbers.round_half_even(F.col("value") / F.lit(4.0))
    return kept.select(
        "event_id", "state", "passes", outliers.when_enough(ratio, F.col("passes"), 4).alias("estimated_passes")
    )


@_query
def select_rename_drop(spark, d):
    orders = _t(spark, d, "orders").withColumn("price / unit", F.col("o_totalprice"))
    df = orders.drop("o_orderpriority", "not there").withColumnsRenamed({"o_custkey": "buyer", "not there": "x"})
    df = rel.clean_names(rel.select_present(df, ["o_orderkey", "buyer", "o_orderdate", "price / unit"]))
    return df.withColumnRenamed("price_/_unit", "price_per_unit").sortWithinPartitions("o_orderdate")


# Profiles -----------------------------------------------------------------------------------

def _gappy_orders(spark, d):
    return _t(spark, d, "orders").withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")),
    })


@_query
def null_profile(spark, d):
    return cleaning.null_profile(_gappy_orders(spark, d))


@_query
def drop_sparse(spark, d):
    nth = F.col("o_orderkey") % 100  # order keys are 0, 1, 2, ... without a gap
    return cleaning.drop_sparse_columns(_t(spark, d, "orders").select(
        "o_orderkey",
        F.when(nth >= 81, F.col("o_totalprice")).alias("c81"),
        F.when(nth >= 80, F.col("o_totalprice")).alias("c80"),
        F.when(nth >= 20, F.col("o_totalprice")).alias("c20"),
    ))


@_query
def mode_value(spark, d):
    return cleaning.mode_of(_gappy_orders(spark, d), "o_orderpriority")


@_query
def impute_mode(spark, d):
    return cleaning.impute_mode(_gappy_orders(spark, d), ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@_query
def minmax(spark, d):
    return rel.time_bounds(_t(spark, d, "events"), "ts")


@_query
def shape(spark, d):
    return rel.shape(_t(spark, d, "events"))


@_query
def distinct(spark, d):
    return _t(spark, d, "events").select("user_id", "event_type").distinct()


@_query
def topk(spark, d):
    return rel.first_rows(_t(spark, d, "orders"), "o_orderkey", 10).select("o_orderkey", "o_custkey", "o_orderdate")


# Repairs ------------------------------------------------------------------------------------

@_query
def ffill_offset(spark, d):
    key = F.col("event_id")
    events = _t(spark, d, "events").select("event_id", F.when(~((key < 2) | (key % 5).isin(2, 3)), F.col("ts")).alias("ts"))
    return ordered.fill_forward(events, ["ts"], "event_id", 3000)


@_query
def fill_zero(spark, d):
    gappy = _gappy_orders(spark, d).withColumn("late", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus") == "O"))
    return cleaning.fill_zero(gappy).select("o_orderkey", "o_totalprice", "o_orderpriority", "late")


@_query
def dedup_first(spark, d):
    first = [F.col("l_shipdate").asc_nulls_last()]
    return cleaning.drop_duplicates_first(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], first, ["l_shipdate"])


@_query
def dedup_comparable(spark, d):
    events = _t(spark, d, "events").select("user_id", F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"), "event_type", "props")
    subset = cleaning.comparable_columns(events)
    return cleaning.drop_duplicates_first(events, subset, [], [])


def _status_text(spark, d):
    flag = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "False")
    return _t(spark, d, "orders").select("o_orderkey", flag.alias("flag"), (flag == "True").alias("known"))


@_query
def normalize_bool(spark, d):
    return cleaning.normalize_flag(_status_text(spark, d), ["flag", "known"])


@_query
def normalize_bool_legacy(spark, d):
    return cleaning.normalize_flag(_status_text(spark, d), ["flag", "known"], legacy_zero=True)


@_query
def detect_dates(spark, d):
    day = F.col("o_orderdate")
    orders = _t(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("iso"),
        F.date_format(day, "dd/MM/yyyy").alias("slashed"),
        F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias("zoned"),
        "o_orderpriority",
    )
    return cleaning.localize_dates(orders, "America/Lima")


def _tonnage_text():
    q = (F.col("l_quantity") * 10).cast("long").cast("string")
    return F.concat(F.lit("["), q, F.lit(" "), F.col("l_discount").cast("string"), F.lit("  "), F.col("l_tax").cast("string"), F.lit("]"))


@_query
def pass_tonnage(spark, d):
    lines = _t(spark, d, "lineitem").withColumn("listed", _tonnage_text())
    kind = text.type_of(lines, "listed")
    as_bytes = F.encode(F.translate("listed", "[]", "{}"), "UTF-8")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        text.pass_tonnage(F.col("listed"), kind).alias("tonnes"),
        text.pass_tonnage(as_bytes, T.BinaryType()).alias("tonnes_of_bytes"),
        text.pass_tonnage(F.col("listed"), kind, legacy_digits=True).alias("tonnes_of_digits"),
    )


@_query
def element_count(spark, d):
    lines = _t(spark, d, "lineitem")
    numbers_up = F.expr("CASE WHEN l_linenumber = 1 THEN '' ELSE array_join(transform(sequence(2, l_linenumber), x -> CAST(x AS STRING)), ',') END")
    listed = F.encode(F.concat(F.lit("{"), numbers_up, F.lit("}")), "UTF-8")
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", text.element_count(listed, T.BinaryType()).alias("elements")
    )


@_query
def array_count(spark, d):
    vectors = _t(spark, d, "embeddings")
    return vectors.select("vec_id", text.element_count(F.col("embedding"), text.type_of(vectors, "embedding")).alias("elements"))


@_query
def rates(spark, d):
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    return _t(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        numbers.dry_tonnes(price, line).alias("dry"),
        numbers.dry_tonnes(F.col("l_partkey"), F.col("l_orderkey"), integer_division=True).alias("dry_whole"),
        numbers.hourly_rate(price, (line - 1) * 60).alias("per_hour"),
        numbers.rescale(price, 10).alias("rescaled"),
    )


@_query
def ratios(spark, d):
    value, rest = F.col("value"), F.col("event_id") % 5
    return _t(spark, d, "events").select(
        "event_id",
        numbers.percentage(value, rest).alias("percent"),
        numbers.ratio_or_zero(value, rest).alias("guarded"),
        numbers.distance(value, rest * 100).alias("apart"),
        numbers.share_of(rest.cast("double"), value).alias("share"),
        numbers.round_half_even((F.col("event_id") % 10) / F.lit(2.0)).alias("rounded"),
    )


@_query
def timestamps(spark, d):
    events = _t(spark, d, "events").select("event_id", "ts", F.col("ts").alias("moved"))
    moved = cleaning.shift_timestamps(events, ["moved"], 999)
    return moved.select(
        "event_id",
        "moved",
        times.shift(F.col("ts"), 3000).alias("later"),
        times.seconds_between(F.col("moved"), F.date_trunc("DAY", "ts").cast("timestamp_ntz")).alias("seconds"),
        times.format_and_parse(F.col("ts")).alias("again"),
        times.without_zone(F.col("ts").cast("timestamp")).alias("naive"),
        times.to_zone(F.col("ts"), "America/Lima").alias("lima"),
    )


@_query
def text_conversion(spark, d):
    vectors = _t(spark, d, "embeddings").withColumn("scaled", F.expr("transform(embedding, x -> CAST(CAST(x AS DOUBLE) * 1000 AS INT))"))
    return vectors.select(
        "vec_id",
        text.as_text(F.col("scaled"), text.type_of(vectors, "scaled")).alias("joined"),
        text.as_text(F.encode(F.col("label").cast("string"), "UTF-8"), T.BinaryType()).alias("decoded"),
        text.replace_values(F.col("label"), {0: 100, 1: 200}).alias("mapped"),
        F.coalesce(F.when(F.col("label") > 1, F.col("label")), F.lit(-1)).alias("coalesced"),
    )


@_query
def casts(spark, d):
    lines = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").alias("whole"),
        F.when(F.col("l_returnflag") == "A", "True").when(F.col("l_returnflag") == "N", "False").otherwise("?").alias("returned"),
    )
    types = {"l_extendedprice": "long", "whole": "long", "l_linenumber": "double", "returned": "boolean", "not there": "long"}
    return cleaning.cast_columns(lines, types)


@_query
def union_by_name(spark, d):
    events = _t(spark, d, "events").select("event_id", "event_type", "value")
    views = events.where(F.col("event_type") == "view").drop("value")
    return rel.union_by_name([views, events.where(F.col("event_type") != "view")])


def _five_levels(spark, d):
    """Regions, nations, suppliers, parts and customers as one tree; some customers' parents are missing, two suppliers form a loop."""
    nodes = [
        _t(spark, d, "region").selectExpr("CAST(r_regionkey AS BIGINT) AS id", "CAST(NULL AS BIGINT) AS up", "r_name AS name"),
        _t(spark, d, "nation").selectExpr("100 + CAST(n_nationkey AS BIGINT) AS id", "CAST(n_regionkey AS BIGINT) AS up", "n_name AS name"),
        _t(spark, d, "supplier").selectExpr(
            "1000000 + s_suppkey AS id",
            "CASE s_suppkey WHEN 1 THEN 1000002L WHEN 2 THEN 1000001L ELSE 100 + CAST(s_nationkey AS BIGINT) END AS up", "s_name AS name",
        ),
        _t(spark, d, "part").selectExpr("20000000 + p_partkey AS id", "1000000 + p_partkey % 10 AS up", "p_name AS name"),
        _t(spark, d, "customer").selectExpr(
            "300000000 + c_custkey AS id", "CASE WHEN c_custkey % 50 = 7 THEN -c_custkey ELSE 20000000 + c_custkey % 100 END AS up", "c_name AS name"
        ),
    ]
    return rel.union_by_name(nodes)


@_query
def tree_places(spark, d):
    return trees.tree_report(_five_levels(spark, d), "id", "up", "name")


@_query
def tree_closure(spark, d):
    return trees.closure(_five_levels(spark, d), "id", "up")


@_query
def all_modes(spark, d):
    """Modes of all columns of two tables, among them columns of nearly distinct values."""
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders = orders.withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    lines = _t(spark, d, "lineitem").select("l_quantity", "l_discount", "l_linenumber", "l_returnflag", "l_suppkey")
    found = cleaning.modes(orders, orders.columns)
    found |= cleaning.modes(lines, lines.columns)
    some_line = lines.agg((F.count(F.lit(1)) > 0).alias("some")).scalar()  # one row, if neither table is empty
    return orders.limit(1).where(some_line).select(*[m.alias(c) for c, m in found.items()])


@_query
def quarantined_lines(spark, d):
    """Every line with the rules it breaks, from the two tables into which one pass writes them."""
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice")
    rules = {
        "quantity": F.col("l_quantity") > 5, "tax": F.col("l_tax") != 0, "price": F.col("l_extendedprice").between(18000, 40000),
        "flag": F.nullif(F.col("l_linenumber"), F.lit(3)) > 0,
    }
    path = scratch_path(spark, "quarantine")
    told = quarantine.write_judged(lines, rules, path)
    kept = quarantine.kept(spark, path).withColumn("broken", F.lit(""))
    bad = quarantine.quarantined(spark, path).withColumn("broken", F.array_join("broken", ","))
    counts = {f"all_{name}": F.lit(told[name]).cast("long") for name in (*rules, "kept")}
    return kept.unionByName(bad).withColumns(counts).drop("l_quantity", "l_tax", "l_extendedprice")


@_query
def zone_of_the_session(spark, d):
    """Wall-clock times as instants, in a session of its own that is set to another zone."""
    session = spark.newSession()
    io.use_time_zone(session, "America/Lima")
    events = _t(session, d, "events")
    return events.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), F.date_format(F.col("ts").cast("timestamp"), "HH:mm").alias("shown"))


# Files --------------------------------------------------------------------------------------

@_query
def write_read(spark, d):
    path, orders = scratch_path(spark, "orders"), _t(spark, d, "orders")
    io.write_table(orders, path)
    io.write_table(orders, path, mode="overwrite", partitions=4, sort_by=["o_orderdate"])
    io.write_table(orders, path, mode="append")
    return io.read_table(spark, path)


@_query
def csv_read(spark, d):
    path = scratch_path(spark, "orders-csv")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    orders.write.csv(path, header=True)
    return io.read_csv(spark, path, orders.schema)


@_query
def consolidated(spark, d):
    folder, events = scratch_path(spark, "parts"), _t(spark, d, "events").select("event_id", "event_type", "value")
    io.write_table(events.where(F.col("event_type") == "view").drop("value"), folder)
    io.write_table(events.where(F.col("event_type") != "view"), folder, mode="append")
    return consolidate(spark, folder, scratch_path(spark, "whole"))


@_query
def csv_with_quotes(spark, d):
    """Quotes, line breaks and a header in another order than the declared one."""
    path, schema = scratch_path(spark, "quoted-csv"), "o_orderkey long, note string, o_totalprice double"
    note = F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('",\nthen '), F.col("o_orderpriority"))
    orders = _t(spark, d, "orders").select(note.alias("note"), "o_totalprice", F.lit(1).alias("more"), "o_orderkey")
    orders.write.option("escape", '"').csv(path, header=True)
    return io.read_csv(spark, path, schema)


@_query
def drifted_parts(spark, d):
    """One file has a column as whole numbers, the other as fractions, as writers do that turn gaps into fractions."""
    folder, orders = scratch_path(spark, "drift"), _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    io.write_table(orders.where(F.col("o_orderkey") % 2 == 0), folder)
    gaps = F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")).cast("double")
    io.write_table(orders.where(F.col("o_orderkey") % 2 == 1).withColumn("o_custkey", gaps), folder, mode="append")
    return consolidate(spark, folder, scratch_path(spark, "widened"))


@_query
def manifest_commits(spark, d):
    """Two commits of a folder to which files of other types were added in between; the rows of each schema by commit."""
    folder, orders = scratch_path(spark, "commits"), _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    io.write_table(orders.where(F.col("o_orderkey") % 3 == 0), folder)
    first = manifest.written_manifest(spark, folder)
    more = orders.where(F.col("o_orderkey") % 3 > 0).withColumn("o_custkey", F.col("o_custkey").cast("double"))
    io.write_table(more.drop("o_totalprice"), folder, mode="append")
    second = cut(manifest.read_manifest(spark, folder, first), "manifest")
    rows = manifest.read_files(spark, folder, second)
    seen = second.groupBy("commit").agg(F.sum("rows").alias("rows"), F.countDistinct("schema").alias("schemas"))
    price = rows.agg(F.count("o_totalprice").alias("priced"), F.sum("o_custkey").alias("keys"))
    return seen.select("commit", "rows", "schemas", price.select("priced").scalar().alias("priced"), price.select("keys").scalar().alias("keys"))


def _write_nanoseconds(df, folder):
    """Files with nanosecond times, one per task, as a pandas job writes them."""
    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs, parquet

        held = [batch for batch in batches if batch.num_rows]  # a task may get no rows, and then no batch that tells a schema
        if held:
            rows = pa.Table.from_batches(held)
            at = rows.schema.get_field_index("ts")
            rows = rows.set_column(at, "ts", rows.column("ts").cast(pa.timestamp("us")).cast(pa.timestamp("ns")))
            store, path = fs.FileSystem.from_uri(folder)
            store.create_dir(path, recursive=True)
            parquet.write_table(rows, f"{path}/{uuid.uuid4().hex}.parquet", filesystem=store)
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(batch.num_rows for batch in held)], pa.int64())})

    df.mapInArrow(write, "n long").agg(F.sum("n")).first()


@_query
def nanosecond_parts(spark, d):
    folder = scratch_path(spark, "nanoseconds")
    _write_nanoseconds(_t(spark, d, "events").select("event_id", "ts"), folder)
    return io.read_parquet_folder(spark, folder, nanoseconds=["ts"])


# Layers -------------------------------------------------------------------------------------

@_query
def raw_cycles(spark, d):
    return haul_cycles(mine(spark, d), *PERIOD)


def _raw_file(spark, d):
    """The written raw layer and its facts."""
    path = scratch_path(spark, "raw")
    layers.write_raw(mine(spark, d), path, *PERIOD)
    return io.read_table(spark, path), facts.load(spark, path)


@_query
def staged_cycles(spark, d):
    raw, found = _raw_file(spark, d)
    return stage_cycles(raw, facts=found)


@_query
def staged_min_passes(spark, d):
    raw, found = _raw_file(spark, d)
    return stage_cycles(raw, StageOptions(min_passes=4, find_dates=False), found)


@_query
def staged_reduced(spark, d):
    raw, found = _raw_file(spark, d)
    return drop_sparse_only(raw, facts=found)


@_query
def presented_cycles(spark, d):
    raw, found = _raw_file(spark, d)
    return presentation(stage_cycles(raw, facts=found))


@_query
def layered_run(spark, d):
    return layers.run(mine(spark, d), scratch_path(spark, "layers"), low=PERIOD[0], high=PERIOD[1])


@_query
def quarantined_cycles(spark, d):
    """The cycles that the stage leaves out, each with the rules it breaks, and those it keeps with none."""
    path, stage = scratch_path(spark, "raw"), scratch_path(spark, "stage")
    layers.write_raw(mine(spark, d), path, *PERIOD)
    layers.write_judged_stage(spark, path, stage, StageOptions(min_passes=4))
    bad = quarantine.quarantined(spark, stage).withColumn("broken", F.array_join("broken", ","))
    kept = quarantine.kept(spark, stage).withColumn("broken", F.lit(""))
    return kept.unionByName(bad).select("id_ciclo_acarreo", "numero_pases_carguio", "tonelaje_pases", "broken")


DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


@_query
def daily_raw(spark, d):
    """The raw layer of three days, added one by one."""
    folder = scratch_path(spark, "daily")
    for day in DAYS:
        daily.refresh(mine(spark, d), folder, day)
    return versions.read(spark, f"{folder}/raw")


@_query
def bucketed_passes(spark, d):
    """The newest sensor row of each cycle's load and the newest version of its shovel, from facts laid out by these keys."""
    tables = bucketed.write_facts(mine(spark, d), scratch_path(spark, "facts"))
    cycles = tables["tp_cargadescarga"].select("id", "id_palas", "id_cargadescarga", "tiem_llegada", "tonelajevims")
    passes = rel.latest_per_key(rel.alive(tables["ta_datacarga_sensores"]), "id_cargadescarga", "id")
    shovels = rel.latest_per_key(tables["tp_palas"], "id_palas", "id")
    wide = rel.left_join_spreading_nulls(cycles.alias("c"), passes.alias("p"), "c.id_cargadescarga", "p.id_cargadescarga", "c.id")
    wide = rel.left_join_spreading_nulls(wide, shovels.alias("s"), "c.id_palas", "s.id_palas", "c.id")
    return wide.select(
        F.col("c.id").alias("id"), F.col("c.tiem_llegada").alias("arrival"), F.col("c.tonelajevims").alias("payload"),
        F.col("p.id").alias("id_pases"), F.col("s.id").alias("id_ciclo_carguio"), F.col("s.tiem_elimin").alias("gone"),
    )


# Learning -----------------------------------------------------------------------------------

def _quality(spark, d):
    documents = _t(spark, d, "documents").select(
        "doc_id",
        F.log1p(F.col("n_chars")).alias("log_chars"),
        F.log1p(F.size(F.split("text", r"\s+"))).alias("log_words"),
        F.try_divide(F.length(F.regexp_replace("text", r"[^A-Za-z]", "")), F.length("text")).alias("letters"),
    )
    return documents.fillna(0.0).join(_t(spark, d, "labels"), "doc_id")


@_query
def train_test_split(spark, d):
    train, test = classify.split_by_key(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@_query
def logistic_regression(spark, d):
    train, test = classify.split_by_key(_quality(spark, d), "doc_id")
    model = classify.fit_logistic(train, ["log_chars", "log_words", "letters"], "quality")
    scored = model.transform(test).select("doc_id", "quality", F.col("prediction").cast("int").alias("predicted"))
    return scored.withColumn("accuracy", F.lit(classify.accuracy(model, test, "quality")))


@_query
def accuracy_of_a_rule(spark, d):
    """The share of labelled documents that a fixed rule gets right."""
    scored = _quality(spark, d).withColumn("guess", (F.col("log_chars") > 7).cast("int"))
    return classify.accuracy_of(scored, "quality", "guess").select(F.round("accuracy", 9).alias("accuracy"))


@_query
def regression_gradient(spark, d):
    """The fit has found the maximum: its gradient over all training rows is zero."""
    train, _ = classify.split_by_key(_quality(spark, d), "doc_id")
    features = ["log_chars", "log_words", "letters"]
    found = classify.gradient(classify.fit_logistic(train, features, "quality"), train, features, "quality")
    return found.select("feature", (F.round("gradient", 3) + F.lit(0.0)).alias("gradient"))
