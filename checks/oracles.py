"""DuckDB SQL that must return what the query of the same name returns."""

from __future__ import annotations

from checks.mine_sql import MINE, mine_oracles

_GAPPY = """gappy AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders)"""

_STATUS = """status AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' END AS flag,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS known FROM orders)"""

_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls,"
    f" 100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS percent FROM gappy"
    for c in "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
)

_FIVE_LEVELS = """nodes AS (
    SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS up, r_name AS name FROM region
    UNION ALL SELECT 100 + n_nationkey, n_regionkey, n_name FROM nation
    UNION ALL SELECT 1000000 + s_suppkey, CASE s_suppkey WHEN 1 THEN 1000002 WHEN 2 THEN 1000001 ELSE 100 + s_nationkey END, s_name FROM supplier
    UNION ALL SELECT 20000000 + p_partkey, 1000000 + p_partkey % 10, p_name FROM part
    UNION ALL SELECT 300000000 + c_custkey, CASE WHEN c_custkey % 50 = 7 THEN -c_custkey ELSE 20000000 + c_custkey % 100 END, c_name FROM customer),
  climb AS (
    SELECT id AS node, id AS ancestor, up, CAST(0 AS BIGINT) AS distance, [id] AS seen, name AS path FROM nodes
    UNION ALL SELECT c.node, n.id, n.up, c.distance + 1, list_append(c.seen, n.id), n.name || '/' || c.path
    FROM climb c JOIN nodes n ON n.id = c.up WHERE NOT list_contains(c.seen, n.id))"""

_ORACLES = {
    "left_dim_join": """SELECT o_orderkey AS order_id, c_name AS customer, c_mktsegment AS segment
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "filtered_dim_join": """SELECT o_orderkey, o_custkey, c_name
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 9 <> 4""",
    "role_playing": """SELECT l_orderkey, l_partkey, l_linenumber, b.n_name AS n_name_buyer, s.n_name AS n_name_seller
        FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation s ON s.n_nationkey = s_nationkey
        LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation b ON b.n_nationkey = c_nationkey""",
    "hierarchy": f"""WITH {MINE} SELECT c.id, c.nombre, g.id AS id_secundario, g.nombre AS secundario, r.id AS id_principal,
        r.nombre AS principal FROM ts_equipos c JOIN ts_equipos g ON g.id = c.id_flota JOIN ts_equipos r ON r.id = g.id_flota
        WHERE r.id_flota = 0 AND c.id_flota <> 0 AND NOT c.isflota
        AND c.tiem_elimin IS NULL AND g.tiem_elimin IS NULL AND r.tiem_elimin IS NULL""",
    "latest_per_key": """SELECT c_custkey, o_orderkey, o_orderstatus, o_totalprice FROM customer LEFT JOIN
        (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) o
        ON o_custkey = c_custkey WHERE coalesce(o_orderstatus, '') <> 'P'""",
    "lookup_two_levels": """SELECT c_custkey, n_name AS nation_name, r_name AS region_name FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "fanout_cut": """SELECT o_orderkey, l_partkey, l_linenumber, l_extendedprice, o_totalprice
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY l_extendedprice DESC NULLS LAST, l_partkey, l_suppkey,
          l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "ready_time": """WITH spans AS (SELECT user_id, event_type, ts AS since,
          coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '2100-01-01') AS until FROM events),
        days AS (SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events)
        SELECT d.user_id, d.day, coalesce(sum(epoch_us(least(until, day + INTERVAL 1 DAY)) - epoch_us(greatest(since, day)))
          FILTER (WHERE since IS NOT NULL), 0) / 1e6 AS seconds FROM days d LEFT JOIN spans s ON s.user_id = d.user_id AND event_type = 'view'
          AND since < day + INTERVAL 1 DAY AND until > day GROUP BY ALL""",
    "state_per_key": """SELECT user_id, event_id, ts, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "prev_event": """SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_ts
        FROM events""",
    "period_filter": """SELECT event_id, user_id, ts, value FROM events
        WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
    "fleet_filter": """SELECT event_id, user_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00'
        AND ts < TIMESTAMP '2024-01-20 12:00:00' AND user_id IN (5, 6, 7)""",
    "outlier_filters": """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
        FROM lineitem WHERE l_linenumber >= 2 AND l_discount <> 0 AND l_quantity > 5 AND l_tax > 0
        AND l_extendedprice BETWEEN 18000 AND 40000""",
    "dimension_filters": """SELECT c_custkey, c_name, n_name, n_regionkey FROM customer JOIN nation
        ON n_nationkey = c_nationkey WHERE n_regionkey <> 0 AND n_nationkey % 2 = 0""",
    "min_date": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1997-05-28 00:00:00'",
    "state_rewrite": """SELECT event_id, 'READY' AS state, CAST(trunc(value) AS BIGINT) % 6 AS passes,
        CASE WHEN CAST(trunc(value) AS BIGINT) % 6 >= 4 THEN round_even(value / 4, 0) END AS estimated_passes
        FROM events WHERE CAST(trunc(value) AS BIGINT) % 6 > 0""",
    "select_rename_drop": "SELECT o_orderkey, o_custkey AS buyer, o_orderdate, o_totalprice AS price_per_unit FROM orders",
    "null_profile": f"WITH {_GAPPY} {_COUNTS}",
    "drop_sparse": """SELECT o_orderkey, CASE WHEN n >= 80 THEN o_totalprice END AS c80,
        CASE WHEN n >= 20 THEN o_totalprice END AS c20
        FROM (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) % 100 AS n FROM orders)""",
    "mode_value": f"""WITH {_GAPPY} SELECT o_orderpriority AS value FROM gappy WHERE o_orderpriority IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""",
    "impute_mode": f"""WITH {_GAPPY}, top AS (SELECT o_orderpriority AS v FROM gappy WHERE o_orderpriority IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM top)) AS o_orderpriority FROM gappy""",
    "minmax": 'SELECT min(ts) AS "first", max(ts) AS "last" FROM events',
    "shape": "SELECT count(*) AS rows, CAST(6 AS BIGINT) AS columns FROM events",
    "distinct": "SELECT user_id, event_type FROM events GROUP BY ALL",
    "topk": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderkey NULLS LAST LIMIT 10",
    "ffill_offset": """WITH gappy AS (SELECT event_id, CASE WHEN event_id >= 2 AND event_id % 5 NOT IN (2, 3) THEN ts END AS t
          FROM events)
        SELECT event_id, coalesce(t, last_value(t IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING)
          + INTERVAL 3 SECOND) AS ts FROM gappy""",
    "fill_zero": f"""WITH {_GAPPY} SELECT o_orderkey, coalesce(o_totalprice, 0) AS o_totalprice,
        coalesce(o_orderpriority, '0') AS o_orderpriority,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus = 'O' ELSE false END AS late FROM gappy""",
    "dedup_first": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "dedup_comparable": """SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_type, props) = 1""",
    "normalize_bool": f"""WITH {_STATUS}, vote AS (SELECT flag AS f, known AS k FROM status WHERE flag IS NOT NULL
        GROUP BY 1, 2 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT o_orderkey, CAST(coalesce(flag, f) AS BOOLEAN) AS flag, coalesce(known, k) AS known FROM status, vote""",
    "normalize_bool_legacy": f"""WITH {_STATUS},
        texts AS (SELECT coalesce(flag, '0') AS f FROM status GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
        flags AS (SELECT coalesce(known, false) AS k FROM status GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT o_orderkey, CASE coalesce(flag, f) WHEN 'True' THEN true ELSE false END AS flag,
        CASE WHEN k THEN true ELSE coalesce(known, false) END AS known FROM status, texts, flags""",
    "detect_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate - INTERVAL 5 HOUR END AS iso,
        date_trunc('day', o_orderdate) - INTERVAL 5 HOUR AS slashed, o_orderdate - INTERVAL 7 HOUR AS zoned, o_orderpriority
        FROM orders""",
    "pass_tonnage": """SELECT l_orderkey, l_partkey, l_linenumber, (trunc(l_quantity * 10) + l_discount + l_tax) / 10 AS tonnes,
        (trunc(l_quantity * 10) + l_discount + l_tax) / 10 AS tonnes_of_bytes,
        (trunc(l_quantity * 10) + CAST(replace(CAST(l_discount AS VARCHAR), '.', '') AS DOUBLE)
          + CAST(replace(CAST(l_tax AS VARCHAR), '.', '') AS DOUBLE)) / 10 AS tonnes_of_digits FROM lineitem""",
    "element_count": "SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_linenumber - 1 AS BIGINT) AS elements FROM lineitem",
    "array_count": "SELECT vec_id, len(embedding) AS elements FROM embeddings",
    "rates": """SELECT l_orderkey, l_partkey, l_linenumber, (l_extendedprice / 10) * (l_linenumber / 1000) AS dry,
        (l_partkey // 10) * (l_orderkey // 1000) AS dry_whole,
        l_extendedprice / nullif((l_linenumber - 1) * 60 / 3600, 0) AS per_hour, l_extendedprice / 10 AS rescaled FROM lineitem""",
    "ratios": """SELECT event_id, value / nullif(event_id % 5, 0) * 100 AS percent,
        coalesce(value / nullif(event_id % 5, 0), 0) AS guarded, abs(value - event_id % 5 * 100) AS apart,
        (event_id % 5 / 100) * value AS share, round_even((event_id % 10) / 2, 0) AS rounded FROM events""",
    "timestamps": """SELECT event_id, ts + INTERVAL 999 MILLISECOND AS moved, ts + INTERVAL 3 SECOND AS later,
        (epoch_us(ts + INTERVAL 999 MILLISECOND) - epoch_us(CAST(date_trunc('day', ts) AS TIMESTAMP))) / 1e6 AS seconds,
        ts AS again, ts AS naive, ts - INTERVAL 5 HOUR AS lima FROM events""",
    "text_conversion": """SELECT vec_id,
        array_to_string(list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 1000) AS INTEGER)), ',') AS joined,
        CAST(label AS VARCHAR) AS decoded, CASE label WHEN 0 THEN 100 WHEN 1 THEN 200 ELSE label END AS mapped,
        CASE WHEN label > 1 THEN label ELSE -1 END AS coalesced FROM embeddings""",
    "casts": """SELECT l_orderkey, l_partkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
        CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice, CAST(trunc(l_quantity) AS BIGINT) AS whole,
        CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS returned FROM lineitem""",
    "union_by_name": """SELECT event_id, event_type FROM events WHERE event_type = 'view' UNION ALL BY NAME
        SELECT event_id, event_type, value FROM events WHERE event_type <> 'view'""",
    "write_read": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "csv_read": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "csv_with_quotes": """SELECT o_orderkey, 'say "' || o_orderstatus || '",' || chr(10) || 'then ' || o_orderpriority AS note,
        o_totalprice FROM orders""",
    "drifted_parts": """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_custkey % 5 > 0
        THEN CAST(o_custkey AS DOUBLE) END AS o_custkey FROM orders""",
    "tree_closure": f"WITH RECURSIVE {_FIVE_LEVELS} SELECT node, ancestor, distance FROM climb WHERE distance > 0",
    "tree_places": f"""WITH RECURSIVE {_FIVE_LEVELS} SELECT node, distance AS level, ancestor AS top,
        CASE WHEN up IS NULL THEN 'tree' WHEN list_contains(seen, up) THEN 'loop' ELSE 'orphan' END AS kind, path
        FROM climb QUALIFY row_number() OVER (PARTITION BY node ORDER BY distance DESC) = 1""",
    "all_modes": "SELECT " + ", ".join(
        f"(SELECT {c} FROM (SELECT *, o_orderpriority = '1-URGENT' AS urgent FROM orders) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS {c}"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "urgent")
    ) + ", " + ", ".join(
        f"(SELECT {c} FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS {c}"
        for c in ("l_quantity", "l_discount", "l_linenumber", "l_returnflag", "l_suppkey")
    ),
    "quarantined_lines": """WITH j AS (SELECT *, coalesce(l_quantity > 5, false) AS a, coalesce(l_tax <> 0, false) AS b,
          coalesce(l_extendedprice BETWEEN 18000 AND 40000, false) AS c, coalesce(l_linenumber <> 3 AND l_linenumber > 0, false) AS e FROM lineitem)
        SELECT l_orderkey, l_partkey, l_linenumber, concat_ws(',', CASE WHEN NOT a THEN 'quantity' END, CASE WHEN NOT b THEN 'tax' END,
          CASE WHEN NOT c THEN 'price' END, CASE WHEN NOT e THEN 'flag' END) AS broken,
          count(*) FILTER (NOT a) OVER () AS all_quantity, count(*) FILTER (NOT b) OVER () AS all_tax,
          count(*) FILTER (NOT c) OVER () AS all_price, count(*) FILTER (NOT e) OVER () AS all_flag,
          count(*) FILTER (a AND b AND c AND e) OVER () AS all_kept FROM j""",
    "zone_of_the_session": """SELECT event_id, epoch_us(ts + INTERVAL 5 HOUR) AS micros, strftime(ts, '%H:%M') AS shown FROM events""",
    "manifest_commits": """SELECT commit, rows, CAST(1 AS BIGINT) AS schemas, priced, keys FROM (
        SELECT 1 + CAST(o_orderkey % 3 > 0 AS BIGINT) AS commit, count(*) AS rows FROM orders GROUP BY 1),
        (SELECT count(*) FILTER (o_orderkey % 3 = 0) AS priced, CAST(sum(o_custkey) AS DOUBLE) AS keys FROM orders)""",
    "nanosecond_parts": "SELECT event_id, ts FROM events",
    "train_test_split": """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) % 100 < 80
        THEN 'train' ELSE 'test' END AS part FROM orders""",
    "accuracy_of_a_rule": """SELECT round(avg(CASE WHEN (ln(1 + n_chars) > 7) = (quality = 1) THEN 1e0 ELSE 0e0 END), 9) AS accuracy
        FROM documents JOIN labels USING (doc_id)""",
    "regression_gradient": """SELECT unnest(['intercept', 'log_chars', 'log_words', 'letters']) AS feature, 0e0 AS gradient""",
    "consolidated": "SELECT event_id, event_type, CASE WHEN event_type <> 'view' THEN value END AS value FROM events",
}


def all_oracles() -> dict[str, str]:
    return {**_ORACLES, **mine_oracles()}
