"""The same results in ANSI SQL, for the driver's comparison."""

from __future__ import annotations

NULLED = (
    "SELECT event_id, ts, user_id, event_type, "
    "CASE WHEN event_type <> 'view' THEN value END AS value, "
    "CASE WHEN event_type <> 'click' THEN props END AS props FROM events"
)


def latest(source: str, columns: str, floor: str = "") -> str:
    """Newest event per user unless it is an error."""
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM ({source}) {floor})
WHERE rn = 1 AND event_type <> 'error'"""


def history(source: str, columns: list[str], tracked: list[str]) -> str:
    """Versions with validity; a new one starts where a tracked column changes."""
    differs = " ".join(f"OR {c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    last = ", ".join(f"last({c} ORDER BY ts) AS {c}" for c in columns)
    return f"""
WITH c AS (
  SELECT *, (event_type = 'error') AS d,
    CASE WHEN lag(ts) OVER w IS NULL OR event_type = 'error' OR lag(event_type = 'error') OVER w {differs}
    THEN 1 ELSE 0 END AS ch
  FROM ({source}) WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c),
g AS (SELECT user_id, run, {last}, min(ts) AS s, bool_or(d) AS d FROM r GROUP BY user_id, run),
x AS (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY run) AS e FROM g)
SELECT user_id, {', '.join(columns)}, s AS "__START_AT", e AS "__END_AT" FROM x WHERE NOT d"""


def filled(filled_columns: list[str], plain: list[str]) -> str:
    """Newest event per user, with the newest value that is not null since the last error."""
    parts = [f"arg_max({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in filled_columns]
    parts += [f"last({c} ORDER BY ts) AS {c}" for c in plain]
    return f"""
WITH n AS ({NULLED}),
l AS (SELECT user_id, max(ts) AS ld FROM n WHERE event_type = 'error' GROUP BY user_id)
SELECT n.user_id, {', '.join(parts)}
FROM n LEFT JOIN l USING (user_id) WHERE ld IS NULL OR ts > ld GROUP BY n.user_id"""


FILLED_EVENTS = f"""
SELECT user_id, ts, event_type,
  last_value(CASE WHEN event_type = 'error' THEN NULL ELSE value END IGNORE NULLS)
    OVER (PARTITION BY user_id, epoch ORDER BY ts) AS value
FROM (SELECT *, count(*) FILTER (WHERE event_type = 'error')
        OVER (PARTITION BY user_id ORDER BY ts) AS epoch FROM ({NULLED}))"""

SNAPSHOTS = """
SELECT period, user_id, event_type, value FROM (
  SELECT date_diff('day', first, CAST(ts AS DATE)) // width + 1 AS period, user_id,
    arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
  FROM events, (SELECT first, CAST(ceil((date_diff('day', first, last) + 1) / 5) AS BIGINT) AS width FROM (
    SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events))
  GROUP BY 1, 2) WHERE event_type <> 'error'"""


def snapshot_history(tracked: list[str]) -> str:
    differs = " ".join(f"OR lag({c}) OVER w IS DISTINCT FROM {c}" for c in tracked)
    return f"""
WITH m AS (
  SELECT *, CASE WHEN lag(period) OVER w IS DISTINCT FROM period - 1 {differs} THEN 1 ELSE 0 END AS ch
  FROM ({SNAPSHOTS}) WINDOW w AS (PARTITION BY user_id ORDER BY period)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY period) AS run FROM m)
SELECT user_id, arg_max(event_type, period) AS event_type, arg_max(value, period) AS value,
  CAST(min(period) AS BIGINT) AS "__START_AT",
  CAST(CASE WHEN max(period) = 5 THEN NULL ELSE max(period) + 1 END AS BIGINT) AS "__END_AT"
FROM r GROUP BY user_id, run"""


def rule(effect: str, name: str, predicate: str, source: str) -> str:
    return (
        f"SELECT '{effect}' AS effect, '{name}' AS rule, "
        f"count(*) FILTER (WHERE coalesce({predicate}, false)) AS passed, "
        f"count(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS failed FROM {source}"
    )


KEPT_CUSTOMERS = "c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE'"
USER = "user_id, event_type, value"
TRUNCATE = "event_type = 'signup' AND value > 300"
FLOOR = (
    f"WHERE NOT coalesce({TRUNCATE}, false) AND "
    f"ts > coalesce((SELECT max(ts) FROM events WHERE {TRUNCATE}), TIMESTAMP '1900-01-01')"
)
EVENTS = "SELECT * FROM events"
FANOUT = """
SELECT 'building' AS target, c_custkey AS id, c_name AS name, c_acctbal AS balance
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'rich', c_custkey, upper(c_name), c_acctbal
FROM customer WHERE c_acctbal > 5000 AND c_mktsegment <> 'FURNITURE'
UNION ALL SELECT 'everyone', c_custkey, c_mktsegment, c_acctbal FROM customer"""
PARTIES = """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier"""
RESCUED_JSON = """
SELECT
  CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value,
  CASE event_type
    WHEN 'error' THEN '{"event_id":' || event_id || ',"user_id":' || user_id
      || ',"event_type":"error","value":' || value
    WHEN 'view' THEN '{"value":"none"}'
    WHEN 'click' THEN '{"extra":"x"}' END AS _rescued_data
FROM events"""
USER_SPECS = """
SELECT o_orderpriority AS "dataFlowGroup", CAST(o_custkey AS VARCHAR) AS "dataFlowId",
  'v' || max(o_orderkey) AS version, arg_max(o_totalprice, o_orderkey) AS price
FROM orders {} GROUP BY 1, 2"""
AUDITED = ("customer", "orders", "lineitem", "supplier", "part", "events", "documents", "pages")
COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows" for t in AUDITED
)


def synthetic(column: int) -> str:
    return f"CAST((o_orderkey * 1103515245 + {12345 + 7919 * column}) % 1000 AS BIGINT) AS col_{column}"


def violation(condition: str, problem: str) -> str:
    return (
        f"SELECT CAST(o_custkey AS VARCHAR) AS data_flow_id, '{problem}' AS problem "
        f"FROM orders WHERE {condition}"
    )


CUSTOMER_METRICS = " UNION ALL ".join([
    rule("warn", "has_name", "c_name IS NOT NULL", "customer"),
    rule("warn", "rich", "c_acctbal > 5000", "customer"),
    rule("drop", "positive", "c_acctbal >= 0", "customer"),
    rule("drop", "no_cars", "c_mktsegment <> 'AUTOMOBILE'", "customer"),
])

ORACLES = {
    "cdc_scd1": latest(EVENTS, USER),
    "cdc_scd2": history(EVENTS, ["event_type", "value"], ["event_type", "value"]),
    "cdc_scd2_track": history(EVENTS, ["event_type", "value"], ["event_type"]),
    "cdc_scd2_track_except": history(EVENTS, ["event_type", "value", "props"], ["props"]),
    "cdc_truncate": latest(EVENTS, USER, FLOOR),
    "cdc_ignore_null": filled(["event_type", "value"], []),
    "cdc_ignore_null_cols": filled(["value"], ["event_type", "props"]),
    "cdc_ignore_null_except": filled(["event_type", "props"], ["value"]),
    "cdc_ignore_null_scd2": history(FILLED_EVENTS, ["event_type", "value"], ["event_type", "value"]),
    "cdc_where_columns": latest("SELECT * FROM events WHERE event_type <> 'click' AND value > 1", USER),
    "cdc_sequence_expression": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P'""",
    "cdc_target_schema": """
SELECT 'event_id:bigint,user_id:bigint,event_type:string,value:double,'
  || '__START_AT:timestamp_ntz,__END_AT:timestamp_ntz' AS columns, count(*) AS rows FROM events""",
    "cdc_stream_scd1": latest(EVENTS, USER),
    "cdc_stream_scd2": history(EVENTS, ["event_type", "value"], ["event_type", "value"]),
    "cdc_late_events": filled(["event_type", "value"], []),
    "cdc_late_events_scd2": history(NULLED, ["event_type", "value"], ["event_type", "value"]),
    "cdc_late_truncate": latest(NULLED, USER, FLOOR),
    "snapshot_scd1": f"SELECT user_id, event_type, value FROM ({SNAPSHOTS}) WHERE period = 5",
    "snapshot_scd2": snapshot_history(["event_type", "value"]),
    "snapshot_scd2_track": snapshot_history(["event_type"]),
    "snapshot_history": snapshot_history(["event_type", "value"]),
    "dq_drop": f"SELECT * FROM customer WHERE {KEPT_CUSTOMERS}",
    "dq_quarantine": "SELECT * FROM customer WHERE c_acctbal < 0",
    "dq_warn_metrics": CUSTOMER_METRICS,
    "dq_rule_counts": " UNION ALL ".join([
        rule("warn", "open", "o_orderstatus = 'O'", "orders"),
        rule("fail", "priced", "o_totalprice > 1000", "orders"),
        rule("drop", "urgent", "o_orderpriority IN ('1-URGENT', '2-HIGH')", "orders"),
    ]),
    "dq_merge_alias": "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_name IS NOT NULL",
    "dq_unknown_fails": f"SELECT * FROM ({NULLED}) WHERE coalesce(value < 50, false)",
    "dq_fail": """
SELECT CASE WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'solvent' ELSE '' END AS broken_rule,
  count(*) FILTER (WHERE c_acctbal < 0) AS failed,
  count(*) FILTER (WHERE c_acctbal < 0) = 0 AS written, count(*) AS input_rows FROM customer""",
    "dq_on_cdc": f"""
SELECT *, 'table' AS place FROM ({latest("SELECT * FROM events WHERE value > 5", USER)})
UNION ALL SELECT {USER}, 'quarantine' FROM events WHERE value > 200""",
    "dq_on_snapshots": f"""
SELECT user_id, event_type, value, 'table' AS place FROM ({SNAPSHOTS}) WHERE period = 5 AND value > 5
UNION ALL SELECT user_id, event_type, value, 'quarantine' FROM ({SNAPSHOTS}) WHERE value > 100""",
    "silver_project_filter": """
SELECT * FROM (SELECT o_orderkey AS order_id, concat(o_orderstatus, '-', o_orderpriority) AS label,
  o_totalprice * 2 AS doubled FROM orders)
WHERE doubled > 100000 AND (label LIKE 'O-%' OR label LIKE 'F-1%')""",
    "custom_transform": "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS band FROM part",
    "fanout_segment": FANOUT,
    "fanout_flows": FANOUT,
    "append_flows": PARTIES,
    "append_flow_once": PARTIES,
    "table_stream": "SELECT * FROM part",
    "kafka_decode": """
SELECT event_id AS "offset", CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(minute(ts) AS INTEGER) AS minute, event_id, user_id, event_type, value FROM events""",
    "file_stream_json_rescue": RESCUED_JSON,
    "json_rescue_batch": RESCUED_JSON,
    "json_rescue_lossless": """
SELECT CASE WHEN whole THEN NULL ELSE event_id END AS event_id,
  CAST(CASE WHEN whole OR event_type = 'view' THEN NULL ELSE user_id END AS INTEGER) AS user_id,
  CASE WHEN whole THEN NULL ELSE event_type END AS event_type,
  CASE WHEN whole OR event_type = 'purchase' THEN NULL ELSE value END AS value,
  CASE event_type WHEN 'view' THEN '{"user_id":' || user_id || '.5}'
    WHEN 'purchase' THEN '{"value":"0' || value || '"}'
    WHEN 'click' THEN line || '{"c":3}' WHEN 'error' THEN line || ' tail' END AS _rescued_data
FROM (SELECT *, event_type IN ('click', 'error') AS whole, '{"event_id":' || event_id || ',"user_id":' || user_id
  || ',"event_type":"' || event_type || '","value":' || value || '}' AS line FROM events)""",
    "file_stream_csv_by_name": """
SELECT CAST(NULL AS VARCHAR) AS "Op", event_id, CAST(user_id AS INTEGER) AS user_id, event_type, value,
  CAST(NULL AS VARCHAR) AS _rescued_data FROM events
UNION ALL SELECT 'U', -event_id - 1, CAST(user_id AS INTEGER), event_type,
  CASE WHEN event_type = 'view' THEN NULL ELSE value END,
  CASE event_type WHEN 'view' THEN '{"value":"none"}' WHEN 'click' THEN '{"extra":"x"}' END FROM events""",
    "csv_rescue_batch": """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal, CAST(NULL AS VARCHAR) AS s_region,
  '{' || CASE WHEN s_acctbal < 0 THEN '"s_acctbal":"owes",' ELSE '' END || '"note":"' || s_name || '"}'
    AS _rescued_data FROM supplier""",
    "file_stream_inferred": """
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""",
    "file_stream_orc": "SELECT * FROM supplier",
    "file_metadata_cols": """
SELECT event_type, count(*) AS rows, count(*) AS named, count(*) AS agreeing FROM events GROUP BY event_type""",
    "partitioned_write": "SELECT *, '00' || substr(o_orderpriority, 1, 1) AS code FROM orders",
    "clustered_write": "SELECT * FROM lineitem",
    "repeated_batch": "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY o_orderstatus",
    "catalog_table": "SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey",
    "spec_latest": USER_SPECS.format(""),
    "spec_select": USER_SPECS.format("WHERE o_orderpriority = '1-URGENT'"),
    "spec_upsert": """
WITH n AS (SELECT o_custkey AS id, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS st,
    arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS amount FROM orders GROUP BY o_custkey),
m AS (SELECT CASE WHEN st = 'P' THEN -id - 1 ELSE id END AS id, st, amount FROM n)
SELECT coalesce(c.c_custkey, m.id) AS id,
  CASE WHEN c.c_custkey IS NOT NULL THEN c.c_name ELSE m.st END AS "createdBy",
  CASE WHEN m.id IS NOT NULL THEN m.amount ELSE c.c_acctbal END AS amount
FROM customer c FULL JOIN m ON c.c_custkey = m.id""",
    "spec_silver_join": """
SELECT o_orderkey AS "dataFlowId", c_name || ',' || c_mktsegment AS select_exp,
  CASE WHEN c_acctbal > 0 THEN 'amount > 0' ELSE '' END AS where_clause
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "spec_violations": " UNION ALL ".join([
        violation("o_orderstatus = 'P'", "bronze_database is missing"),
        violation("o_orderpriority = '1-URGENT'", "source_format is not known"),
        violation("o_orderstatus = 'F'", "sequence_by is missing in bronze_cdc_apply_changes"),
        violation("o_orderstatus = 'F'", "apply_as_truncates needs scd_type 1 in bronze_cdc_apply_changes"),
        "SELECT CAST(o_custkey AS VARCHAR), 'data_flow_id occurs more than once' "
        "FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    ]),
    "spec_export_json": """
WITH s AS (SELECT lower(c_mktsegment) AS id, count(*) AS n FROM customer GROUP BY 1)
SELECT '[' || string_agg('{"data_flow_id":"' || id || '","data_flow_group":"cars","n":' || n || '}', ','
  ORDER BY id) || ']' AS records FROM s""",
    "onboarded_run": history(EVENTS, ["event_type", "value"], ["event_type", "value"]),
    "reconcile_counts": f"""
WITH e AS (SELECT k AS table_name, n * v AS expected_rows FROM (SELECT count(*) AS n FROM customer),
    (VALUES ('customer', 1), ('orders', 10), ('lineitem', 40), ('region', 1)) t(k, v))
SELECT coalesce(c.table_name, e.table_name) AS table_name, expected_rows, rows,
  CASE WHEN rows = expected_rows THEN 'passed' ELSE 'failed' END AS result
FROM ({COUNTS}) c FULL JOIN e ON c.table_name = e.table_name""",
    "reconcile_at_least": f"""
SELECT table_name, (SELECT count(*) FROM supplier) AS expected_rows, rows,
  CASE WHEN rows >= (SELECT count(*) FROM supplier) THEN 'passed' ELSE 'failed' END AS result
FROM ({COUNTS})""",
    "synthetic_feed": f"SELECT o_orderkey AS id, {', '.join(synthetic(i) for i in range(1, 6))} FROM orders",
    "dq_metrics_clustered": CUSTOMER_METRICS,
    "dq_metrics_partitioned": CUSTOMER_METRICS,
    "checkpoint_reset": "SELECT 'append' AS target, * FROM orders UNION ALL SELECT 'type1', * FROM orders",
    "file_stream_new_columns": """
SELECT event_id, user_id, event_type, value, CASE WHEN event_type <> 'view' THEN props END AS props FROM events""",
    "file_stream_changed_types": """
SELECT event_id, CAST(CASE WHEN event_type IN ('view', 'click') THEN user_id
    ELSE user_id + 10000000000000000000::HUGEINT END AS DECIMAL(20, 0)) AS user_id, event_type,
  CASE event_type WHEN 'view' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
    WHEN 'click' THEN CAST(value AS VARCHAR) ELSE 'v' || value END AS value FROM events""",
    "declared_table": """
SELECT 'region.' || n_regionkey AS key, CAST(count(*) AS VARCHAR) AS value FROM nation GROUP BY n_regionkey
UNION ALL SELECT 'comment', 'nations of ' || count(DISTINCT n_regionkey) || ' regions' FROM nation""",
    "bronze_cdc_to_silver": f"""
SELECT * FROM ({latest(EVENTS, "user_id, upper(event_type) AS event_type, value")}) WHERE value > 10""",
    "spec_audit_columns": """
SELECT CAST(c_custkey AS VARCHAR) AS "dataFlowId", 'v3' AS version, 'me' AS "createdBy", 'me' AS "updatedBy",
  true AS same_time, true AS just_now, CASE WHEN rich THEN 'header,sep' ELSE 'header' END AS options,
  CASE WHEN rich THEN 'note,path' ELSE 'path' END AS details,
  CASE WHEN rich THEN 'database,path,table' ELSE 'database,table' END AS place,
  CASE WHEN rich THEN '{"keys":["id"],"sequence_by":"ts","scd_type":"1"}' END AS "cdcApplyChanges"
FROM (SELECT *, c_acctbal > 5000 AS rich FROM customer)""",
    "spec_projection_files": """
SELECT CAST(c_custkey AS VARCHAR) AS "dataFlowId", c_mktsegment AS target,
  concat('id,', chr(39), c_mktsegment, chr(39), ' AS segment') AS select_exp, 'id > 0' AS where_clause FROM customer""",
    "snapshot_keys": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS keys, count(*) = count(DISTINCT ({k})) AS \"unique\", count(*) AS rows FROM {t}"
        for t, k in (("customer", "c_custkey"), ("customer", "c_nationkey"), ("orders", "o_orderkey"),
                     ("orders", "o_custkey"), ("lineitem", "l_orderkey,l_linenumber"), ("events", "user_id,ts"))
    ),
    "bronze_cdc_once": latest(
        "SELECT * FROM events, (SELECT min(ts) AS first, max(ts) AS last FROM events) WHERE ts < first + (last - first) / 2",
        USER),
    "bronze_cdc_to_silver_deletes": f"SELECT * FROM ({latest(EVENTS, USER)}) WHERE value > 10",
    "bronze_cdc_to_silver_scd2": f"""
WITH s AS (SELECT *, first + (last - first) / 2 AS cut FROM events, (
    SELECT min(ts) AS first, max(ts) AS last FROM events)),
v AS (
  SELECT user_id, event_type, value, ts, 1 AS run FROM (
    {latest("SELECT * FROM s WHERE ts < cut", "*")})
  UNION ALL SELECT user_id, event_type, value, ts, 2 FROM ({latest("SELECT * FROM s", "*")})),
gone AS (
  SELECT user_id, max(ts) AS ts FROM s WHERE user_id IN (SELECT user_id FROM v)
    AND user_id NOT IN (SELECT user_id FROM v WHERE run = 2) GROUP BY user_id),
d AS (
  SELECT *, lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND lag(value) OVER w IS NOT DISTINCT FROM value
    AND lag(ts) OVER w IS NOT NULL AS same FROM v WINDOW w AS (PARTITION BY user_id ORDER BY run))
SELECT user_id, event_type, value, ts AS "__START_AT",
  coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY run), (SELECT g.ts FROM gone g WHERE g.user_id = d.user_id))
    AS "__END_AT" FROM d WHERE NOT same""",
    "onboarded_quarantine": """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE value > 100 AND event_type <> 'view'""",
    "cdc_scd2_coarse": """
SELECT l_returnflag, month, start AS "__START_AT",
  lead(start) OVER (PARTITION BY l_returnflag ORDER BY start) AS "__END_AT" FROM (
    SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS month, min(l_shipdate) AS start
    FROM lineitem GROUP BY ALL)""",
    "cdc_small_batches_scd2": history(EVENTS, ["event_type", "value"], ["event_type", "value"]),
    "spec_cluster_conflicts": """
SELECT CAST(c_custkey AS VARCHAR) AS data_flow_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000""",
    "spec_later_columns": """
SELECT CAST(c_custkey AS VARCHAR) AS "dataFlowId", CASE WHEN later THEN 'v2' ELSE 'v1' END AS version,
  c_name AS target, 'first' AS "createdBy", CASE WHEN later THEN 'second' ELSE 'first' END AS "updatedBy",
  CASE WHEN later THEN upper(c_name) END AS extra
FROM (SELECT *, c_name LIKE '%7' AS later FROM customer)""",
    "projection_schema": """
SELECT c_custkey AS id, upper(c_name) AS name, c_acctbal > 0 AS solvent, c_mktsegment AS segment,
  c_nationkey AS nation FROM customer WHERE c_custkey > 10""",
    "onboarded_flows": """
SELECT 'events' AS target, event_id AS id, event_type AS name,
  strftime(CASE WHEN event_type = 'view' THEN ts ELSE ts - INTERVAL 9 HOUR END, '%Y-%m-%d %H:%M:%S') AS at FROM events
UNION ALL SELECT 'customers', c_custkey, c_name, NULL FROM customer""",
}
