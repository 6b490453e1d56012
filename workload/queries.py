"""One query per operator; each takes (spark, folder of the tables)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from medallion import audit, storage
from medallion.functions.decode import cast_text, decode_json, decode_topic
from medallion.functions.rules import Rules
from medallion.operators import cdc, quality, snapshot, transform
from medallion.operators.snapshot import SnapshotSpec
from medallion.operators.upsert import upsert
from medallion.plans import onboard as onboarding, store
from medallion.sources import SourceRequest, open_source
from medallion.sources.snapshots import new_snapshots, numbered_files
from medallion.streaming import tables
from medallion.streaming.flows import Branch, Flow, read_metrics, run_fan_out, run_flow, run_flows, write_snapshot
from medallion.streaming.pipeline import Pipeline, run
from medallion.streaming.tables import Target

from . import feeds
from .feeds import table, user_changes

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _work(spark: SparkSession, name: str) -> str:
    return storage.work_folder(spark, name)


def _file_source(spark, fmt, path, schema=None, state=None, **options):
    request = SourceRequest(
        spark, fmt, {"path": path, **options.pop("details", {})}, options, schema, state
    )
    return open_source(request)


def _columns(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _table_flow(spark, folder, name, work, flow="main", **more) -> Flow:
    """A flow that streams one of the given tables."""
    path = f"{folder}/{name}.parquet"
    source = _file_source(spark, "parquet", path, table(spark, folder, name).schema)
    settings = {
        "name": flow,
        "source": source,
        "target": Target(path=f"{work}/{name}"),
        "checkpoint": f"{work}/checkpoints/{name}-{flow}",
    }
    return Flow(**{**settings, **more})


def _result(spark, target: Target) -> DataFrame:
    return tables.read(spark, target.location(spark))


# ---- change data capture ----------------------------------------------------


@query
def cdc_scd1(spark, folder):
    return cdc.apply_changes(table(spark, folder, "events"), user_changes())


@query
def cdc_scd2(spark, folder):
    return cdc.apply_changes(table(spark, folder, "events"), user_changes(scd_type="2"))


@query
def cdc_scd2_track(spark, folder):
    spec = user_changes(scd_type="2", track_history_column_list=["event_type"])
    return cdc.apply_changes(table(spark, folder, "events"), spec)


@query
def cdc_scd2_track_except(spark, folder):
    spec = user_changes(scd_type="2", track_history_except_column_list=["event_type", "value"],
                        column_list=[*feeds.USER_COLUMNS, "props"])
    return cdc.apply_changes(table(spark, folder, "events"), spec)


@query
def cdc_truncate(spark, folder):
    spec = user_changes(apply_as_truncates="event_type = 'signup' AND value > 300")
    return cdc.apply_changes(table(spark, folder, "events"), spec)


@query
def cdc_ignore_null(spark, folder):
    events = feeds.with_nulls(table(spark, folder, "events"))
    return cdc.apply_changes(events, user_changes(ignore_null_updates=True))


@query
def cdc_ignore_null_cols(spark, folder):
    events = feeds.with_nulls(table(spark, folder, "events"))
    spec = user_changes(
        column_list=[*feeds.USER_COLUMNS, "props"], ignore_null_updates_column_list=["value"]
    )
    return cdc.apply_changes(events, spec)


@query
def cdc_ignore_null_except(spark, folder):
    events = feeds.with_nulls(table(spark, folder, "events"))
    spec = user_changes(
        column_list=[*feeds.USER_COLUMNS, "props"],
        ignore_null_updates=True,
        ignore_null_updates_except_column_list=["value"],
    )
    return cdc.apply_changes(events, spec)


@query
def cdc_ignore_null_scd2(spark, folder):
    events = feeds.with_nulls(table(spark, folder, "events"))
    return cdc.apply_changes(events, user_changes(scd_type="2", ignore_null_updates=True))


@query
def cdc_where_columns(spark, folder):
    spec = user_changes(
        where="event_type <> 'click' AND value > 1",
        column_list=None,
        except_column_list=["event_id", "ts", "props"],
    )
    return cdc.apply_changes(table(spark, folder, "events"), spec)


@query
def cdc_sequence_expression(spark, folder):
    """Orders per customer, ordered by date and then by key."""
    spec = cdc.ChangeSpec(
        keys=["o_custkey"],
        sequence_by="struct(o_orderdate, o_orderkey)",
        apply_as_deletes="o_orderstatus = 'P'",
        except_column_list=["o_orderdate"],
    )
    return cdc.apply_changes(table(spark, folder, "orders"), spec)


@query
def cdc_target_schema(spark, folder):
    """Columns of a type 2 target, with the number of rows they describe."""
    events = table(spark, folder, "events")
    schema = cdc.target_schema(
        events, user_changes(scd_type="2", column_list=None, except_column_list=["ts", "props"])
    )
    names = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields)
    return events.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(names).alias("columns"), "rows")


def _changes_by_stream(spark, folder, name, **spec) -> DataFrame:
    work = _work(spark, name)
    flow = _table_flow(spark, folder, "events", work, changes=user_changes(**spec))
    run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def cdc_stream_scd1(spark, folder):
    return _changes_by_stream(spark, folder, "scd1")


@query
def cdc_stream_scd2(spark, folder):
    return _changes_by_stream(spark, folder, "scd2", scd_type="2")


@query
def cdc_scd2_coarse(spark, folder):
    """Few keys, few sequences: far more rows of a key and a day than a slice holds."""
    before = spark.conf.get("medallion.slice.rows", None)
    spark.conf.set("medallion.slice.rows", "500")
    try:
        rows = table(spark, folder, "lineitem").select(
            "l_returnflag", "l_shipdate", F.date_format("l_shipdate", "yyyy-MM").alias("month")
        )
        spec = cdc.ChangeSpec(keys=["l_returnflag"], sequence_by="l_shipdate", scd_type="2",
                              except_column_list=["l_shipdate"])
        return cdc.apply_changes(rows, spec)
    finally:
        if before is None:
            spark.conf.unset("medallion.slice.rows")
        else:
            spark.conf.set("medallion.slice.rows", before)


@query
def cdc_small_batches_scd2(spark, folder):
    """Events in order, in many batches: histories go on from their open versions."""
    work = _work(spark, "small2")
    events = table(spark, folder, "events")
    cuts = feeds.time_cuts(events, [i / 6 for i in range(1, 6)])
    cuts = [None, *[F.lit(c).cast("timestamp_ntz") for c in cuts], None]
    for low, high in zip(cuts, cuts[1:]):
        part = events if low is None else events.where(F.col("ts") >= low)
        part = part if high is None else part.where(F.col("ts") < high)
        part.coalesce(1).write.mode("append").parquet(f"{work}/in")
        source = _file_source(spark, "parquet", f"{work}/in", events.schema)
        flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint",
                    changes=user_changes(scd_type="2"))
        run_flow(spark, flow)
    return _result(spark, flow.target)


def _late(spark, folder, name, **spec) -> DataFrame:
    """Events arrive out of order, over several runs of the flow."""
    work = _work(spark, name)
    events = feeds.with_nulls(table(spark, folder, "events"))
    ts = F.col("ts")
    early, late = (F.lit(t).cast("timestamp_ntz") for t in feeds.time_cuts(events, [0.25, 0.65]))
    for part, when in enumerate((ts >= late, ts < early, (ts >= early) & (ts < late))):
        events.where(when).write.parquet(f"{work}/in/{part}")
        source = _file_source(spark, "parquet", f"{work}/in/*", events.schema)
        flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint",
                    changes=user_changes(**spec))
        run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def cdc_late_events(spark, folder):
    return _late(spark, folder, "late1", ignore_null_updates=True)


@query
def cdc_late_events_scd2(spark, folder):
    return _late(spark, folder, "late2", scd_type="2")


@query
def cdc_late_truncate(spark, folder):
    return _late(spark, folder, "late3", apply_as_truncates="event_type = 'signup' AND value > 300")


# ---- snapshots --------------------------------------------------------------


def _snapshots(spark, folder, name, **spec) -> DataFrame:
    """Versions are read from numbered files and applied one by one."""
    work = _work(spark, name)
    prefix = feeds.write_user_snapshots(table(spark, folder, "events"), f"{work}/in")
    target, wanted = Target(path=f"{work}/out"), SnapshotSpec(["user_id"], **spec)
    following = numbered_files(spark, prefix, "parquet")
    for rows, version in new_snapshots(following, tables.last_snapshot(spark, target), wanted):
        tables.apply_snapshot(rows, target, wanted, version)
    return _result(spark, target)


@query
def snapshot_scd1(spark, folder):
    return _snapshots(spark, folder, "snap1")


@query
def snapshot_scd2(spark, folder):
    return _snapshots(spark, folder, "snap2", scd_type="2")


@query
def snapshot_scd2_track(spark, folder):
    return _snapshots(spark, folder, "snap3", scd_type="2", track_history_column_list=["event_type"])


@query
def snapshot_history(spark, folder):
    """The same history in one plan, from snapshots that are all at hand."""
    rows = feeds.user_snapshots(table(spark, folder, "events"))
    versions = [
        (rows.where(F.col("period") == v).drop("period"), v) for v in range(1, feeds.PERIODS + 1)
    ]
    return snapshot.history(versions, SnapshotSpec(["user_id"], "2"))


# ---- rules ------------------------------------------------------------------

CUSTOMER_RULES = {
    "expect_all": {"has_name": "c_name IS NOT NULL", "rich": "c_acctbal > 5000"},
    "expect_or_drop": {"positive": "c_acctbal >= 0", "no_cars": "c_mktsegment <> 'AUTOMOBILE'"},
    "expect_or_quarantine": {"in_debt": "c_acctbal < 0"},
}


def _customer_flow(spark, folder, name, rules) -> Flow:
    work = _work(spark, name)
    return _table_flow(
        spark, folder, "customer", work, rules=Rules.parse(rules),
        quarantine=Target(path=f"{work}/quarantine"),
    )


@query
def dq_drop(spark, folder):
    flow = _customer_flow(spark, folder, "dq_drop", CUSTOMER_RULES)
    run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def dq_quarantine(spark, folder):
    flow = _customer_flow(spark, folder, "dq_quarantine", CUSTOMER_RULES)
    run_flow(spark, flow)
    return _result(spark, flow.quarantine)


@query
def dq_warn_metrics(spark, folder):
    flow = _customer_flow(spark, folder, "dq_warn", CUSTOMER_RULES)
    run_flow(spark, flow)
    return read_metrics(spark, flow.target).groupBy("effect", "rule").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )


def _customer_metrics(spark, folder, name, **layout) -> DataFrame:
    work = _work(spark, name)
    flow = _table_flow(
        spark, folder, "customer", work, rules=Rules.parse(CUSTOMER_RULES),
        target=Target(path=f"{work}/customer", **layout),
    )
    run_flow(spark, flow)
    return read_metrics(spark, flow.target).groupBy("effect", "rule").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )


@query
def dq_metrics_clustered(spark, folder):
    """Counts stay right where the write samples its input first."""
    return _customer_metrics(spark, folder, "dq_clustered", cluster_by=["c_nationkey"])


@query
def dq_metrics_partitioned(spark, folder):
    return _customer_metrics(spark, folder, "dq_partitioned", partition_by=["c_mktsegment"])


@query
def dq_rule_counts(spark, folder):
    return quality.rule_counts(table(spark, folder, "orders"), Rules.parse({
        "expect": {"open": "o_orderstatus = 'O'"},
        "expect_or_fail": {"priced": "o_totalprice > 1000"},
        "expect_or_drop": {"urgent": "o_orderpriority IN ('1-URGENT', '2-HIGH')"},
    }))


@query
def dq_merge_alias(spark, folder):
    """The singular form of a kind wins over the plural one for the same rule name."""
    rules = Rules.parse({
        "expect_all_or_drop": {"segment": "c_mktsegment = 'BUILDING'", "named": "c_name IS NOT NULL"},
        "expect_or_drop": {"segment": "c_mktsegment IN ('BUILDING', 'MACHINERY')"},
    })
    return quality.keep_rows(table(spark, folder, "customer"), rules)


@query
def dq_unknown_fails(spark, folder):
    """A rule that is neither true nor false counts as failed."""
    events = feeds.with_nulls(table(spark, folder, "events"))
    return quality.keep_rows(events, Rules(drop={"small": "value < 50"}))


@query
def dq_fail(spark, folder):
    """A broken fail rule stops the flow before anything is written."""
    rules = {**CUSTOMER_RULES, "expect_or_fail": {"solvent": "c_acctbal >= 0"}}
    flow = _customer_flow(spark, folder, "dq_fail", rules)
    try:
        run_flow(spark, flow)
        broken = {}
    except quality.RuleViolation as error:
        broken = error.broken
    written = tables.is_ours(spark, flow.target.path)
    rows = table(spark, folder, "customer").agg(F.count(F.lit(1)).alias("input_rows"))
    return rows.select(
        F.lit(",".join(sorted(broken))).alias("broken_rule"),
        F.lit(sum(broken.values())).cast("long").alias("failed"),
        F.lit(written).alias("written"),
        "input_rows",
    )


@query
def dq_on_cdc(spark, folder):
    work = _work(spark, "dq_cdc")
    flow = _table_flow(
        spark, folder, "events", work, changes=user_changes(),
        rules=Rules.parse({"expect_or_drop": {"large": "value > 5"},
                           "expect_or_quarantine": {"huge": "value > 200"}}),
        quarantine=Target(path=f"{work}/quarantine"),
    )
    run_flow(spark, flow)
    kept = _result(spark, flow.target).withColumn("place", F.lit("table"))
    bad = _result(spark, flow.quarantine).select(*feeds.USER_COLUMNS, F.lit("quarantine").alias("place"))
    return kept.unionByName(bad)


@query
def dq_on_snapshots(spark, folder):
    """Rules on each snapshot: the newest kept rows and all quarantined ones."""
    work = _work(spark, "dq_snap")
    prefix = feeds.write_user_snapshots(table(spark, folder, "events"), f"{work}/in")
    target, bad = Target(path=f"{work}/out"), Target(path=f"{work}/quarantine")
    rules = Rules.parse({"expect": {"view": "event_type = 'view'"},
                         "expect_or_drop": {"large": "value > 5"},
                         "expect_or_quarantine": {"huge": "value > 100"}})
    spec = SnapshotSpec(["user_id"], "1")
    for rows, version in new_snapshots(numbered_files(spark, prefix, "parquet"), None, spec):
        write_snapshot(rows, version, target, spec, rules, bad)
    kept = _result(spark, target).withColumn("place", F.lit("table"))
    return kept.unionByName(_result(spark, bad).withColumn("place", F.lit("quarantine")))


# ---- transforms -------------------------------------------------------------


@query
def silver_project_filter(spark, folder):
    """A silver table: filters see the projected names and reach the scan."""
    work = _work(spark, "silver")
    bronze = _table_flow(spark, folder, "orders", work)
    run_flow(spark, bronze)
    source = open_source(SourceRequest(spark, "table", {"path": bronze.target.path}))
    silver = Flow(
        "main", source, Target(path=f"{work}/silver"), f"{work}/checkpoints/silver",
        transform=lambda df: transform.project_and_filter(
            df,
            ["o_orderkey AS order_id", "concat(o_orderstatus, '-', o_orderpriority) AS label",
             "o_totalprice * 2 AS doubled"],
            ["doubled > 100000", " ", "label LIKE 'O-%' OR label LIKE 'F-1%'"],
        ),
    )
    run_flow(spark, silver)
    return _result(spark, silver.target)


@query
def custom_transform(spark, folder):
    def with_band(df, spec):
        return df.withColumn("band", F.when(F.col("p_size") > spec["limit"], "large").otherwise("small"))

    parts = table(spark, folder, "part")
    return transform.apply_user_function(parts, with_band, {"limit": 25}).select("p_partkey", "band")


SEGMENTS = {
    "building": (["c_custkey AS id", "c_name AS name", "c_acctbal AS balance"],
                 ["c_mktsegment = 'BUILDING'"]),
    "rich": (["c_custkey AS id", "upper(c_name) AS name", "c_acctbal AS balance"],
             ["c_acctbal > 5000", "c_mktsegment <> 'FURNITURE'"]),
    "everyone": (["c_custkey AS id", "c_mktsegment AS name", "c_acctbal AS balance"], []),
}


@query
def fanout_segment(spark, folder):
    """Several projections and filters of one input from a single scan."""
    return transform.fan_out_labelled(table(spark, folder, "customer"), SEGMENTS)


@query
def fanout_flows(spark, folder):
    """The same as a stream: one bronze table feeds several silver tables by one scan."""
    work = _work(spark, "fanout")
    bronze = _table_flow(spark, folder, "customer", work)
    run_flow(spark, bronze)
    source = open_source(SourceRequest(spark, "table", {"path": bronze.target.path}))
    branches = [
        Branch(Flow(name, source, Target(path=f"{work}/{name}"), f"{work}/checkpoints/{name}"), expressions, predicates)
        for name, (expressions, predicates) in SEGMENTS.items()
    ]
    run_fan_out(spark, "customers", source, branches, f"{work}/checkpoints/fan_out")
    parts = [_result(spark, b.flow.target).withColumn("target", F.lit(b.flow.name)) for b in branches]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- flows ------------------------------------------------------------------


def _party_flows(spark, folder, work, once=False) -> list[Flow]:
    """Customers and suppliers into one table."""
    target = Target(path=f"{work}/parties")
    return [
        _table_flow(
            spark, folder, name, work, flow=name, target=target, once=once and name == "supplier",
            transform=lambda df, p=prefix: df.select(
                F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"),
                F.col(f"{p}_acctbal").alias("balance"),
            ),
        )
        for name, prefix in (("customer", "c"), ("supplier", "s"))
    ]


@query
def append_flows(spark, folder):
    work = _work(spark, "append")
    flows = _party_flows(spark, folder, work)
    tables.declare_append(
        spark, flows[0].target,
        _columns("name string, nation int, balance double"),
    )
    run_flows(spark, flows)
    return _result(spark, flows[0].target)


@query
def append_flow_once(spark, folder):
    """A second run adds nothing: streams have no new files, backfills ran already."""
    work = _work(spark, "once")
    for _ in range(2):
        for flow in _party_flows(spark, folder, work, once=True):
            run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def checkpoint_reset(spark, folder):
    """Two halves under two checkpoints, each run twice, into an append and a type 1 target."""
    work = _work(spark, "reset")
    orders = table(spark, folder, "orders")
    open_orders = F.col("o_orderstatus") == "O"
    for part, half in enumerate((open_orders, ~open_orders)):
        orders.where(half).write.parquet(f"{work}/in{part}")
    found = []
    spec = cdc.ChangeSpec(keys=["o_orderkey"], sequence_by="o_orderdate")
    for name, changes in (("append", None), ("type1", spec)):
        for part in (0, 1, 0, 1):
            source = _file_source(spark, "parquet", f"{work}/in{part}", orders.schema)
            flow = Flow("main", source, Target(path=f"{work}/{name}"), f"{work}/{name}-{part}", changes=changes)
            run_flow(spark, flow)
        found.append(_result(spark, flow.target).select(F.lit(name).alias("target"), "*"))
    return found[0].unionByName(found[1])


@query
def file_stream_new_columns(spark, folder):
    """Later files bring a column that the first ones lack."""
    work = _work(spark, "new_columns")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props")
    early = F.col("event_type") == "view"
    for part in (events.where(early).drop("props"), events.where(~early)):
        part.write.mode("append").json(f"{work}/in")
        source = _file_source(spark, "cloudFiles", f"{work}/in", state=f"{work}/state", **{
            "cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"})
        flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint")
        run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def file_stream_changed_types(spark, folder):
    """Later files bring longer numbers and text where the first ones have whole numbers."""
    work = _work(spark, "changed_types")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    kind, long = F.col("event_type"), F.lit("10000000000000000000").cast("decimal(20,0)")
    parts = (
        events.where(kind == "view").withColumn("value", F.floor("value")),
        events.where(kind == "click"),
        events.where(~kind.isin("view", "click")).withColumns(
            {"user_id": (F.col("user_id") + long).cast("decimal(20,0)"), "value": F.concat(F.lit("v"), F.col("value"))}
        ),
    )
    for part in parts:
        part.write.mode("append").json(f"{work}/in")
        source = _file_source(spark, "cloudFiles", f"{work}/in", state=f"{work}/state", **{
            "cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"})
        flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint")
        run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def declared_table(spark, folder):
    """Properties and comment of a table, as the catalog shows them."""
    work = _work(spark, "declared")
    database = f"m_{work[-12:]}"
    tables.create_database(spark, database, f"{work}/db")
    nations = table(spark, folder, "nation")
    counts = nations.groupBy("n_regionkey").count().collect()
    target = Target(
        f"{database}.nations", comment=f"nations of {len(counts)} regions",
        properties={f"region.{r['n_regionkey']}": str(r["count"]) for r in counts},
    )
    tables.append(nations, target, "main", 0)
    shown = spark.sql(f"SHOW TBLPROPERTIES {target.name}").where("key LIKE 'region.%'")
    comment = spark.sql(f"DESCRIBE EXTENDED {target.name}").where("col_name = 'Comment'")
    return shown.union(comment.select(F.lit("comment"), "data_type"))


@query
def table_stream(spark, folder):
    work = _work(spark, "table_stream")
    first = _table_flow(spark, folder, "nation", work)
    second = _table_flow(spark, folder, "part", work)
    run_flows(spark, [first, second])
    source = open_source(
        SourceRequest(spark, "delta", {"path": second.target.path}, {"maxFilesPerTrigger": "100"})
    )
    copy = Flow("main", source, Target(path=f"{work}/copy"), f"{work}/checkpoints/copy")
    run_flow(spark, copy)
    return _result(spark, copy.target)


# ---- sources ----------------------------------------------------------------

EVENT_FIELDS = "event_id long, user_id long, event_type string, value double"


@query
def kafka_decode(spark, folder):
    rows = decode_topic(feeds.topic(table(spark, folder, "events")), _columns(EVENT_FIELDS))
    return rows.select("offset", "date", "hour", "minute", "parsed_records.*")


@query
def file_stream_json_rescue(spark, folder):
    work = _work(spark, "json")
    feeds.json_lines(table(spark, folder, "events")).write.text(f"{work}/in")
    source = _file_source(
        spark, "cloudFiles", f"{work}/in", _columns(EVENT_FIELDS),
        **{"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"},
    )
    flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint")
    run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def json_rescue_batch(spark, folder):
    lines = feeds.json_lines(table(spark, folder, "events"))
    return decode_json(lines, _columns(EVENT_FIELDS), "_rescued_data")


@query
def json_rescue_lossless(spark, folder):
    """Values that their type would cut, and lines that hold more than a record."""
    lines = feeds.odd_json_lines(table(spark, folder, "events"))
    return decode_json(lines, _columns("event_id long, user_id int, event_type string, value double"), "_rescued_data")


@query
def file_stream_csv_by_name(spark, folder):
    """Two folders of files with different headers; columns are matched by name."""
    work = _work(spark, "csv")
    events = table(spark, folder, "events")
    first = events.select("event_id", "value", "user_id", "event_type")
    later = events.select(
        (-F.col("event_id") - 1).alias("event_id"), F.lit("U").alias("Op"), "event_type",
        F.when(F.col("event_type") == "view", F.lit("none")).otherwise(
            F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_type") == "click", F.lit("x")).alias("extra"), "user_id",
    )
    for name, rows in (("first", first), ("later", later)):
        rows.write.option("header", True).csv(f"{work}/in/{name}")
    schema = _columns(
        "Op string, event_id long, user_id int, event_type string, value double"
    )
    source = _file_source(
        spark, "cloudFiles", f"{work}/in/*", schema,
        **{"cloudFiles.format": "csv", "cloudFiles.rescuedDataColumn": "_rescued_data", "header": "true"},
    )
    flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint")
    run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def csv_rescue_batch(spark, folder):
    text = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string"),
        F.when(F.col("s_acctbal") < 0, F.lit("owes")).otherwise(F.col("s_acctbal").cast("string")).alias("s_acctbal"),
        F.col("s_name").alias("note"),
    )
    schema = _columns("s_suppkey int, s_acctbal double, s_region string")
    return cast_text(text, schema, "_rescued_data")


@query
def file_stream_inferred(spark, folder):
    """No schema given: it is inferred once and kept for later runs."""
    work = _work(spark, "inferred")
    table(spark, folder, "part").write.json(f"{work}/in")

    def source():
        return _file_source(
            spark, "cloudFiles", f"{work}/in", None, f"{work}/checkpoint",
            **{"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"},
        )

    for _ in range(2):
        flow = Flow("main", source(), Target(path=f"{work}/out"), f"{work}/checkpoint")
        run_flow(spark, flow)
    return _result(spark, flow.target).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )


@query
def file_stream_orc(spark, folder):
    """Any streaming file format of Spark, a few files per micro-batch."""
    work = _work(spark, "orc")
    suppliers = table(spark, folder, "supplier")
    suppliers.write.orc(f"{work}/in")
    source = _file_source(spark, "orc", f"{work}/in", suppliers.schema, maxFilesPerTrigger="100")
    flow = Flow("main", source, Target(path=f"{work}/out"), f"{work}/checkpoint")
    run_flow(spark, flow)
    return _result(spark, flow.target)


@query
def file_metadata_cols(spark, folder):
    details = {"source_metadata": json.dumps({
        "include_autoloader_metadata_column": "True",
        "select_metadata_cols": {"input_file_name": "_metadata.file_name"},
    })}
    work = _work(spark, "metadata")
    flow = _table_flow(spark, folder, "events", work)
    flow.source = _file_source(
        spark, "parquet", f"{folder}/events.parquet", table(spark, folder, "events").schema, details=details
    )
    run_flow(spark, flow)
    rows = _result(spark, flow.target)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("input_file_name").endswith(".parquet")).alias("named"),
        F.count_if(F.col("source_metadata.file_name") == F.col("input_file_name")).alias("agreeing"),
    )


# ---- sinks ------------------------------------------------------------------


@query
def partitioned_write(spark, folder):
    """Partitioned by text and number columns; values come back as written."""
    work = _work(spark, "partitioned")
    target = Target(path=f"{work}/out", partition_by=["o_orderstatus", "", "code"])
    rows = table(spark, folder, "orders").withColumn(
        "code", F.concat(F.lit("00"), F.substring("o_orderpriority", 1, 1))
    )
    tables.append(rows, target, "main", 0)
    return _result(spark, target)


@query
def clustered_write(spark, folder):
    work = _work(spark, "clustered")
    target = Target(path=f"{work}/out", cluster_by=["l_returnflag", "l_shipdate"])
    tables.append(table(spark, folder, "lineitem"), target, "main", 0)
    return _result(spark, target)


@query
def repeated_batch(spark, folder):
    """A batch that is written again after a failure leaves its rows once."""
    work = _work(spark, "repeated")
    target = Target(path=f"{work}/out")
    rows = table(spark, folder, "orders")
    for _ in range(2):
        tables.append(rows, target, "main", 0)
    return _result(spark, target).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


@query
def catalog_table(spark, folder):
    """A named table with comment and properties, seen through SQL."""
    work = _work(spark, "catalog")
    database = f"m_{work[-12:]}"
    tables.create_database(spark, database, f"{work}/db")
    target = Target(f"{database}.suppliers", comment="all suppliers", properties={"owner": "me"})
    tables.append(table(spark, folder, "supplier"), target, "main", 0)
    path = tables.path_of(spark, target.name)
    tables.deregister(spark, target.name)
    tables.register(spark, target.name, path)
    return spark.sql(f"SELECT s_nationkey, count(*) AS suppliers FROM {target.name} GROUP BY s_nationkey")


# ---- specs ------------------------------------------------------------------


def _spec_rows(spark, folder) -> DataFrame:
    """Orders as spec rows: one group per priority, one id per customer."""
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("dataFlowGroup"),
        F.col("o_custkey").cast("string").alias("dataFlowId"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
        F.col("o_totalprice").alias("price"),
    )


@query
def spec_latest(spark, folder):
    return store.latest_versions(_spec_rows(spark, folder))


@query
def spec_select(spark, folder):
    return store.select_specs(_spec_rows(spark, folder), group="1-URGENT")


@query
def spec_upsert(spark, folder):
    """Each customer's newest order merged into the customers."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("createdBy"),
        F.col("c_acctbal").alias("amount"),
    )
    newest = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("createdBy"),
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("amount"),
    )
    moved = newest.withColumn("id", F.when(F.col("createdBy") == "P", -F.col("id") - 1).otherwise(F.col("id")))
    return upsert(customers, moved, ["id"], keep=["createdBy"])


@query
def spec_silver_join(spark, folder):
    """Specs meet the projection of their target table."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("dataFlowId"),
        F.create_map(F.lit("table"), F.concat(F.lit("t"), F.col("o_custkey"))).alias("targetDetails"),
    )
    projections = table(spark, folder, "customer").select(
        F.concat(F.lit("t"), F.col("c_custkey")).alias("target_table"),
        F.array(F.col("c_name"), F.col("c_mktsegment")).alias("select_exp"),
        F.when(F.col("c_acctbal") > 0, F.array(F.lit("amount > 0"))).alias("where_clause"),
    )
    joined = onboarding.join_projections(rows, projections)
    return joined.select(
        "dataFlowId",
        F.concat_ws(",", "selectExp").alias("select_exp"),
        F.concat_ws(",", "whereClause").alias("where_clause"),
    )


@query
def spec_violations(spark, folder):
    """Every problem of records that are made from orders."""
    columns = {}
    for kind, names in onboarding.RECORD_KEYS.items():
        for name in names:
            if "{env}" not in name:
                columns[name] = F.lit(None).cast(kind)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    changes = F.when(status == "F", F.lit('{"keys":["id"],"scd_type":"2","apply_as_truncates":"x = 1"}'))
    columns.update(
        data_flow_id=F.col("o_custkey").cast("string"),
        data_flow_group=F.lit("A1"),
        source_format=F.when(priority == "1-URGENT", F.lit("tape")).otherwise(F.lit("cloudFiles")),
        source_details=F.create_map(F.lit("path"), F.lit("p")),
        bronze_database=F.when(status != "P", F.lit("bronze")),
        bronze_table=F.concat(F.lit("t"), F.col("o_orderkey")),
        bronze_reader_options=F.create_map(F.lit("header"), F.lit("true")),
        bronze_cdc_apply_changes=changes,
    )
    records = table(spark, folder, "orders").select(*[c.alias(n) for n, c in columns.items()])
    found = onboarding.violations(records, "bronze", "dev", formats=["cloudFiles", "kafka"])
    return found.select("data_flow_id", F.regexp_replace("problem", r" one of .*", " known").alias("problem"))


@query
def spec_cluster_conflicts(spark, folder):
    """Records that ask for clustering and z-ordering at once, made from customers."""
    columns = {}
    for kind, names in onboarding.RECORD_KEYS.items():
        for name in names:
            if "{env}" not in name:
                columns[name] = F.lit(None).cast(kind)
    building, rich = F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000
    columns.update(
        data_flow_id=F.col("c_custkey").cast("string"), data_flow_group=F.lit("A1"),
        source_format=F.lit("cloudFiles"), source_details=F.create_map(F.lit("path"), F.lit("p")),
        bronze_database=F.lit("bronze"), bronze_table=F.concat(F.lit("t"), F.col("c_custkey")),
        bronze_reader_options=F.create_map(F.lit("header"), F.lit("true")),
        bronze_cluster_by=F.when(building, F.lit("id, name")),
        bronze_table_properties=F.when(rich, F.create_map(F.lit(onboarding.Z_ORDER), F.lit("id"))),
    )
    records = table(spark, folder, "customer").select(*[c.alias(n) for n, c in columns.items()])
    return onboarding.violations(records, "bronze", "dev", formats=["cloudFiles"]).select("data_flow_id")


@query
def spec_later_columns(spark, folder):
    """Specs that came before a column have null there; later ones replace specs of their id."""
    work = _work(spark, "later_specs")
    customers = table(spark, folder, "customer")
    when = F.lit("2024-01-01").cast("timestamp")
    rows = customers.select(
        F.lit("A1").alias("dataFlowGroup"), F.col("c_custkey").cast("string").alias("dataFlowId"),
        F.lit("v1").alias("version"), F.col("c_name").alias("target"), when.alias("createDate"),
        F.lit("first").alias("createdBy"), when.alias("updateDate"), F.lit("first").alias("updatedBy"),
    )
    specs = Target(path=f"{work}/specs")
    store.merge_specs(rows, specs)
    later = rows.where(F.col("target").endswith("7")).withColumns(
        {"version": F.lit("v2"), "extra": F.upper("target"), "createdBy": F.lit("second"), "updatedBy": F.lit("second")}
    )
    store.merge_specs(later, specs)
    return tables.read(spark, specs.path).select(
        "dataFlowId", "version", "target", "createdBy", "updatedBy", "extra"
    )


def _records(rows: DataFrame, **columns) -> DataFrame:
    """Onboarding records with the given columns; all other keys are null."""
    given = {}
    for kind, names in onboarding.RECORD_KEYS.items():
        for name in names:
            if "{env}" not in name:
                given[name] = F.lit(None).cast(kind)
    return rows.select(*[c.alias(n) for n, c in {**given, **columns}.items()])


@query
def spec_audit_columns(spark, folder):
    """Specs made from customers: who wrote them and when; options and attributes without a value are left out."""
    rich = F.col("c_acctbal") > 5000
    records = _records(
        table(spark, folder, "customer"),
        data_flow_id=F.col("c_custkey").cast("string"), data_flow_group=F.col("c_mktsegment"),
        source_format=F.lit("cloudFiles"),
        source_details=F.create_map(F.lit("source_path_dev"), F.col("c_name"), F.lit("note"), F.when(rich, F.lit("x"))),
        bronze_database=F.lit("bronze"), bronze_table=F.concat(F.lit("t"), F.col("c_custkey")),
        bronze_table_path=F.when(rich, F.concat(F.lit("/t/"), F.col("c_custkey"))),
        bronze_reader_options=F.create_map(F.lit("header"), F.lit("true"), F.lit("sep"), F.when(rich, F.lit(";"))),
        bronze_cdc_apply_changes=F.when(rich, F.lit('{"keys":["id"],"sequence_by":"ts","scd_type":"1","where":null}')),
    )
    rows = onboarding.bronze_rows(records, "dev", "v3", "me")
    return rows.select(
        "dataFlowId", "version", "createdBy", "updatedBy",
        (F.col("createDate") == F.col("updateDate")).alias("same_time"),
        (F.abs(F.timestamp_diff("MINUTE", "createDate", F.current_timestamp())) < 60).alias("just_now"),
        F.array_join(F.array_sort(F.map_keys("readerConfigOptions")), ",").alias("options"),
        F.array_join(F.array_sort(F.map_keys("sourceDetails")), ",").alias("details"),
        F.array_join(F.array_sort(F.map_keys("targetDetails")), ",").alias("place"),
        "cdcApplyChanges",
    )


@query
def spec_projection_files(spark, folder):
    """Silver specs made from customers; many records name the same two files of projections."""
    work = _work(spark, "projection_files")
    customers = table(spark, folder, "customer")
    segments = sorted(r[0] for r in customers.select("c_mktsegment").distinct().collect())
    for name, part in (("first", segments[::2]), ("second", segments[1::2])):
        storage.write_text(spark, f"{work}/{name}.json", json.dumps(
            [{"target_table": s, "select_exp": ["id", f"'{s}' AS segment"], "where_clause": ["id > 0"]} for s in part]))
    records = _records(
        customers,
        data_flow_id=F.col("c_custkey").cast("string"), data_flow_group=F.lit("A1"),
        bronze_database=F.lit("bronze"), bronze_table=F.lit("customers"),
        silver_database=F.lit("silver"), silver_table=F.col("c_mktsegment"),
        silver_transformation_json=F.when(F.col("c_custkey") % 2 == 0, F.lit(f"{work}/first.json")).otherwise(
            F.lit(f"{work}/second.json")),
    )
    rows = onboarding.silver_rows(records, "dev", "v1", "me")
    return rows.select(
        "dataFlowId", F.col("targetDetails.table").alias("target"), F.array_join("selectExp", ",").alias("select_exp"),
        F.array_join("whereClause", ",").alias("where_clause"),
    )


@query
def snapshot_keys(spark, folder):
    """Which columns could be keys of a snapshot: the probe stops a snapshot whose keys occur twice."""
    found = []
    for name, keys in (("customer", ["c_custkey"]), ("customer", ["c_nationkey"]), ("orders", ["o_orderkey"]),
                       ("orders", ["o_custkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]),
                       ("events", ["user_id", "ts"])):
        rows = table(spark, folder, name)
        try:
            snapshot.check_unique(rows, keys, "a snapshot")
            unique = True
        except snapshot.DuplicateKeys:
            unique = False
        found.append(rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("keys"), F.lit(unique).alias("unique"), "rows"))
    return reduce(lambda a, b: a.unionByName(b), found)


@query
def projection_schema(spark, folder):
    """Rows written as JSON and read with the schema that the projection has."""
    work = _work(spark, "projection_schema")
    expressions = ["c_custkey AS id", "upper(c_name) AS name", "c_acctbal > 0 AS solvent",
                   "named_struct('segment', c_mktsegment, 'nation', c_nationkey) AS place"]
    customers = table(spark, folder, "customer")
    transform.project_and_filter(customers, expressions, ["id > 10"]).write.json(f"{work}/rows")
    schema = transform.output_schema(customers, expressions, ["id > 10"])
    return spark.read.schema(schema).json(f"{work}/rows").select("id", "name", "solvent", "place.segment", "place.nation")


@query
def spec_export_json(spark, folder):
    """Spec records, one per market segment, as one JSON array."""
    segments = table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    records = segments.select(
        F.lower("c_mktsegment").alias("data_flow_id"), F.lit("cars").alias("data_flow_group"), "n"
    )
    return audit.records_as_json(records)


@query
def onboarded_run(spark, folder):
    """From onboarding JSON to a bronze table and a type 2 silver table."""
    work = _work(spark, "onboarded")
    database = f"m_{work[-12:]}"
    tables.create_database(spark, database, f"{work}/db")
    (table(spark, folder, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .write.json(f"{work}/in"))
    storage.write_text(spark, f"{work}/events.ddl",
                "event_id: bigint, ts: timestamp_ntz, user_id: bigint, event_type: string, value: double")
    storage.write_text(spark, f"{work}/rules.json", json.dumps(
        {"expect_or_drop": {"known": "event_id IS NOT NULL"},
         "expect_or_quarantine": {"bad": "value > 100"}}))
    storage.write_text(spark, f"{work}/projections.json", json.dumps(
        [{"target_table": "users", "select_exp": ["user_id", "event_type", "value", "ts AS seen"],
          "where_clause": ["user_id IS NOT NULL"]}]))
    storage.write_text(spark, f"{work}/onboarding.json", json.dumps([{
        "data_flow_id": "1", "data_flow_group": "A1", "source_format": "cloudFiles",
        "source_details": {"source_path_dev": f"{work}/in", "source_schema_path": f"{work}/events.ddl"},
        "bronze_database_dev": database, "bronze_table": "events",
        "bronze_table_path_dev": f"{work}/bronze/events",
        "bronze_reader_options": {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"},
        "bronze_data_quality_expectations_json_dev": f"{work}/rules.json",
        "bronze_database_quarantine_dev": database, "bronze_quarantine_table": "events_quarantine",
        "silver_database_dev": database, "silver_table": "users",
        "silver_table_path_dev": f"{work}/silver/users",
        "silver_transformation_json_dev": f"{work}/projections.json",
        "silver_cdc_apply_changes": {
            "keys": ["user_id"], "sequence_by": "seen", "scd_type": "2",
            "apply_as_deletes": "event_type = 'error'", "except_column_list": ["seen"]},
    }]))
    specs = {layer: Target(f"{database}.{layer}_specs") for layer in ("bronze", "silver")}
    onboarding.onboard(spark, f"{work}/onboarding.json", "dev", "v1", "me", specs)
    run(Pipeline(spark, f"{work}/checkpoints"), "bronze_silver", specs["bronze"], specs["silver"], "A1")
    return spark.table(f"{database}.users")


def _onboard(spark, name: str, events: DataFrame, record: dict, projection: dict):
    """Spec tables for one record over JSON events; returns what runs them."""
    work = _work(spark, name)
    database = f"m_{work[-12:]}"
    tables.create_database(spark, database, f"{work}/db")
    storage.write_text(spark, f"{work}/events.ddl", "event_id bigint, ts timestamp_ntz, user_id bigint, "
                       "event_type string, value double")
    storage.write_text(spark, f"{work}/projections.json", json.dumps([projection]))
    storage.write_text(spark, f"{work}/onboarding.json", json.dumps([{
        "data_flow_id": "100", "data_flow_group": "A1", "source_format": "cloudFiles",
        "source_details": {"source_path_dev": f"{work}/in", "source_schema_path": f"{work}/events.ddl"},
        "bronze_database_dev": database, "bronze_table": "events",
        "bronze_table_path_dev": f"{work}/bronze/events",
        "bronze_reader_options": {"cloudFiles.format": "json"},
        "silver_database_dev": database, "silver_table": "users",
        "silver_table_path_dev": f"{work}/silver/users",
        "silver_transformation_json_dev": f"{work}/projections.json",
        "bronze_database_quarantine_dev": database, **record,
    }]))
    specs = {layer: Target(f"{database}.{layer}_specs") for layer in ("bronze", "silver")}
    onboarding.onboard(spark, f"{work}/onboarding.json", "dev", "v1", "me", specs)

    def feed(part: DataFrame) -> None:
        part = part.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        part.write.mode("append").json(f"{work}/in")
        run(Pipeline(spark, f"{work}/checkpoints"), "bronze_silver", specs["bronze"], specs["silver"], "A1")

    return feed, database


USER_CDC = {"keys": ["user_id"], "sequence_by": "ts", "scd_type": "1", "apply_as_deletes": "event_type = 'error'"}


@query
def bronze_cdc_to_silver(spark, folder):
    """A silver table over a bronze table that changes rewrite, in two runs."""
    events = table(spark, folder, "events")
    feed, database = _onboard(
        spark, "cdc_silver", events, {"bronze_cdc_apply_changes": USER_CDC},
        {"target_table": "users", "select_exp": ["user_id", "upper(event_type) AS event_type", "value"],
         "where_clause": ["value > 10"]},
    )
    (cut,) = feeds.time_cuts(events, [0.5])
    cut = F.lit(cut).cast("timestamp_ntz")
    feed(events.where(F.col("ts") < cut))
    feed(events.where(F.col("ts") >= cut))
    return spark.table(f"{database}.users")


@query
def bronze_cdc_to_silver_scd2(spark, folder):
    """Changes in both layers: the silver history has a version per state that a run saw."""
    events = table(spark, folder, "events")
    feed, database = _onboard(
        spark, "cdc_silver2", events,
        {"bronze_cdc_apply_changes": {**USER_CDC, "flow_name": "users_flow"},
         "silver_cdc_apply_changes": {"keys": ["user_id"], "sequence_by": "ts", "scd_type": "2",
                                      "except_column_list": ["event_id", "ts"]}},
        {"target_table": "users", "select_exp": ["user_id", "event_type", "value", "event_id", "ts"],
         "where_clause": ["user_id IS NOT NULL"]},
    )
    (cut,) = feeds.time_cuts(events, [0.5])
    cut = F.lit(cut).cast("timestamp_ntz")
    feed(events.where(F.col("ts") < cut))
    feed(events.where(F.col("ts") >= cut))
    return spark.table(f"{database}.users")


@query
def bronze_cdc_to_silver_deletes(spark, folder):
    """What leaves the bronze table, or the filter, leaves a silver table of changes, in three runs."""
    events = table(spark, folder, "events")
    feed, database = _onboard(
        spark, "cdc_deletes", events,
        {"bronze_cdc_apply_changes": USER_CDC,
         "silver_cdc_apply_changes": {"keys": ["user_id"], "sequence_by": "ts", "scd_type": "1",
                                      "except_column_list": ["ts"]}},
        {"target_table": "users", "select_exp": ["user_id", "event_type", "value", "ts"],
         "where_clause": ["value > 10"]},
    )
    cuts = [None, *[F.lit(c).cast("timestamp_ntz") for c in feeds.time_cuts(events, [1 / 3, 2 / 3])], None]
    for low, high in zip(cuts, cuts[1:]):
        part = events if low is None else events.where(F.col("ts") >= low)
        feed(part if high is None else part.where(F.col("ts") < high))
    return spark.table(f"{database}.users")


@query
def bronze_cdc_once(spark, folder):
    """A named flow of changes that runs once: what comes later is not taken."""
    events = table(spark, folder, "events")
    feed, database = _onboard(
        spark, "cdc_once", events,
        {"bronze_cdc_apply_changes": {**USER_CDC, "flow_name": "users_backfill", "once": True}},
        {"target_table": "users", "select_exp": ["user_id"], "where_clause": []},
    )
    (cut,) = feeds.time_cuts(events, [0.5])
    cut = F.lit(cut).cast("timestamp_ntz")
    feed(events.where(F.col("ts") < cut))
    feed(events.where(F.col("ts") >= cut))
    return spark.table(f"{database}.events").select("user_id", "event_type", "value")


@query
def onboarded_quarantine(spark, folder):
    """The quarantine table that the onboarding record names."""
    work_rules = _work(spark, "quarantine_rules")
    storage.write_text(spark, f"{work_rules}/rules.json", json.dumps(
        {"expect_or_quarantine": {"bad": "value > 100", "late": "event_type <> 'view'"}}))
    events = table(spark, folder, "events")
    feed, database = _onboard(
        spark, "quarantined", events,
        {"bronze_data_quality_expectations_json_dev": f"{work_rules}/rules.json",
         "bronze_quarantine_table": "events_quarantine"},
        {"target_table": "users", "select_exp": ["user_id"], "where_clause": ["user_id IS NOT NULL"]},
    )
    feed(events)
    return spark.table(f"{database}.events_quarantine")


@query
def onboarded_flows(spark, folder):
    """Two records with a projection file each; an append flow with a time zone of its own; mapped schemas."""
    work = _work(spark, "flows")
    database = f"m_{work[-12:]}"
    tables.create_database(spark, database, f"{work}/db")
    events = table(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type")
    views = F.col("event_type") == "view"
    events.where(views).write.json(f"{work}/views")
    events.where(~views).write.json(f"{work}/others")
    table(spark, folder, "customer").select("c_custkey", "c_name").write.json(f"{work}/customers")
    records = []
    for number, (name, path) in enumerate((("events", "views"), ("customers", "customers"))):
        storage.write_text(spark, f"{work}/{name}.json", json.dumps([{
            "target_table": f"silver_{name}",
            "select_exp": ["event_id AS id", "ts", "event_type AS name"] if name == "events"
            else ["c_custkey AS id", "c_name AS name"], "where_clause": ["id >= 0"]}]))
        records.append({
            "data_flow_id": str(number), "data_flow_group": "A1", "source_format": "cloudFiles",
            "source_details": {"source_path_dev": f"{work}/{path}", "source_schema_path": f"schema of {name}"},
            "bronze_database_dev": database, "bronze_table": name, "bronze_table_path_dev": f"{work}/bronze/{name}",
            "bronze_reader_options": {"cloudFiles.format": "json"},
            "silver_database_dev": database, "silver_table": f"silver_{name}",
            "silver_table_path_dev": f"{work}/silver/{name}",
            "silver_transformation_json_dev": f"{work}/{name}.json"})
    records[0]["bronze_append_flows"] = [{
        "name": "others_flow", "create_streaming_table": False, "source_format": "cloudFiles",
        "source_details": {"source_path_dev": f"{work}/others", "source_schema_path": "schema of events"},
        "reader_options": {"cloudFiles.format": "json"},
        "spark_conf": {"spark.sql.session.timeZone": "Asia/Tokyo"}}]
    storage.write_text(spark, f"{work}/onboarding.json", json.dumps(records))
    schemas = {"schema of events": "event_id bigint, ts timestamp, event_type string",
               "schema of customers": "c_custkey bigint, c_name string"}
    specs = {layer: Target(f"{database}.{layer}_specs") for layer in ("bronze", "silver")}
    onboarding.onboard(spark, f"{work}/onboarding.json", "dev", "v1", "me", specs,
                       schema_mapper=lambda path, _: _columns(schemas[path]).json())
    run(Pipeline(spark, f"{work}/checkpoints"), "bronze_silver", specs["bronze"], specs["silver"], "A1")
    shown = spark.table(f"{database}.silver_events").select(
        F.lit("events").alias("target"), "id", "name", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return shown.unionByName(spark.table(f"{database}.silver_customers").select(
        F.lit("customers").alias("target"), "id", "name", F.lit(None).cast("string").alias("at")))


# ---- audit ------------------------------------------------------------------

AUDITED = ("customer", "orders", "lineitem", "supplier", "part", "events", "documents", "pages")


@query
def reconcile_counts(spark, folder):
    frames = audit.file_tables(spark, {name: f"{folder}/{name}.parquet" for name in AUDITED})
    # what each table should hold follows from the size of the customer table
    customers = table(spark, folder, "customer").agg(F.count(F.lit(1)).alias("n"))
    shares = {"customer": 1, "orders": 10, "lineitem": 40, "region": 1}
    expected = customers.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("table_name"), (F.col("n") * v).alias("expected_rows"))
        for k, v in shares.items()
    ])).alias("e")).select("e.*")
    return audit.reconcile(frames, expected)


@query
def reconcile_at_least(spark, folder):
    frames = {name: table(spark, folder, name) for name in AUDITED}
    suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1)).alias("n"))
    expected = suppliers.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.col("n").alias("expected_rows")) for name in AUDITED
    ])).alias("e")).select("e.*")
    return audit.reconcile(frames, expected, at_least=True)


@query
def synthetic_feed(spark, folder):
    """A synthetic feed with one row per order."""
    return audit.synthetic_rows(table(spark, folder, "orders"), "o_orderkey", 5)
