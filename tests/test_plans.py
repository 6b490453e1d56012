"""Plans: what reaches the scan, how often rows are shuffled, and no Python in the way."""

import re

import pytest

from medallion.operators import cdc, snapshot, transform
from medallion.operators.cdc import ChangeSpec
from medallion.operators.snapshot import SnapshotSpec
from medallion.plans import specs, store
from medallion.streaming import tables
from medallion.streaming.tables import Target
from workload import feeds

FOLDER = "/root/testdata/sf0.001"
LAZY = ["cdc_scd1", "cdc_scd2", "cdc_ignore_null", "cdc_ignore_null_scd2", "cdc_where_columns",
        "snapshot_history", "dq_rule_counts", "dq_unknown_fails", "kafka_decode", "json_rescue_batch",
        "csv_rescue_batch", "fanout_segment", "spec_latest", "spec_upsert", "spec_violations"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|rr)", plan(df)))


def events(spark):
    return feeds.table(spark, FOLDER, "events")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_plans(spark, name):
    from workload.queries import QUERIES

    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|ArrowEval|FlatMapGroups|MapInPandas|CartesianProduct|NestedLoop", text)


def test_type1_combines_before_its_only_shuffle(spark):
    df = cdc.apply_changes(events(spark), feeds.user_changes())
    assert exchanges(df) == 1 and "partial_max_by" in plan(df)
    assert "props" not in plan(df)


def test_type2_shuffles_and_sorts_once(spark):
    df = cdc.apply_changes(events(spark), feeds.user_changes(scd_type="2"))
    assert exchanges(df) == 1
    assert len(re.findall(r"\bSort \[", plan(df))) == 1
    assert "props" not in plan(df)


def test_filters_reach_the_scan_through_the_projection(spark):
    df = transform.project_and_filter(
        events(spark), ["user_id AS u", "value AS v"], ["v > 3", "u = 7"]
    )
    scan = plan(df).split("PushedFilters:")[1]
    assert "GreaterThan(value,3.0)" in scan and "EqualTo(user_id,7)" in scan
    assert "ReadSchema: struct<user_id:bigint,value:double>" in scan
    where = cdc.apply_changes(events(spark), feeds.user_changes(where="value > 5"))
    assert "GreaterThan(value,5.0)" in plan(where)


def test_latest_versions_shuffle_once(spark):
    rows = feeds.table(spark, FOLDER, "orders").selectExpr(
        "o_orderpriority AS dataFlowGroup", "o_custkey AS dataFlowId", "o_orderstatus AS version"
    )
    latest = store.latest_versions(rows)
    assert exchanges(latest) == 1 and "partial_max_by" in plan(latest)


def test_specs_are_written_by_many_tasks(spark, conf, tmp_path):
    # so that small partitions are not joined, as large ones would not be
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = Target(path=str(tmp_path / "specs"))
    fixed = ["'A1' AS dataFlowGroup", "cast(id AS string) AS dataFlowId", "id AS v"]
    audit = [f"'x' AS {c}" for c in specs.AUDIT_COLUMNS]
    for number, end in enumerate((200, 300)):
        store.merge_specs(spark.range(end - 200, end, 1, 4).selectExpr(*fixed, *audit), table)
        rows = tables.read(spark, table.path)
        assert sorted(r.v for r in rows.collect()) == list(range(end))
        files = {r[0] for r in rows.selectExpr("input_file_name()").distinct().collect()}
        assert len(files) == 4, number


def test_snapshot_comparison_shuffles_once(spark):
    old = spark.createDataFrame([(1, "x", 1, None)], "id int, a string, __START_AT long, __END_AT long")
    new = spark.createDataFrame([(1, "y")], "id int, a string")
    df = snapshot.next_history(old, new, 2, SnapshotSpec(["id"], "2"))
    assert exchanges(df) == 1


def test_only_current_buckets_of_the_batch_are_read(spark, tmp_path):
    spec = ChangeSpec(keys=["id"], sequence_by="seq", scd_type="1")
    target = Target("default.pruned", str(tmp_path / "t"), properties={"medallion.buckets": "4"})
    tables.apply_changes(spark.range(40).selectExpr("id", "1 AS seq", "'a' AS v"), target, spec, "main", 0)
    tables.apply_changes(spark.range(1).selectExpr("id", "2 AS seq", "'b' AS v"), target, spec, "main", 1)
    folders = sorted(p.name for p in (tmp_path / "t" / "state" / "__v=2").iterdir() if "=" in p.name and p.is_dir())
    assert len(folders) == 1
    df = spark.table("default.pruned")
    assert df.count() == 40 and "PartitionFilters: [isnotnull(__bucket" in plan(df)
    assert df.where("v = 'b'").count() == 1
    tables.deregister(spark, "default.pruned")


def test_buckets_are_written_by_one_task_each(spark, tmp_path):
    spec = ChangeSpec(keys=["id"], sequence_by="seq", scd_type="2")
    target = Target(path=str(tmp_path / "t"), properties={"medallion.buckets": "5"})
    tables.apply_changes(spark.range(300).selectExpr("id", "1 AS seq", "'a' AS v"), target, spec, "main", 0)
    for folder in (tmp_path / "t" / "state" / "__v=1").glob("__bucket=*"):
        assert len(list(folder.glob("*.parquet"))) == 1
