import datetime as dt

import pytest
from pyspark.sql import functions as F

import model
from medallion import audit
from medallion.streaming import tables
from medallion.streaming.tables import Target


def test_partition_values_come_back_as_written(spark, tmp_path):
    rows = [(1, "007", dt.date(2024, 1, 2), 1.5), (2, "", None, 2.0), (3, None, dt.date(2024, 1, 3), None),
            (4, "a/b=c", None, 1.5), (5, "1e3", None, 0.0)]
    df = spark.createDataFrame(rows, "id int, code string, day date, price double")
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    target = Target("parts.codes", str(tmp_path / "t"), partition_by=["code", "day", "price"])
    tables.append(df, target, "main", 0)
    assert model.rows(tables.read(spark, target.path)) == sorted(rows, key=repr)
    assert model.rows(spark.table("parts.codes")) == sorted(rows, key=repr)
    plan = spark.table("parts.codes").where("code = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__p_code" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_columns_are_added_and_missing_ones_are_null(spark, tmp_path):
    target = Target("default.grow", str(tmp_path / "t"), partition_by=["k"])
    tables.append(spark.createDataFrame([(1, "a")], "id int, k string"), target, "main", 0)
    tables.append(spark.createDataFrame([(2, "a", 3.5)], "id int, k string, extra double"), target, "main", 1)
    tables.append(spark.createDataFrame([(4, "b")], "id int, k string"), target, "other", 0)
    want = [(1, "a", None), (2, "a", 3.5), (4, "b", None)]
    assert model.rows(spark.table("default.grow")) == want
    assert model.rows(tables.read(spark, target.path)) == want
    tables.deregister(spark, "default.grow")


def test_repeated_and_interrupted_batches(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    df = spark.createDataFrame([(i,) for i in range(10)], "id int").repartition(3)
    broken = df.where(F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise(F.lit(True)))
    tables.declare_append(spark, target, df.schema)
    with pytest.raises(Exception, match="boom"):
        tables.append(broken, target, "main", 0)
    assert tables.append(df, target, "main", 0)
    assert not tables.append(df, target, "main", 0)
    assert tables.read(spark, target.path).count() == 10


def test_clustered_write_keeps_one_value_out_of_one_task(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    target = Target(path=str(tmp_path / "t"), cluster_by=["k"])
    df = spark.range(4000).select(F.lit("same").alias("k"), "id")
    tables.append(df, target, "main", 0)
    files = list((tmp_path / "t" / "data" / "__flow=main" / "__batch=0").glob("*.parquet"))
    assert len(files) > 1
    assert tables.read(spark, target.path).count() == 4000


def test_catalog(spark, tmp_path):
    tables.create_database(spark, "cat", str(tmp_path / "db"))
    target = Target("cat.t", properties={"owner": "o'neil"}, comment="it's a table")
    assert target.location(spark).endswith("/db/t")
    tables.append(spark.range(3), target, "main", 0)
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES cat.t").collect()}
    assert shown["owner"] == "o'neil"
    assert spark.catalog.getTable("cat.t").description == "it's a table"
    path = tables.location_of(spark, "cat.t")
    tables.deregister(spark, "cat.t")
    assert tables.path_of(spark, "cat.t") is None
    tables.register(spark, "other.t", path)
    assert spark.table("other.t").count() == 3
    tables.reset(spark, "other.t")
    assert not tables.is_ours(spark, path) and not spark.catalog.tableExists("other.t")
    tables.drop_database(spark, "other")
    assert not spark.catalog.databaseExists("other")


def test_kinds_do_not_mix_and_changes_are_no_stream(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    tables.overwrite(spark.range(3), target)
    tables.overwrite(tables.read(spark, target.path).where("id > 0"), target)
    assert tables.read(spark, target.path).count() == 2
    with pytest.raises(ValueError, match="holds a full table"):
        tables.append(spark.range(1), target, "main", 0)
    with pytest.raises(ValueError, match="read it as a batch"):
        tables.read(spark, target.path, streaming=True)
    with pytest.raises(ValueError):
        Target()


def test_reconciliation_and_synthetic_feeds(spark, tmp_path):
    frames = {"a": spark.range(3), "b": spark.range(5)}
    expected = spark.createDataFrame([("a", 3), ("b", 4), ("c", 1)], "table_name string, expected_rows long")
    exact = {r[0]: r[3] for r in audit.reconcile(frames, expected).collect()}
    assert exact == {"a": "passed", "b": "failed", "c": "failed"}
    loose = {r[0]: r[3] for r in audit.reconcile(frames, expected, at_least=True).collect()}
    assert loose == {"a": "passed", "b": "passed", "c": "failed"}
    audit.write_report(audit.reconcile(frames, expected), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3
    paths = audit.synthetic_feeds(spark, str(tmp_path / "feeds"), 3, 2, 20)
    feeds = [spark.read.option("header", True).csv(p) for p in paths]
    assert [f.count() for f in feeds] == [20, 20, 20]
    assert feeds[0].columns == ["id", "col_1", "col_2"]
    records = spark.createDataFrame([("1", "x")], "data_flow_id string, data_flow_group string")
    assert audit.records_as_json(records).first()[0] == '[{"data_flow_id":"1","data_flow_group":"x"}]'


def test_work_folder_needs_a_shared_folder_on_a_cluster(spark):
    from medallion import storage

    assert storage.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.work_folder(Session(), "x")


@pytest.mark.parametrize("seed, fill", [(1, False), (2, True), (3, False), (4, True), (5, True), (6, True)])
def test_histories_in_many_batches(spark, tmp_path, seed, fill):
    """On-time, late and mixed batches lead to the history of all events."""
    import random

    from medallion.operators import cdc

    rng = random.Random(seed)
    spec = cdc.ChangeSpec(
        keys=["k"], sequence_by="s", scd_type="2", apply_as_deletes="v = 0", ignore_null_updates=fill,
        track_history_column_list=["v"],
    )
    schema = "k int, s int, v int, w int"
    target = Target(path=str(tmp_path / "t"), properties={"medallion.buckets": "3"})
    seen = []
    for batch in range(6):
        low, high = (0, 60) if batch in (3, 5) else (10 * batch, 10 * batch + 10)
        rows = [
            (rng.randrange(8), rng.randrange(low, high), rng.choice([None, 0, 1, 1, 2]), rng.randrange(3))
            for _ in range(12)
        ]
        seen += rows
        tables.apply_changes(spark.createDataFrame(rows, schema), target, spec, "main", batch)
        want = cdc.type2(spark.createDataFrame(seen, schema), spec)
        got = tables.read(spark, target.path).select(*want.columns)
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), batch


def test_on_time_batches_leave_the_log_alone(spark, tmp_path, monkeypatch):
    from medallion.operators import cdc

    spec = cdc.ChangeSpec(keys=["k"], sequence_by="s", scd_type="2")
    target = Target(path=str(tmp_path / "t"))
    first = spark.range(100).selectExpr("id % 10 AS k", "id AS s", "id AS v")
    tables.apply_changes(first, target, spec, "main", 0)
    monkeypatch.setattr(tables, "_logged_since", lambda *_: pytest.fail("the log was read"))
    tables.apply_changes(spark.range(100, 104).selectExpr("id % 10 AS k", "id AS s", "id AS v"), target, spec, "main", 1)
    assert tables.read(spark, target.path).count() == 104


def test_late_events_read_the_log_from_their_version_on(spark, tmp_path, monkeypatch):
    """Also where nulls are ignored: what was carried on so far is in the version before."""
    from medallion.operators import cdc

    spec = cdc.ChangeSpec(keys=["k"], sequence_by="s", scd_type="2", ignore_null_updates=True)
    target = Target(path=str(tmp_path / "t"))
    events = spark.range(0, 100, 2).selectExpr("1 AS k", "id AS s", "IF(id = 0, 7, NULL) AS v", "id AS w")
    tables.apply_changes(events, target, spec, "main", 0)
    read = []
    since = tables._logged_since

    def look(logged, cuts, *more):
        found = since(logged, cuts, *more)
        read.extend(r[cdc.SEQ] for r in found.collect())
        return found

    monkeypatch.setattr(tables, "_logged_since", look)
    late = spark.sql("SELECT 1 AS k, 95L AS s, CAST(NULL AS INT) AS v, 950L AS w")
    tables.apply_changes(late, target, spec, "main", 1)
    assert sorted(read) == [94, 95, 96, 98]
    want = cdc.type2(events.unionByName(late), spec)
    got = tables.read(spark, target.path).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and {r.v for r in got.collect()} == {7}


def test_counts_come_from_file_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(str(tmp_path / "a"))
    spark.range(7).write.parquet(str(tmp_path / "b"))
    counts = audit.count_rows(audit.file_tables(spark, {n: str(tmp_path / n) for n in "ab"}))
    assert {r.table_name: r.rows for r in counts.collect()} == {"a": 1000, "b": 7}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") >= 2


def test_slices_of_a_key_with_few_sequences(spark, conf):
    from medallion.operators import cdc, skew

    conf("medallion.slice.rows", "200")
    rows = spark.range(20_000).selectExpr("'a' AS k", "id % 100 AS s", "id % 7 AS v")
    spec = cdc.ChangeSpec(keys=["k"], sequence_by="s", scd_type="2")
    got = cdc.type2(rows, spec)
    conf("medallion.slice.rows", "1000000")
    assert sorted(got.collect()) == sorted(cdc.type2(rows, spec).collect())
    hot, limit = skew.hot_keys(rows, ["k"])
    assert hot is None
    conf("medallion.slice.rows", "200")
    assert skew.hot_keys(rows, ["k"])[1] == 200
