"""A table of changes over one that changes or snapshots rewrite."""

import json

import pytest
from pyspark.sql import functions as F

import model
from medallion import ChangeSpec
from medallion.operators.snapshot import SnapshotSpec
from medallion.operators.transform import project_and_filter
from medallion.sources import SourceRequest, open_source
from medallion.streaming import tables
from medallion.streaming.flows import Flow, run_on_version, stream_id
from medallion.streaming.tables import Target

EVENTS = "id int, ts int, v int, op string"


class Layers:
    """A bronze table and a silver flow over it."""

    def __init__(self, spark, root, scd_type="1", silver="2", select=("id", "ts", "v"), where=(), keys=("id",), **more):
        self.spark, self.batch = spark, 0
        self.bronze = Target(path=str(root / "bronze"), properties={"medallion.buckets": "4"})
        self.spec = ChangeSpec(
            keys=["id"], sequence_by="ts", scd_type=scd_type, apply_as_deletes="op = 'D'", except_column_list=["op"]
        )
        self.flow = Flow(
            "main", None, Target(path=str(root / "silver")), str(root / "checkpoint"),
            transform=lambda df: project_and_filter(df, list(select), list(where)),
            changes=ChangeSpec(keys=list(keys), sequence_by="ts", scd_type=silver, except_column_list=["ts"]), **more,
        )

    def feed(self, *rows, silver=True):
        """One batch of bronze changes, then silver; returns the rows of silver."""
        if rows:
            df = self.spark.createDataFrame(list(rows), EVENTS)
            tables.apply_changes(df, self.bronze, self.spec, "feed", self.batch)
            self.batch += 1
        return self.run() if silver else None

    def run(self):
        self.flow.source = open_source(SourceRequest(self.spark, "table", {"path": self.bronze.path}))
        run_on_version(self.spark, self.flow, self.bronze.path)
        return model.rows(tables.read(self.spark, self.flow.target.path))

    def logged(self):
        """Change rows of silver per version."""
        rows = self.spark.read.parquet(f"{self.flow.target.path}/log")
        return [r["count"] for r in rows.groupBy("__v").count().orderBy("__v").collect()]


def test_updates_and_deletes_of_a_large_table(spark, tmp_path):
    layers = Layers(spark, tmp_path, keeps_keys=True)
    layers.feed(*[(i, 1, i, "I") for i in range(1000)])
    rows = layers.feed((1, 5, -1, "U"), (2, 6, 0, "D"))
    assert layers.logged() == [1000, 2]
    assert [r for r in rows if r[0] in (1, 2)] == [(1, -1, 5, None), (1, 1, 1, 5), (2, 2, 1, 6)]
    assert len([r for r in rows if r[3] is None]) == 999
    # nothing new: no version, no log
    assert layers.feed() == rows and layers.logged() == [1000, 2]
    # the deleted key comes back
    rows = layers.feed((2, 9, 7, "I"))
    assert [r for r in rows if r[0] == 2] == [(2, 2, 1, 6), (2, 7, 9, None)]
    assert layers.logged() == [1000, 2, 1]


def test_rows_that_leave_the_filter(spark, tmp_path):
    layers = Layers(spark, tmp_path, where=["v > 10"], keeps_keys=True)
    layers.feed((1, 1, 20, "I"), (2, 1, 5, "I"), (None, 1, 30, "I"))
    assert layers.feed((1, 3, 4, "U"), (2, 3, 15, "U"), (None, 4, 0, "U")) == [
        (1, 20, 1, 3), (2, 15, 3, None), (None, 30, 1, 4)]


def test_type_1_silver(spark, tmp_path):
    layers = Layers(spark, tmp_path, silver="1", where=["v > 10"])
    layers.feed((1, 1, 20, "I"), (2, 1, 25, "I"), (3, 1, 30, "I"))
    assert layers.feed((1, 2, 3, "U"), (2, 2, 0, "D"), (4, 2, 40, "I")) == [(3, 30), (4, 40)]


def test_several_rows_of_bronze_behind_a_key(spark, tmp_path):
    """A key goes with the last of its rows."""
    layers = Layers(spark, tmp_path, select=("id div 10 AS g", "ts"), keys=("g",), silver="1")
    assert layers.feed((10, 1, 0, "I"), (11, 1, 0, "I"), (20, 1, 0, "I")) == [(1,), (2,)]
    assert layers.feed((10, 2, 0, "D")) == [(1,), (2,)]
    assert layers.feed((11, 3, 0, "D"), (20, 3, 5, "U")) == [(2,)]


def test_versions_that_a_reader_needs_are_kept(spark, tmp_path):
    layers = Layers(spark, tmp_path, keeps_keys=True)
    layers.feed(*[(i, 1, i, "I") for i in range(20)])
    for n in range(6):  # more versions than are kept for others
        layers.feed((n, 10 + n, 0, "D"), (19, 10 + n, n, "U"), silver=False)
    rows = layers.run()
    assert layers.logged() == [20, 7]
    ended = [*[(n, n, 1, 10 + n) for n in range(6)], (19, 19, 1, 15)]
    assert [r for r in rows if r[3] is not None] == sorted(ended, key=repr)
    kept = len(list((tmp_path / "bronze" / "_medallion" / "versions").glob("*.json")))
    tables.drop_reader(spark, layers.bronze.path, stream_id(spark, layers.flow))
    layers.feed((7, 99, 0, "U"), silver=False)
    assert len(list((tmp_path / "bronze" / "_medallion" / "versions").glob("*.json"))) < kept + 1


def test_a_lost_version_is_read_whole(spark, tmp_path):
    layers = Layers(spark, tmp_path, keeps_keys=True)
    layers.feed((1, 1, 1, "I"), (2, 1, 2, "I"))
    layers.feed((1, 2, 5, "U"), silver=False)
    (tmp_path / "bronze" / "_medallion" / "versions" / f"{1:020d}.json").unlink()
    assert layers.run() == [(1, 1, 1, 2), (1, 5, 2, None), (2, 2, 1, None)]


def test_bronze_history(spark, tmp_path):
    """Type 2 below type 1 and 2: keys whose last version is closed go."""
    layers = Layers(spark, tmp_path, scd_type="2", keeps_keys=True)
    layers.feed((1, 1, 10, "I"), (2, 1, 20, "I"))
    assert layers.feed((1, 4, 11, "U"), (2, 5, 0, "D")) == [(1, 10, 1, 4), (1, 11, 4, None), (2, 20, 1, 5)]


def test_truncated_bronze(spark, tmp_path):
    layers = Layers(spark, tmp_path, keeps_keys=True)
    layers.spec = ChangeSpec(keys=["id"], sequence_by="ts", apply_as_truncates="op = 'T'", except_column_list=["op"])
    layers.feed((1, 1, 10, "I"), (2, 1, 20, "I"))
    assert layers.feed((0, 3, 0, "T"), (3, 4, 30, "I")) == [(1, 10, 1, 3), (2, 20, 1, 3), (3, 30, 4, None)]


@pytest.mark.parametrize("kind", ["1", "2"])
def test_snapshots(spark, tmp_path, kind):
    bronze = Target(path=str(tmp_path / "bronze"), properties={"medallion.buckets": "3"})
    flow = Flow(
        "main", None, Target(path=str(tmp_path / "silver")), str(tmp_path / "checkpoint"), keeps_keys=True,
        changes=ChangeSpec(keys=["id"], sequence_by="__START_AT" if kind == "2" else "n", scd_type="1",
                           except_column_list=["__START_AT", "__END_AT"] if kind == "2" else None),
    )
    snapshots = [
        [(1, "a", {"x": 1}), (2, "b", None)],
        [(1, "c", {"x": 1}), (3, "d", {"y": 2})],
        [(3, "d", {"y": 2}), (1, "c", {"x": 3})],
    ]
    for n, rows in enumerate(snapshots):
        df = spark.createDataFrame([(*r, n) for r in rows], "id int, v string, m map<string,int>, n int")
        df = df.drop("n") if kind == "2" else df
        tables.apply_snapshot(df, bronze, SnapshotSpec(["id"], kind), n + 1)
        flow.source = open_source(SourceRequest(spark, "table", {"path": bronze.path}))
        run_on_version(spark, flow, bronze.path)
        found = {(r.id, r.v, json.dumps(r.m)) for r in tables.read(spark, flow.target.path).collect()}
        assert found == {(i, v, json.dumps(m)) for i, v, m in rows}


def test_only_written_buckets_are_read(spark, tmp_path):
    layers = Layers(spark, tmp_path, keeps_keys=True)
    layers.feed(*[(i, 1, i, "I") for i in range(100)])
    layers.feed((1, 5, -1, "U"), silver=False)
    feed = tables.changes_since(spark, layers.bronze.path, 1)
    assert feed.rows.count() == 1 and feed.before.count() == 1
    plan = feed.rows._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert len(filters) == 2 and all("__bucket" in f and "__v" in f for f in filters)
