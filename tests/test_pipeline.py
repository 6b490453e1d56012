import json
import shutil

import pytest
from pyspark.sql import functions as F

import model
from medallion import Pipeline, Rules, Target, onboard, run
from medallion.operators.quality import RuleViolation
from medallion.sources import SourceRequest, open_source
from medallion.streaming import tables
from medallion.streaming.flows import Flow, FlowFailed, read_metrics, run_flow, run_flows

# the feed has files without and with an operation column
FIRST = "ts,id,price\n1,1,1.5\n1,2,2.5\n1,3,oops\n"
LATER = "Op,ts,id,price\nU,2,1,9.5\nD,3,2,2.5\nU,1,4,4.5\nX,0,,0\n"


class Setup:
    """A folder with inputs, specs and targets of one test."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.name = "d" + root.name.replace("-", "_")[-30:]
        tables.create_database(spark, self.name, str(root / "db"))
        self.specs = {layer: Target(path=str(root / f"{layer}_specs")) for layer in ("bronze", "silver")}
        (root / "in").mkdir()

    def write(self, name, value):
        path = self.root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value if isinstance(value, str) else json.dumps(value))
        return str(path)

    def record(self, table="items", **more):
        return {
            "data_flow_id": table, "data_flow_group": "A1", "source_format": "cloudFiles",
            "source_details": {
                "source_path_dev": str(self.root / "in"),
                "source_schema_path": self.write("items.ddl", "Op string, ts int, id int, price double"),
            },
            "bronze_database_dev": self.name, "bronze_table": table,
            "bronze_reader_options": {"cloudFiles.format": "csv", "header": "true",
                                      "cloudFiles.rescuedDataColumn": "_rescued_data"},
            "silver_database_dev": self.name, "silver_table": f"{table}_clean",
            "silver_transformation_json_dev": str(self.root / "projections.json"),
            **more,
        }

    def onboard(self, *records, layers=("bronze", "silver"), **more):
        path = self.write("onboarding.json", list(records))
        onboard(self.spark, path, "dev", "v1", "me", {layer: self.specs[layer] for layer in layers}, **more)

    def run(self, layer="bronze_silver", ids=None, **more):
        pipeline = Pipeline(self.spark, str(self.root / "checkpoints"), **more)
        run(pipeline, layer, self.specs["bronze"], self.specs["silver"], "A1", ids)

    def rows(self, table):
        return model.rows(self.spark.table(f"{self.name}.{table}"))


@pytest.fixture
def setup(spark, tmp_path):
    return Setup(spark, tmp_path)


def test_files_to_bronze_to_silver_over_two_runs(setup, spark):
    rules = setup.write("rules.json", {
        "expect": {"cheap": "price < 5"},
        "expect_or_drop": {"has_id": "id IS NOT NULL"},
        "expect_or_quarantine": {"bad": "_rescued_data IS NOT NULL OR id IS NULL"},
    })
    setup.write("projections.json", [
        {"target_table": "items_clean", "select_exp": ["Op", "ts", "id AS item", "price", "_rescued_data AS bad"],
         "where_clause": ["bad IS NULL", " "]},
    ])
    setup.write("in/first.csv", FIRST)
    setup.onboard(setup.record(
        bronze_data_quality_expectations_json_dev=rules, bronze_quarantine_table="items_bad",
        bronze_partition_columns="Op",
        silver_cdc_apply_changes={"keys": ["item"], "sequence_by": "ts", "scd_type": "2",
                                  "apply_as_deletes": "Op = 'D'", "except_column_list": ["Op", "ts", "bad"]},
    ))
    setup.run()
    assert len(setup.rows("items")) == 3
    assert setup.rows("items_bad") == [(None, 1, 3, None, '{"price":"oops"}')]
    assert setup.rows("items_clean") == [(1, 1.5, 1, None), (2, 2.5, 1, None)]
    setup.run()  # nothing new: nothing changes
    assert len(setup.rows("items")) == 3
    setup.write("in/later.csv", LATER)
    setup.run()
    assert len(setup.rows("items")) == 6 and len(setup.rows("items_bad")) == 2
    assert setup.rows("items_clean") == [(1, 1.5, 1, 2), (1, 9.5, 2, None), (2, 2.5, 1, 3), (4, 4.5, 1, None)]
    counts = read_metrics(spark, Target(f"{setup.name}.items"))
    assert model.rows(counts.drop("flow")) == [
        (0, "drop", "has_id", 3, 0), (0, "warn", "cheap", 2, 1), (1, "drop", "has_id", 3, 1), (1, "warn", "cheap", 3, 1)]


def test_bronze_changes_with_rules_and_custom_functions(setup):
    rules = setup.write("rules.json", {"expect_or_drop": {"has_id": "id IS NOT NULL"}})
    setup.write("projections.json", [{"target_table": "x"}])
    setup.write("in/first.csv", FIRST)
    setup.write("in/later.csv", LATER)
    setup.onboard(setup.record(
        bronze_data_quality_expectations_json_dev=rules,
        bronze_cdc_apply_changes={"keys": ["id"], "sequence_by": "ts", "scd_type": "1", "flow_name": "changes",
                                  "apply_as_deletes": "Op = 'D'",
                                  "except_column_list": ["Op", "ts", "_rescued_data"]},
    ), layers=["bronze"])
    setup.run("bronze", bronze_transform=lambda df, spec: df.withColumn("label", F.lit(spec.dataFlowId)))
    assert setup.rows("items") == [(1, 9.5, "items"), (3, None, "items"), (4, 4.5, "items")]
    assert (setup.root / "checkpoints" / f"{setup.name}.items" / "changes").exists()


def test_append_flows_and_backfill(setup):
    setup.write("projections.json", [{"target_table": "x"}])
    setup.write("in/first.csv", FIRST)
    setup.write("more/a.json", '{"id": 7, "price": 7.5, "Op": "I"}\n')
    setup.write("old/b.csv", "id,price\n8,8.5\n")
    ddl = setup.write("items.ddl", "Op string, ts int, id int, price double")

    def flow(name, folder, fmt, **more):
        return {"name": name, "create_streaming_table": False, "source_format": "cloudFiles",
                "source_details": {"source_path_dev": str(setup.root / folder), "source_schema_path": ddl},
                "reader_options": {"cloudFiles.format": fmt, "header": "true"}, **more}

    rules = setup.write("rules.json", {"expect_or_drop": {"priced": "price < 8"}})
    setup.onboard(setup.record(
        bronze_data_quality_expectations_json_dev=rules,
        bronze_append_flows=[
            flow("more", "more", "json", spark_conf={"spark.sql.shuffle.partitions": "2"}),
            flow("old", "old", "csv", once=True, create_streaming_table=True),
        ]), layers=["bronze"])
    setup.run("bronze")
    want = [(None, 1, 1, 1.5, None), (None, 1, 2, 2.5, None), (None, None, 8, 8.5, None), ("I", None, 7, 7.5, None)]
    assert sorted(setup.rows("items"), key=repr) == sorted(want, key=repr)
    setup.write("old/c.csv", "id,price\n9,1.5\n")
    setup.write("more/d.json", '{"id": 10, "price": 1.0}\n')
    setup.run("bronze")  # the backfill ran before, the stream takes the new file
    assert sorted(r[2] for r in setup.rows("items")) == [1, 2, 7, 8, 10]


def test_snapshots_by_path_and_by_function(setup, spark):
    setup.write("projections.json", [{"target_table": "x"}])
    for v, text in ((1, "id,a\n1,x\n2,y\n"), (2, "id,a\n1,z\n,lost\n")):
        setup.write(f"snap/LOAD_{v}.csv", text)
    details = {"source_path_dev": str(setup.root / "snap" / "LOAD_"), "snapshot_format": "csv"}
    changes = {"keys": ["id"], "scd_type": "2"}
    rules = setup.write("rules.json", {"expect": {"x": "a = 'x'"}, "expect_or_drop": {"has_id": "id IS NOT NULL"},
                                       "expect_or_quarantine": {"no_id": "id IS NULL"}})
    record = setup.record("stores", source_format="snapshot", source_details=details,
                          bronze_data_quality_expectations_json_dev=rules, bronze_quarantine_table="stores_bad",
                          bronze_reader_options={"header": "true"},
                          bronze_apply_changes_from_snapshot=changes)
    setup.onboard(record, layers=["bronze"])
    setup.run("bronze")
    assert setup.rows("stores") == [("1", "x", 1, 2), ("1", "z", 2, None), ("2", "y", 1, 2)]
    assert setup.rows("stores_bad") == [(None, "lost")]
    assert model.rows(read_metrics(spark, Target(f"{setup.name}.stores"))) == [
        ("snapshots", 1, "drop", "has_id", 2, 0), ("snapshots", 1, "warn", "x", 1, 1),
        ("snapshots", 2, "drop", "has_id", 1, 1), ("snapshots", 2, "warn", "x", 0, 2)]
    seen = []

    def following(latest, spec):
        seen.append((latest, spec.dataFlowId))
        return (spark.createDataFrame([("5", "n")], "id string, a string"), 9) if latest == 2 else None

    setup.run("bronze", next_snapshot=following)
    assert seen == [(2, "stores"), (9, "stores")]
    assert setup.rows("stores")[1] == ("1", "z", 2, 9) and ("5", "n", 9, None) in setup.rows("stores")


def test_fail_rules_stop_one_flow_and_let_others_finish(setup):
    setup.write("projections.json", [{"target_table": "x"}])
    setup.write("in/first.csv", FIRST)
    rules = setup.write("fail.json", {"expect_or_fail": {"priced": "price IS NOT NULL"}})
    setup.onboard(setup.record("good"), setup.record("bad", bronze_data_quality_expectations_json_dev=rules),
                  layers=["bronze"])
    with pytest.raises(FlowFailed) as error:
        setup.run("bronze")
    [reason] = error.value.failures.values()
    assert isinstance(reason, RuleViolation) and reason.broken == {"priced": 1}
    assert len(setup.rows("good")) == 3
    assert not setup.spark.catalog.tableExists(f"{setup.name}.bad")
    setup.run("bronze", ids="'good'")


def test_fan_out_added_later(setup):
    """A second silver table on the same bronze table, without touching the first."""
    setup.write("projections.json", [
        {"target_table": "items_clean", "select_exp": ["id", "price"]},
        {"target_table": "cheap", "select_exp": ["concat('n', id) AS name"], "where_clause": ["name <> 'n1'"]},
    ])
    setup.write("in/first.csv", FIRST)
    setup.onboard(setup.record())
    setup.run()
    keys = ("data_flow_group", "bronze_database_dev", "bronze_table", "silver_database_dev",
            "silver_transformation_json_dev")
    other = {k: v for k, v in setup.record().items() if k in keys}
    setup.onboard({**other, "data_flow_id": "104", "silver_table": "cheap"}, layers=["silver"], overwrite=False)
    setup.run("silver", silver_transform=lambda df, spec: df.withColumn("by", F.lit(spec.dataFlowId)))
    assert setup.rows("cheap") == [("n2", "104"), ("n3", "104")]
    assert len(setup.rows("items_clean")) == 3


def test_wrong_calls(setup):
    setup.write("projections.json", [{"target_table": "x"}])
    with pytest.raises(ValueError, match="not one of"):
        setup.run("gold")
    with pytest.raises(ValueError, match="needs its spec table"):
        run(Pipeline(setup.spark, str(setup.root)), "bronze")
    setup.onboard(setup.record("a", data_flow_id="1"), setup.record("a", data_flow_id="2"), layers=["bronze"])
    with pytest.raises(ValueError, match="several specs write to"):
        setup.run("bronze")


# ---- flows ------------------------------------------------------------------


def json_flow(spark, root, **more):
    request = SourceRequest(
        spark, "json", {"path": str(root / "in")}, {},
        spark.createDataFrame([], "id int, v int").schema,
    )
    settings = {"name": "main", "source": open_source(request), "target": Target(path=str(root / "out")),
                "checkpoint": str(root / "cp")}
    return Flow(**{**settings, **more})


def test_batch_is_repeated_after_a_failure_between_its_writes(spark, tmp_path, monkeypatch):
    """Main table written, quarantine not: the next run completes the same batch."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":1,"v":1}\n{"id":2,"v":-1}\n')
    rules = Rules.parse({"expect": {"r": "v > 0"}, "expect_or_quarantine": {"q": "v < 0"}})
    flow = json_flow(spark, tmp_path, rules=rules, quarantine=Target(path=str(tmp_path / "bad")))
    write = tables.append

    def failing(df, target, name, batch):
        if target.path.endswith("bad"):
            raise RuntimeError("lost")
        return write(df, target, name, batch)

    monkeypatch.setattr(tables, "append", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_flow(spark, flow)
    monkeypatch.setattr(tables, "append", write)
    run_flow(spark, flow)
    assert model.rows(tables.read(spark, flow.target.path)) == [(1, 1), (2, -1)]
    assert model.rows(tables.read(spark, flow.quarantine.path)) == [(2, -1)]
    assert model.rows(read_metrics(spark, flow.target)) == [("main", 0, "warn", "r", 1, 1)]


def test_lost_checkpoint_commit_writes_nothing_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":1,"v":1}\n')
    flow = json_flow(spark, tmp_path)
    run_flow(spark, flow)
    shutil.rmtree(tmp_path / "cp" / "stream" / "commits")
    run_flow(spark, flow)
    assert model.rows(tables.read(spark, flow.target.path)) == [(1, 1)]


def test_flows_into_one_change_target_take_turns(spark, tmp_path):
    from medallion import ChangeSpec

    flows = []
    for i in range(3):
        root = tmp_path / f"f{i}"
        (root / "in").mkdir(parents=True)
        (root / "in" / "a.json").write_text(f'{{"id":1,"v":{i}}}\n{{"id":{i + 10},"v":{i}}}\n')
        flows.append(json_flow(
            spark, root, name=f"flow {i}", target=Target(path=str(tmp_path / "out")),
            changes=ChangeSpec(keys=["id"], sequence_by="v"),
        ))
    run_flows(spark, flows)
    assert model.rows(tables.read(spark, str(tmp_path / "out"))) == [(1, 2), (10, 0), (11, 1), (12, 2)]
    run_flows(spark, flows)
    assert tables.read(spark, str(tmp_path / "out")).count() == 4


def test_flow_settings_reach_the_batch(spark, tmp_path):
    from medallion.streaming.flows import flow_session

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":1,"v":1}\n')
    seen = []
    session = flow_session(spark, {"spark.sql.shuffle.partitions": "3"})

    def look(df):
        seen.append(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df

    run_flow(spark, json_flow(session, tmp_path, transform=look))
    assert seen == ["3"] and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_rules_that_keep_nothing_are_still_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":1,"v":1}\n{"id":2,"v":2}\n')
    flow = json_flow(spark, tmp_path, rules=Rules.parse({"expect_or_drop": {"never": "1 = 2"}}))
    run_flow(spark, flow)
    assert tables.read(spark, flow.target.path).count() == 0
    assert model.rows(read_metrics(spark, flow.target)) == [("main", 0, "drop", "never", 0, 2)]


def test_many_feeds_in_one_run(setup, spark):
    """Synthetic feeds, their specs made by the package, all in one pipeline."""
    from medallion import audit

    paths = audit.synthetic_feeds(spark, str(setup.root / "feeds"), 6, 3, 10)
    records = audit.feed_records(paths, setup.name, "dev")
    setup.onboard(*records, layers=["bronze"])
    run(Pipeline(spark, str(setup.root / "cp"), at_once=3), "bronze", setup.specs["bronze"], group="synthetic")
    counts = audit.count_rows({r["bronze_table"]: spark.table(f"{setup.name}.{r['bronze_table']}") for r in records})
    assert {r["rows"] for r in counts.collect()} == {10} and counts.count() == 6


def test_one_broken_spec_does_not_hold_up_the_others(setup):
    setup.write("projections.json", [{"target_table": "x"}])
    setup.write("in/first.csv", FIRST)
    broken = setup.record("broken", source_details={"source_path_dev": str(setup.root / "nowhere")})
    setup.onboard(setup.record("good"), broken, layers=["bronze"])
    with pytest.raises(FlowFailed) as error:
        setup.run("bronze")
    assert list(error.value.failures) == [f"{setup.name}.broken"]
    assert len(setup.rows("good")) == 3
