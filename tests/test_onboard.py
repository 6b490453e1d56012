import json

import pytest

import model
from medallion.plans import store
from medallion.plans.onboard import OnboardingError, onboard
from medallion.plans.specs import AppendFlow, BronzeSpec, SilverSpec
from medallion.streaming.tables import Target


def record(tmp_path, number=1, **more):
    return {
        "data_flow_id": str(number),
        "data_flow_group": "A1",
        "source_format": "cloudFiles",
        "source_details": {"source_path_dev": f"/in/{number}", "source_path_prd": "/other",
                           "source_schema_path": str(tmp_path / "a.ddl"),
                           "source_metadata": {"include_autoloader_metadata_column": "True"}},
        "bronze_database_dev": "bronze",
        "bronze_database_prd": "bronze_prd",
        "bronze_table": f"t{number}",
        "bronze_table_path_dev": f"/bronze/t{number}",
        "bronze_reader_options": {"cloudFiles.format": "json", "multiLine": True, "nothing": None},
        "silver_database_dev": "silver",
        "silver_table": f"s{number}",
        "silver_table_path_dev": f"/silver/s{number}",
        "silver_transformation_json_dev": str(tmp_path / "projections.json"),
        **more,
    }


@pytest.fixture
def files(tmp_path):
    (tmp_path / "a.ddl").write_text("id: int, name string\n")
    (tmp_path / "rules.json").write_text('{"expect_or_drop": {"r": "id > 0"}}')
    (tmp_path / "projections.json").write_text(json.dumps([
        {"target_table": f"s{i}", "select_exp": ["id"], "where_clause": ["id > 1"]} for i in range(1, 4)
    ] + [{"target_table": "unused", "select_exp": ["x"]}]))

    def write(*records, name="onboarding.json"):
        (tmp_path / name).write_text(json.dumps(records))
        return str(tmp_path / name)

    return write


def tables(tmp_path):
    return {layer: Target(path=str(tmp_path / f"{layer}_specs")) for layer in ("bronze", "silver")}


def test_specs_of_both_layers(spark, tmp_path, files):
    path = files(
        record(tmp_path, 1,
               bronze_partition_columns="a, b,,", bronze_cluster_by=["c", "d"],
               bronze_table_properties={"x": "1", "y": None},
               bronze_cdc_apply_changes={"keys": ["id"], "sequence_by": "seq", "scd_type": "2",
                                         "where": None, "apply_as_deletes": "op = 'D'",
                                         "ignore_null_updates": False},
               bronze_data_quality_expectations_json_dev=str(tmp_path / "rules.json"),
               bronze_database_quarantine_dev="bad", bronze_quarantine_table="q1",
               bronze_quarantine_table_partitions="p,q",
               bronze_append_flows=[{"name": "more", "source_format": "cloudFiles",
                                     "create_streaming_table": False, "once": True,
                                     "source_details": {"source_path_dev": "/in/af",
                                                        "source_schema_path": str(tmp_path / "a.ddl")},
                                     "reader_options": {"cloudFiles.format": "csv"},
                                     "spark_conf": {"spark.sql.shuffle.partitions": "2"}}]),
        record(tmp_path, 2),
    )
    specs = tables(tmp_path)
    onboard(spark, path, "dev", "v1", "me", specs)
    first, second = store.load_specs(spark, "bronze", specs["bronze"], "A1")
    assert isinstance(first, BronzeSpec) and first.table == "bronze.t1"
    assert first.sourceDetails["path"] == "/in/1" and "source_path_prd" not in first.sourceDetails
    assert json.loads(first.sourceDetails["source_metadata"])
    assert first.readerConfigOptions == {"cloudFiles.format": "json", "multiLine": "true"}
    assert first.struct.simpleString() == "struct<id:int,name:string>"
    assert first.partitionColumns == ["a", "b"] and first.clusterBy == ["c", "d"]
    assert first.tableProperties == {"x": "1"}
    assert first.changes.scd_type == "2" and first.changes.ignore_null_updates is False
    assert json.loads(first.dataQualityExpectations) == {"expect_or_drop": {"r": "id > 0"}}
    assert first.quarantineTargetDetails == {
        "database": "bad", "table": "q1", "path": None, "partition_columns": ["p", "q"], "cluster_by": None}
    [flow] = first.flows
    assert flow == AppendFlow("more", "cloudFiles", {"path": "/in/af"}, False, None,
                              {"cloudFiles.format": "csv"}, {"spark.sql.shuffle.partitions": "2"}, True)
    assert first.flow_schema("more").names == ["id", "name"]
    assert second.changes is None and second.flows == [] and second.quarantineTargetDetails is None
    assert (first.version, first.createdBy) == ("v1", "me")

    silver = store.load_specs(spark, "silver", specs["silver"])
    assert [s.table for s in silver] == ["silver.s1", "silver.s2"]
    assert isinstance(silver[0], SilverSpec)
    assert (silver[0].selectExp, silver[0].whereClause) == (["id"], ["id > 1"])
    assert silver[0].sourceDetails == {"database": "bronze", "table": "t1", "path": "/bronze/t1"}


def test_merge_keeps_other_specs_and_creation_data(spark, tmp_path, files):
    specs = {"bronze": tables(tmp_path)["bronze"]}
    onboard(spark, files(record(tmp_path, 1), record(tmp_path, 2)), "dev", "v1", "first", specs)
    changed = record(tmp_path, 2, bronze_reader_options={"cloudFiles.format": "csv"})
    onboard(spark, files(changed, record(tmp_path, 3)), "dev", "v2", "second", specs, overwrite=False)
    rows = {s.dataFlowId: s for s in store.load_specs(spark, "bronze", specs["bronze"])}
    assert {i: s.version for i, s in rows.items()} == {"1": "v1", "2": "v2", "3": "v2"}
    assert rows["2"].readerConfigOptions == {"cloudFiles.format": "csv"}
    assert (rows["2"].createdBy, rows["2"].updatedBy) == ("first", "second")
    assert rows["3"].createdBy == "second"
    # with history the older version stays, and the newest is loaded
    onboard(spark, files(changed), "dev", "v10", "third", specs, overwrite=False, keep_history=True)
    from medallion.streaming import tables as targets

    assert targets.read(spark, specs["bronze"].path).count() == 4
    assert [s.version for s in store.load_specs(spark, "bronze", specs["bronze"], ids="2")] == ["v10"]


@pytest.mark.parametrize("change,problem", [
    ({"data_flow_group": ""}, "data_flow_group is missing"),
    ({"source_details": None}, "source_details is missing"),
    ({"source_format": "tape"}, "source_format is not one of"),
    ({"source_format": "snapshot"}, "snapshot_format is missing"),
    ({"bronze_cdc_apply_changes": {"keys": ["a"], "scd_type": "1"}}, "sequence_by is missing"),
    ({"bronze_cdc_apply_changes": {"keys": ["a"], "sequence_by": "s", "scd_type": "2",
                                   "apply_as_truncates": "x"}}, "apply_as_truncates needs scd_type 1"),
    ({"bronze_apply_changes_from_snapshot": {"scd_type": "1"}}, "keys is missing"),
    ({"bronze_append_flows": [{"name": "x", "source_format": "json"}]}, "source_details is missing in bronze_append"),
    ({"bronze_cluster_by": ["a"], "bronze_table_properties": {"pipelines.autoOptimize.zOrderCols": "a"}},
     "exclude each other"),
    ({"bronze_quarantine_table_cluster_by": "a",
      "bronze_quarantine_table_properties": {"pipelines.autoOptimize.zOrderCols": "a"}}, "exclude each other"),
])
def test_wrong_records_are_rejected(spark, tmp_path, files, change, problem):
    specs = {"bronze": tables(tmp_path)["bronze"]}
    with pytest.raises(OnboardingError, match=problem):
        onboard(spark, files({**record(tmp_path), **change}), "dev", "v1", "me", specs)
    assert not (tmp_path / "bronze_specs").exists()


def test_duplicates_paths_and_file_types(spark, tmp_path, files):
    specs = {"bronze": tables(tmp_path)["bronze"]}
    with pytest.raises(OnboardingError, match="1: data_flow_id occurs more than once"):
        onboard(spark, files(record(tmp_path), record(tmp_path)), "dev", "v1", "me", specs)
    without = record(tmp_path)
    del without["bronze_table_path_dev"]
    onboard(spark, files(without), "dev", "v1", "me", specs)
    with pytest.raises(OnboardingError, match="bronze_table_path is missing"):
        onboard(spark, files(without), "dev", "v1", "me", specs, with_catalog=False)
    with pytest.raises(ValueError, match="not a JSON file"):
        onboard(spark, str(tmp_path / "a.ddl"), "dev", "v1", "me", specs)
    with pytest.raises(ValueError, match="layers"):
        onboard(spark, files(without), "dev", "v1", "me", {"gold": specs["bronze"]})


def test_schema_mapper_and_silver_only_record(spark, tmp_path, files):
    asked = []

    def mapper(path, session):
        asked.append(path)
        return '{"type":"struct","fields":[]}'

    specs = tables(tmp_path)
    onboard(spark, files(record(tmp_path)), "dev", "v1", "me", {"bronze": specs["bronze"]}, schema_mapper=mapper)
    assert asked == [str(tmp_path / "a.ddl")]
    only = {k: v for k, v in record(tmp_path, 2).items()
            if not k.startswith(("source", "bronze_reader"))}
    onboard(spark, files(only), "dev", "v1", "me", {"silver": specs["silver"]})
    assert [s.table for s in store.load_specs(spark, "silver", specs["silver"])] == ["silver.s2"]


def test_versions_are_ordered_by_number(spark):
    df = spark.createDataFrame(
        [("g", "1", v) for v in ("v9", "v10", "v2")] + [("g", "2", v) for v in ("v0.0.7", "v0.0.10", "v0.0.9")]
        + [("h", "1", "beta"), ("h", "1", "alpha")],
        "dataFlowGroup string, dataFlowId string, version string",
    )
    assert model.rows(store.latest_versions(df)) == [("g", "1", "v10"), ("g", "2", "v0.0.10"), ("h", "1", "beta")]
    assert model.rows(store.select_specs(df, "g", "'1', '3'")) == [("g", "1", "v10")]
    assert model.rows(store.select_specs(df, ids=["2"])) == [("g", "2", "v0.0.10")]


def test_older_spec_rows_lack_columns(spark):
    row = spark.createDataFrame([("1", "g")], "dataFlowId string, dataFlowGroup string").first()
    spec = BronzeSpec.from_row(row)
    assert spec.clusterBy is None and spec.flows == [] and spec.snapshots is None


def test_wrong_attributes_in_spec_tables():
    for text in ('{"keys":["a"]}', '{"keys":["a"],"sequence_by":"s","scd_type":"1","odd":1}'):
        row = {"cdcApplyChanges": text}
        spec = SilverSpec(**{f: row.get(f) for f in SilverSpec.__dataclass_fields__})
        with pytest.raises(ValueError):
            spec.changes
    with pytest.raises(ValueError, match="missing attributes"):
        AppendFlow.parse('[{"name": "x"}]')


def test_upsert(spark):
    from medallion.operators.upsert import upsert

    old = spark.createDataFrame([(1, "a", "x"), (None, "b", "x"), (3, "c", "x")], "id int, v string, made string")
    new = spark.createDataFrame([(1, None, "y"), (None, "n", "y"), (4, "d", "y")], "id int, v string, made string")
    assert model.rows(upsert(old, new, ["id"], keep=["made"])) == sorted(
        [(1, None, "x"), (3, "c", "x"), (4, "d", "y"), (None, "n", "x")], key=repr)
    with pytest.raises(ValueError, match="rows of key"):
        upsert(old, new.union(new), ["id"]).collect()
