import json

import pytest
from pyspark.sql import types as T

import model
from medallion.functions.decode import decode_json, decode_topic
from medallion.sources import Source, SourceRequest, known_formats, open_source, register_source
from medallion.sources.files import translate_options
from medallion.sources.topics import eventhub_options, kafka_options
from medallion.streaming import tables
from medallion.streaming.flows import Flow, run_flow
from medallion.streaming.tables import Target

FIELDS = "id int, name string, at timestamp_ntz, inner struct<x:int>, tags array<string>"


def ddl(text):
    return T.StructType.fromDDL(text)


def run(spark, tmp_path, request, name="out"):
    flow = Flow("main", open_source(request), Target(path=str(tmp_path / name)), str(tmp_path / f"{name}-cp"))
    run_flow(spark, flow)
    return tables.read(spark, flow.target.path)


# ---- rescue -----------------------------------------------------------------


def decode(spark, lines, schema=FIELDS, **more):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r.asDict(True) for r in decode_json(df, ddl(schema), "_rescued_data", **more).collect()]


def test_json_values_that_fit(spark):
    [row] = decode(spark, ['{"id":1,"name":"n","at":"2024-01-02 03:04:05.678901","inner":{"x":3},"tags":["a"]}'])
    assert row["_rescued_data"] is None
    assert (row["id"], row["inner"], row["tags"], str(row["at"])) == (
        1, {"x": 3}, ["a"], "2024-01-02 03:04:05.678901")


def test_json_unknown_and_unfit_values_are_rescued(spark):
    rows = decode(spark, ['{"id":"seven","extra":{"y":[1]},"name":null}', '{"id":"7"}', "  ", '{"id":1', "[1]"])
    assert [r["id"] for r in rows] == [None, 7, None, None]
    assert json.loads(rows[0]["_rescued_data"]) == {"id": "seven", "extra": {"y": [1]}}
    assert [r["_rescued_data"] for r in rows[1:]] == [None, '{"id":1', "[1]"]


@pytest.mark.parametrize("kind, text, typed", [
    ("int", "1.7", None), ("int", "1.0", 1), ("int", "1e2", 100), ("int", '"1"', 1), ("int", '"01"', None),
    ("int", "3000000000", None), ("int", "true", None), ("long", "20000000000000000000", None),
    ("double", "1.5", 1.5), ("double", "100", 100.0), ("double", "12345678901234567890", None),
    ("double", "1e300", 1e300), ("double", '"x"', None), ("float", "0.5", 0.5), ("float", "16777217", None),
    ("decimal(4,2)", "1.23", "1.23"), ("decimal(4,2)", "1.234", None), ("decimal(4,2)", "1234", None),
    ("boolean", "true", True), ("boolean", "1", None), ("boolean", '"yes"', None),
    ("date", '"2024-01-02"', "2024-01-02"), ("date", '"2024-01-02 10:00:00"', None), ("date", "5", None),
    ("timestamp_ntz", '"2024-01-02 03:04:05.123456"', "2024-01-02 03:04:05.123456"),
    ("timestamp_ntz", '"2024-01-02 03:04:05.1234567"', None),
    ("struct<x:int>", '{"x":3}', {"x": 3}), ("struct<x:int>", '{"x":3.5}', None),
    ("struct<x:int>", '{"x":3,"y":4}', None), ("struct<x:int>", '{"x":null}', {"x": None}),
    ("array<int>", "[1,2]", [1, 2]), ("array<int>", "[1,2.5]", None), ("array<int>", "7", None),
    ("map<string,int>", '{"k":1}', {"k": 1}), ("string", "1.5", "1.5"), ("string", '"é\\n"', "é\n"),
])
def test_json_values_are_taken_whole_or_rescued(spark, kind, text, typed):
    for line in (f'{{"v":{text}}}', f'{{"w":1,"v":{text}}}'):
        [row] = decode(spark, [line], f"v {kind}")
        found = row["v"]
        assert (str(found) if isinstance(typed, str) and found is not None else found) == typed, line
        rescued = json.loads(row["_rescued_data"] or "{}", parse_float=str, parse_int=str)
        lost = json.loads(text, parse_float=str, parse_int=str)
        assert ("v" in rescued) == (typed is None)
        if typed is None and kind != "double":
            assert rescued["v"] == lost


def test_json_lines_with_more_than_a_record(spark):
    lines = ['{"a":1,"b":"x"}{"c":3}', '{"a":1,"b":"x"} tail', '{"a":1,"b":"x"},{"a":2,"b":"y"}', "{'a':1,'b':'x'}",
             '{"a":1,"b":"x"}]', '{"a":1,"b":"x"}]}', '{"a":1,"b":"x"},{}] tail', '{"a":1,"a":2,"b":"x"}', '  {"a":1,"b":"x"}  ', '"a"', "null"]
    for line, row in zip(lines, decode(spark, lines, "a int, b string")):
        if line.startswith("  "):
            assert (row["a"], row["b"], row["_rescued_data"]) == (1, "x", None)
        else:
            assert (row["a"], row["b"], row["_rescued_data"]) == (None, None, line)


def test_json_files_with_more_than_a_value(spark):
    texts = ['[{"a":1},{"a":2.5}]', '{"a":3}{"a":4}', '{"a":5}']
    rows = decode(spark, texts, "a int", whole_files=True)
    assert [(r["a"], r["_rescued_data"]) for r in rows] == [
        (1, None), (None, '{"a":2.5}'), (None, '{"a":3}{"a":4}'), (5, None)]


def test_json_field_names_with_special_characters(spark):
    rows = decode(spark, ['{"a b":1,"c.d":2,"e\'f":3}'], "`a b` int, `c.d` int, `e'f` int")
    assert rows == [{"a b": 1, "c.d": 2, "e'f": 3, "_rescued_data": None}]


def test_json_array_in_one_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[\n {"id": 1, "zip": "z"},\n {"id": 2}\n]')
    request = SourceRequest(
        spark, "cloudFiles", {"path": str(tmp_path / "in")},
        {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "multiLine": "true"},
        ddl("id int"),
    )
    assert model.rows(run(spark, tmp_path, request)) == [(1, '{"zip":"z"}'), (2, None)]


# ---- CSV --------------------------------------------------------------------


def test_csv_by_name_over_several_runs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "first.csv").write_text('﻿id,"name, full",price\n1,"a, b",1.5\n')
    request = SourceRequest(
        spark, "cloudFiles", {"path": str(folder)},
        {"cloudFiles.format": "csv", "cloudFiles.rescuedDataColumn": "_rescued_data", "header": "true",
         "cloudFiles.maxFilesPerTrigger": "1"},
        ddl("Op string, id int, `name, full` string, price double, day date, _rescued_data string"),
    )
    assert model.rows(run(spark, tmp_path, request)) == [(None, 1, "a, b", 1.5, None, None)]
    (folder / "later.csv").write_text('Op,price,id,extra,day\nU,cheap,2,e,2024-01-02\nU,2.5,x,,bad\n')
    (folder / "empty.csv").write_text("")
    got = model.rows(run(spark, tmp_path, request))
    assert [r[:4] for r in got] == [("U", 2, None, None), ("U", None, None, 2.5), (None, 1, "a, b", 1.5)]
    assert json.loads(got[0][5]) == {"price": "cheap", "extra": "e"}
    assert json.loads(got[1][5]) == {"id": "x", "day": "bad"}


def test_csv_schema_is_inferred_over_all_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,2\n")
    (folder / "b.csv").write_text("w,id\n2.5,3\n")
    request = SourceRequest(
        spark, "cloudFiles", {"path": str(folder)},
        {"cloudFiles.format": "csv", "cloudFiles.inferColumnTypes": "true", "header": "true"},
        state=str(tmp_path / "state"),
    )
    got = run(spark, tmp_path, request)
    assert sorted((f.name, f.dataType.simpleString()) for f in got.schema.fields) == [
        ("id", "int"), ("v", "int"), ("w", "double")]
    kept = json.loads((tmp_path / "state" / "schema.json").read_text())
    assert len(kept["fields"]) == 3
    assert got.count() == 2


def test_option_dialect():
    assert translate_options("cloudFiles", {
        "cloudFiles.format": "CSV", "cloudFiles.inferColumnTypes": "true", "header": "true",
        "cloudFiles.rescuedDataColumn": "_r", "cloudFiles.useNotifications": "false",
        "cloudFiles.maxFilesPerTrigger": "5",
    }) == ("csv", {"header": "true", "maxFilesPerTrigger": "5"}, "_r", True)
    assert translate_options("json", {"multiLine": "true"}) == ("json", {"multiLine": "true"}, None, False)


# ---- metadata ---------------------------------------------------------------


@pytest.mark.parametrize("details,columns", [
    ({"include_autoloader_metadata_column": "True"}, ["id", "source_metadata"]),
    ({"include_autoloader_metadata_column": "True", "autoloader_metadata_col_name": "file"}, ["id", "file"]),
    ({"include_autoloader_metadata_column": "False"}, ["id"]),
    ({"select_metadata_cols": {"name": "_metadata.file_name"}}, ["id", "name"]),
    ({"select_metadata_cols": {"name": "_metadata.file_name"},
      "include_autoloader_metadata_column": "True", "autoloader_metadata_col_name": "_metadata"},
     ["id", "name", "_metadata"]),
])
@pytest.mark.parametrize("options", [{}, {"cloudFiles.rescuedDataColumn": "_r"}])
def test_file_metadata_columns(spark, tmp_path, details, columns, options):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n')
    request = SourceRequest(
        spark, "cloudFiles", {"path": str(tmp_path / "in"), "source_metadata": json.dumps(details)},
        {"cloudFiles.format": "json", **options}, ddl("id int"),
    )
    df = open_source(request).read()
    assert sorted(df.columns) == sorted(columns + (["_r"] if options else []))
    if "name" in columns:
        assert df.first()["name"] == "a.json"


# ---- topics -----------------------------------------------------------------


def test_kafka_options():
    details = {"kafka.bootstrap.servers": "h:9092", "subscribe": "t"}
    request = SourceRequest(None, "kafka", details, {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "9"})
    assert kafka_options(request) == {**details, "startingOffsets": "earliest", "maxOffsetsPerTrigger": "9"}
    stores = {f"kafka.ssl.{s}.location": f"/{s}" for s in ("truststore", "keystore")}
    with pytest.raises(ValueError, match="SSL"):
        kafka_options(SourceRequest(None, "kafka", {**details, **stores}))
    for s in ("truststore", "keystore"):
        stores.update({f"kafka.ssl.{s}.secrets.scope": f"{s}-scope", f"kafka.ssl.{s}.secrets.key": "k"})
    built = kafka_options(
        SourceRequest(None, "kafka", {**details, **stores}, secrets=lambda scope, key: f"{scope}/{key}")
    )
    assert built["kafka.ssl.truststore.password"] == "truststore-scope/k"
    assert built["kafka.ssl.keystore.password"] == "keystore-scope/k"
    assert built["kafka.ssl.keystore.location"] == "/keystore"


def test_eventhub_options():
    details = {"eventhub.namespace": "ns", "eventhub.port": "9093", "eventhub.name": "iot",
               "eventhub.accessKeyName": "reader", "eventhub.secretsScopeName": "scope"}
    asked = []

    def secrets(scope, key):
        asked.append((scope, key))
        return "value"

    built = eventhub_options(SourceRequest(None, "eventhub", details, {"failOnDataLoss": "false"}, secrets=secrets))
    # without a name of its own the secret is called like the access key
    assert asked == [("scope", "reader")]
    assert built["kafka.bootstrap.servers"] == "ns.servicebus.windows.net:9093"
    assert built["subscribe"] == "iot" and built["failOnDataLoss"] == "false"
    login = built["kafka.sasl.jaas.config"]
    assert "PlainLoginModule required" in login and "SharedAccessKey=value" in login
    with pytest.raises(ValueError, match="secret lookup"):
        eventhub_options(SourceRequest(None, "eventhub", details))


def test_topic_decoding(spark):
    df = spark.sql("SELECT CAST('{\"id\":1}' AS BINARY) AS value, TIMESTAMP '2024-05-06 07:08:09' AS timestamp")
    row = decode_topic(df, ddl("id int")).first()
    assert (str(row["date"]), row["hour"], row["minute"], row["parsed_records"]["id"]) == ("2024-05-06", 7, 8, 1)
    assert "parsed_records" not in decode_topic(df).columns


# ---- registry and tables ----------------------------------------------------


def test_formats_can_be_added(spark):
    assert {"cloudfiles", "csv", "json", "parquet", "orc", "text", "kafka", "eventhub", "delta", "table"} <= set(
        known_formats())
    with pytest.raises(ValueError, match="not one of"):
        open_source(SourceRequest(spark, "tape"))
    register_source("tape", lambda request: Source(lambda streaming: request.spark.range(3)))
    assert open_source(SourceRequest(spark, "TAPE")).read().count() == 3


def test_plain_catalog_table_as_a_stream(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain")
    spark.range(5).write.mode("overwrite").saveAsTable("plain.numbers")
    request = SourceRequest(spark, "delta", {"source_database": "plain", "source_table": "numbers"},
                            {"maxFilesPerTrigger": "1"})
    assert run(spark, tmp_path, request).count() == 5


def _inferred(spark, tmp_path, fmt, options=None):
    request = SourceRequest(
        spark, "cloudFiles", {"path": str(tmp_path / "in")},
        {"cloudFiles.format": fmt, "cloudFiles.inferColumnTypes": "true", **(options or {})},
        state=str(tmp_path / "state"),
    )
    return run(spark, tmp_path, request)


def _wait_for_next_second(path):
    """File times may be whole seconds; the next file shall be newer."""
    import os
    import time

    old = time.time() - 60
    os.utime(path, (old, old))


@pytest.mark.parametrize("fmt, first, second", [
    ("json", '{"a":1}\n', '{"a":2,"b":"new"}\n'),
    ("csv", "a\n1\n", "b,a\nnew,2\n"),
])
def test_columns_of_later_files_are_kept(spark, tmp_path, fmt, first, second):
    (tmp_path / "in").mkdir()
    options = {"header": "true"} if fmt == "csv" else None
    (tmp_path / "in" / f"1.{fmt}").write_text(first)
    _wait_for_next_second(tmp_path / "in" / f"1.{fmt}")
    _inferred(spark, tmp_path, fmt, options)
    _inferred(spark, tmp_path, fmt, options)
    (tmp_path / "in" / f"2.{fmt}").write_text(second)
    got = _inferred(spark, tmp_path, fmt, options)
    assert sorted((r.a, r.b) for r in got.collect()) == [(1, None), (2, "new")]


@pytest.mark.parametrize("fmt, texts, rows", [
    ("json", ['{"a":1}', '{"a":2.5}', '{"a":"x9"}', '{"a":20000000000000000000}'],
     ["1", "2.5", "x9", "20000000000000000000"]),
    ("json", ['{"a":1}', '{"a":20000000000000000000}', '{"b":1}', '{"a":2}'],
     ["1", "2", "20000000000000000000", None]),
    ("json", ['{"a":{"x":1}}', '{"a":{"x":2.5,"y":true}}', '{"a":[1]}'], ['[1]', '{"x":1}', '{"x":2.5,"y":true}']),
    ("csv", ["a\n1\n", "a\n2.5\n", "a\nx9\n"], ["1", "2.5", "x9"]),
])
def test_types_of_later_files(spark, tmp_path, fmt, texts, rows):
    """Each run sees one more file; earlier rows are shown in the wider type, none is lost."""
    (tmp_path / "in").mkdir()
    options = {"header": "true"} if fmt == "csv" else None
    for i, text in enumerate(texts):
        path = tmp_path / "in" / f"{i}.{fmt}"
        path.write_text(text + "\n")
        got = _inferred(spark, tmp_path, fmt, options)
        _wait_for_next_second(path)
    found = [None if r.a is None else str(r.a) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(rows, key=repr)
    # a stream over the table sees the same rows
    copy = SourceRequest(spark, "table", {"path": str(tmp_path / "out")})
    again = [None if r.a is None else str(r.a) for r in run(spark, tmp_path, copy, "copy").collect()]
    assert sorted(again, key=repr) == sorted(rows, key=repr)


def test_wider_types():
    from medallion.functions.expressions import wider

    def both(one, other):
        return wider(ddl(f"a {one}")["a"].dataType, ddl(f"a {other}")["a"].dataType).simpleString()

    assert both("int", "bigint") == "bigint" and both("bigint", "decimal(20,0)") == "decimal(20,0)"
    assert both("decimal(10,2)", "bigint") == "decimal(22,2)" and both("decimal(38,0)", "decimal(20,10)") == "double"
    assert both("bigint", "double") == "double" and both("double", "boolean") == "string"
    assert both("date", "timestamp") == "timestamp" and both("array<int>", "array<string>") == "array<string>"
    assert both("struct<x:int>", "struct<y:int,x:double>") == "struct<x:double,y:int>"
    assert both("struct<x:int>", "array<int>") == "string" and both("map<string,int>", "map<string,bigint>") == (
        "map<string,bigint>")


def test_tables_of_changes_keep_their_types(spark, tmp_path):
    from medallion import ChangeSpec

    spec = ChangeSpec(keys=["id"], sequence_by="ts")
    target = Target(path=str(tmp_path / "out"))
    tables.apply_changes(spark.sql("SELECT 1 AS id, 1 AS ts, 5 AS v"), target, spec, "f", 0)
    with pytest.raises(ValueError, match="v to string"):
        tables.apply_changes(spark.sql("SELECT 1 AS id, 2 AS ts, 'x' AS v"), target, spec, "f", 1)


def test_csv_headers_as_spark_reads_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n\nid,v\n1,x\n")
    (tmp_path / "in" / "b.csv").write_text('"v","id","long\nname"\ny,2,z\n')
    (tmp_path / "in" / "c.csv").write_text("")
    got = _inferred(spark, tmp_path, "csv", {"header": "true", "multiLine": "true"})
    rows = {r.id: r for r in got.collect()}
    assert {i: (r.v, r["long\nname"]) for i, r in rows.items()} == {1: ("x", None), 2: ("y", "z")}


def test_csv_names_must_differ(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError, match=r"names \['id'\] more than once"):
        _inferred(spark, tmp_path, "csv", {"header": "true"})


def test_csv_files_that_start_with_blank_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n  \nid,v\n1,x\n")
    (tmp_path / "in" / "b.csv").write_text("v,id\ny,2\n")
    got = _inferred(spark, tmp_path, "csv", {"header": "true"})
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "x"), (2, "y")]
