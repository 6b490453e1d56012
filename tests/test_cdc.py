import pytest
from pyspark.sql import functions as F

import model
from medallion.operators import cdc
from medallion.operators.cdc import ChangeSpec
from medallion.streaming import tables
from medallion.streaming.tables import Target

BASE = {"keys": ["id"], "sequence_by": "seq", "apply_as_deletes": "op = 'D'",
        "except_column_list": ["seq", "op"]}


def frame(spark, events):
    return spark.createDataFrame(events, model.EVENT_SCHEMA)


def spec(**more):
    return ChangeSpec(**{**BASE, **more})


@pytest.mark.parametrize("seed", range(3))
def test_type1_and_type2(spark, seed):
    events = model.random_events(seed)
    df = frame(spark, events)
    assert set(model.rows(cdc.apply_changes(df, spec()))) == model.type1(events)
    assert model.rows(cdc.apply_changes(df, spec(scd_type="2"))) == model.type2(events)
    tracked = spec(scd_type="2", track_history_column_list=["a"])
    assert model.rows(cdc.apply_changes(df, tracked)) == model.type2(events, ("a",))


@pytest.mark.parametrize("limit", ["5", "17"])
@pytest.mark.parametrize("seed", range(2))
def test_hot_keys_are_cut_into_slices(spark, conf, limit, seed):
    events = model.random_events(seed, rows=150, seqs=400)
    conf("medallion.slice.rows", limit)
    df = frame(spark, events)
    assert model.rows(cdc.apply_changes(df, spec(scd_type="2"))) == model.type2(events)
    tracked = spec(scd_type="2", track_history_except_column_list=["a"])
    assert model.rows(cdc.apply_changes(df, tracked)) == model.type2(events, ("b",))
    filled = spec(scd_type="2", ignore_null_updates=True)
    assert model.rows(cdc.apply_changes(df, filled)) == model.type2(model.fill(events))


def test_hot_key_with_many_rows_of_one_sequence(spark, conf):
    conf("medallion.slice.rows", "10")
    events = [(1, i // 40, "U", "x", i % 40) for i in range(160)] + [(2, 1, "U", "y", 0)]
    df = frame(spark, events)
    got = model.rows(cdc.apply_changes(df, spec(scd_type="2")))
    conf("medallion.slice.rows", "1000000")
    assert got == model.rows(cdc.apply_changes(df, spec(scd_type="2")))
    assert len([r for r in got if r[0] == 1]) == len({r[2] for r in got if r[0] == 1}) or got


def test_ignore_nulls(spark):
    events = model.random_events(7)
    df = frame(spark, events)
    filled = model.fill(events)
    assert set(model.rows(cdc.apply_changes(df, spec(ignore_null_updates=True)))) == model.type1(filled)
    only = cdc.apply_changes(df, spec(ignore_null_updates_column_list=["b"]))
    both = {r[0]: r for r in model.type1(filled)}
    plain = {r[0]: r for r in model.type1(events)}
    assert set(model.rows(only)) == {(k, plain[k][1], both[k][2]) for k in plain}


def test_equal_sequences_are_settled_the_same_way(spark):
    events = [(1, 5, "D", None, None), (1, 5, "U", "x", 1), (2, 5, "U", "x", 1), (2, 5, "U", "y", 2)]
    first = model.rows(cdc.apply_changes(frame(spark, events), spec()))
    again = model.rows(cdc.apply_changes(frame(spark, events[::-1]).repartition(3), spec()))
    assert first == again
    # an upsert wins over a delete
    assert (1, "x", 1) in first
    history = model.rows(cdc.apply_changes(frame(spark, events), spec(scd_type="2")))
    assert [r[:3] for r in history] == first


def test_truncate_forgets_what_came_before(spark):
    events = [(1, 1, "U", "x", 1), (2, 2, "U", "x", 2), (9, 3, "T", None, None), (2, 4, "U", "y", 3)]
    got = cdc.apply_changes(frame(spark, events), spec(apply_as_truncates="op = 'T'"))
    assert model.rows(got) == [(2, "y", 3)]


def test_null_sequence_fails(spark):
    df = frame(spark, [(1, None, "U", "x", 1)])
    with pytest.raises(Exception, match="null in sequence_by"):
        cdc.apply_changes(df, spec()).collect()


@pytest.mark.parametrize(
    "wrong",
    [
        {"keys": []},
        {"scd_type": "3"},
        {"column_list": ["id"]},
        {"scd_type": "2", "apply_as_truncates": "op = 'T'"},
        {"except_column_list": ["id"]},
    ],
)
def test_specs_are_checked(wrong):
    with pytest.raises(ValueError):
        spec(**wrong)


def test_target_schema(spark):
    df = frame(spark, [])
    schema = cdc.target_schema(df, spec(scd_type="2"))
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("id", "int"), ("a", "string"), ("b", "int"), ("__START_AT", "bigint"), ("__END_AT", "bigint"),
    ]


def test_maps_and_variants_can_be_tracked(spark):
    df = frame(spark, [(1, 1, "U", "x", 1), (1, 2, "U", "x", 1), (1, 3, "U", "y", 1)]).select(
        "id", "seq", "op", F.create_map("a", "b").alias("m"), F.parse_json(F.lit('{"z":1}')).alias("v")
    )
    got = cdc.apply_changes(df, spec(scd_type="2")).select("id", "__START_AT", "__END_AT")
    assert model.rows(got) == [(1, 1, 3), (1, 3, None)]


# ---- batches ----------------------------------------------------------------


def batches(events, n):
    return [events[i::n] for i in range(n)]


@pytest.mark.parametrize("small", [str(32 << 20), "0"])
@pytest.mark.parametrize("settings", [
    {}, {"ignore_null_updates": True}, {"scd_type": "2"},
    {"scd_type": "2", "track_history_column_list": ["a"]},
    {"scd_type": "2", "ignore_null_updates": True},
])
def test_any_split_into_batches_gives_the_same_table(spark, conf, tmp_path, small, settings):
    conf("medallion.broadcast.bytes", small)
    events = model.random_events(11, rows=80)
    target = Target(path=str(tmp_path / "t"), properties={"medallion.buckets": "3"})
    for number, part in enumerate(batches(events, 4)):
        tables.apply_changes(frame(spark, part), target, spec(**settings), "main", number)
        # a repeated batch changes nothing
        assert not tables.apply_changes(frame(spark, part), target, spec(**settings), "main", number)
    got = model.rows(tables.read(spark, target.path))
    assert got == model.rows(cdc.apply_changes(frame(spark, events), spec(**settings)))


def test_batches_with_hot_keys(spark, conf, tmp_path):
    conf("medallion.slice.rows", "8")
    conf("medallion.broadcast.bytes", "0")
    events = model.random_events(3, rows=120, seqs=300)
    target = Target(path=str(tmp_path / "t"))
    for number, part in enumerate(batches(events, 3)):
        tables.apply_changes(frame(spark, part), target, spec(scd_type="2"), "main", number)
    assert model.rows(tables.read(spark, target.path)) == model.type2(events)


def test_late_truncate(spark, tmp_path):
    settings = spec(apply_as_truncates="op = 'T'", ignore_null_updates=True)
    target = Target(path=str(tmp_path / "t"))
    parts = [
        [(1, 10, "U", "x", None), (2, 3, "U", "y", 2), (1, 4, "U", None, 7)],
        [(None, 5, "T", None, None)],
        [(3, 4, "U", "late", 1), (3, 6, "U", "new", 1)],
    ]
    for number, part in enumerate(parts):
        tables.apply_changes(frame(spark, part), target, settings, "main", number)
    events = [e for part in parts for e in part]
    assert model.rows(tables.read(spark, target.path)) == model.rows(
        cdc.apply_changes(frame(spark, events), settings)
    )
    assert model.rows(tables.read(spark, target.path)) == [(1, "x", None), (3, "new", 1)]


def test_failed_batch_leaves_the_table_as_it_was(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    good, bad = [(1, 1, "U", "x", 1)], [(1, 2, "U", "y", 1), (2, None, "U", "z", 1)]
    tables.apply_changes(frame(spark, good), target, spec(), "main", 0)
    with pytest.raises(Exception, match="null in sequence_by"):
        tables.apply_changes(frame(spark, bad), target, spec(), "main", 1)
    assert model.rows(tables.read(spark, target.path)) == [(1, "x", 1)]
    tables.apply_changes(frame(spark, bad[:1]), target, spec(), "main", 1)
    assert model.rows(tables.read(spark, target.path)) == [(1, "y", 1)]


@pytest.mark.parametrize("scd", ["1", "2"])
def test_columns_come_and_go_between_batches(spark, tmp_path, scd):
    target = Target("default.growing", str(tmp_path / "t"))
    settings = spec(scd_type=scd, ignore_null_updates=True)
    parts = [
        spark.createDataFrame([(1, 1, "U", "x", 1), (2, 1, "U", "z", 2)], model.EVENT_SCHEMA),
        spark.createDataFrame([(1, 2, "U", 9.5)], "id int, seq long, op string, extra double"),
        spark.createDataFrame([(3, 3, "U", 7)], "id int, seq long, op string, b int"),
    ]
    for number, part in enumerate(parts):
        tables.apply_changes(part, target, settings, "main", number)
    got = spark.table("default.growing")
    current = got if scd == "1" else got.where("__END_AT IS NULL")
    assert model.rows(current.select("id", "a", "b", "extra")) == [
        (1, "x", 1, 9.5), (2, "z", 2, None), (3, None, 7, None)]
    assert model.rows(tables.read(spark, target.path)) == model.rows(got)
    tables.deregister(spark, "default.growing")


def test_old_versions_are_removed(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"), properties={"medallion.keep.versions": "2"})
    for number in range(5):
        tables.apply_changes(frame(spark, [(1, number, "U", "x", number)]), target, spec(), "main", number)
    kept = sorted(p.name for p in (tmp_path / "t" / "state").iterdir() if p.name.startswith("__v="))
    assert kept == ["__v=-1", "__v=4", "__v=5"]
    assert model.rows(tables.read(spark, target.path)) == [(1, "x", 4)]


def test_buckets_that_were_rewritten_are_removed(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"),
                    properties={"medallion.keep.versions": "1", "medallion.buckets": "4"})
    everyone = [(i, 0, "U", "x", i) for i in range(40)]
    tables.apply_changes(frame(spark, everyone), target, spec(), "main", 0)
    for number in (1, 2):
        tables.apply_changes(frame(spark, [(1, number, "U", "y", 0)]), target, spec(), "main", number)
    left = {p.name: len(list(p.glob("__bucket=*"))) for p in (tmp_path / "t" / "state").glob("__v=[0-9]*")}
    assert left == {"__v=1": 3, "__v=3": 1}
    assert tables.read(spark, target.path).count() == 40


def test_type1_is_the_open_part_of_type2(spark):
    events = model.random_events(5, rows=100, null_share=0)
    df = frame(spark, events)
    history = cdc.apply_changes(df, spec(scd_type="2"))
    opened = history.where("__END_AT IS NULL").drop("__START_AT", "__END_AT")
    assert model.rows(opened) == model.rows(cdc.apply_changes(df, spec()))
    overlaps = history.alias("x").join(
        history.alias("y"),
        F.expr("x.id <=> y.id AND x.__START_AT < y.__START_AT "
               "AND coalesce(x.__END_AT, 1000000) > y.__START_AT"),
    )
    assert overlaps.isEmpty()
