import random

import pytest

import model
from medallion.operators import snapshot
from medallion.operators.snapshot import DuplicateKeys, SnapshotSpec
from medallion.sources.snapshots import new_snapshots, numbered_files
from medallion.streaming import tables
from medallion.streaming.tables import Target

SCHEMA = "id int, a string, b int"


def frames(spark, versions):
    return [(spark.createDataFrame(rows, SCHEMA), v) for v, rows in versions]


def random_versions(seed, versions=4):
    rng = random.Random(seed)
    out = []
    for v in range(1, versions + 1):
        ids = [i for i in [None, 1, 2, 3, 4, 5] if rng.random() < 0.7]
        out.append((v * 10, [(i, rng.choice([None, "x", "y"]), rng.randrange(2)) for i in ids]))
    return out


def expected(versions, tracked):
    """Open at the version a key appears or changes, close where it changes or is missing."""
    done, current = [], {}
    for v, rows in versions:
        seen = {r[0]: {"a": r[1], "b": r[2]} for r in rows}
        for key in list(current):
            if key not in seen or any(current[key][t] != seen[key][t] for t in tracked):
                old = current.pop(key)
                done.append((key, old["a"], old["b"], old["s"], v))
        for key, value in seen.items():
            current[key] = {**value, "s": current[key]["s"] if key in current else v}
    done += [(k, c["a"], c["b"], c["s"], None) for k, c in current.items()]
    return sorted(done, key=repr)


def apply(spark, versions, spec, path):
    target = Target(path=path)
    for rows, v in frames(spark, versions):
        tables.apply_snapshot(rows, target, spec, v)
    return model.rows(tables.read(spark, path))


@pytest.mark.parametrize("seed", range(2))
def test_type2_in_one_plan_and_version_by_version(spark, tmp_path, seed):
    versions = random_versions(seed)
    for i, (more, tracked) in enumerate([({}, ("a", "b")), ({"track_history_column_list": ["a"]}, ("a",))]):
        spec = SnapshotSpec(["id"], "2", **more)
        want = expected(versions, tracked)
        assert model.rows(snapshot.history(frames(spark, versions), spec)) == want
        assert apply(spark, versions, spec, str(tmp_path / f"t{i}")) == want


def test_type1_is_the_newest_snapshot(spark, tmp_path):
    versions = random_versions(5)
    spec = SnapshotSpec(["id"], "1")
    want = sorted(versions[-1][1], key=repr)
    assert model.rows(snapshot.history(frames(spark, versions), spec)) == want
    assert apply(spark, versions, spec, str(tmp_path / "t")) == want


def test_feed_with_returning_keys(spark, tmp_path):
    """Keys per version 1,2,3,4 / 1,3,4 / 1,5: nine intervals."""
    versions = [
        (1, [(i, f"a{i}", 1) for i in (1, 2, 3, 4)]),
        (2, [(i, f"b{i}", 1) for i in (1, 3, 4)]),
        (3, [(1, "c1", 1), (5, "c5", 1)]),
    ]
    got = apply(spark, versions, SnapshotSpec(["id"], "2"), str(tmp_path / "t"))
    assert [(r[0], r[3], r[4]) for r in got] == [
        (1, 1, 2), (1, 2, 3), (1, 3, None), (2, 1, 2), (3, 1, 2), (3, 2, 3), (4, 1, 2), (4, 2, 3),
        (5, 3, None),
    ]


def test_closed_versions_survive_clean_up(spark, tmp_path):
    versions = [(v, [(1, f"v{v}", v), (2, "same", 0)]) for v in range(1, 8)]
    got = apply(spark, versions, SnapshotSpec(["id"], "2"), str(tmp_path / "t"))
    assert got == expected(versions, ("a", "b"))


def test_duplicates_and_falling_versions_are_errors(spark, tmp_path):
    twice = [(1, "x", 1), (1, "y", 1)]
    for kind in ("1", "2"):
        target = Target(path=str(tmp_path / kind))
        spec = SnapshotSpec(["id"], kind)
        with pytest.raises(DuplicateKeys):
            tables.apply_snapshot(spark.createDataFrame(twice, SCHEMA), target, spec, 1)
        tables.apply_snapshot(spark.createDataFrame(twice[:1], SCHEMA), target, spec, 2)
        with pytest.raises(Exception, match="several rows of one key|rows of key"):
            tables.apply_snapshot(spark.createDataFrame(twice, SCHEMA), target, spec, 3)
        with pytest.raises(ValueError, match="not above"):
            tables.apply_snapshot(spark.createDataFrame(twice[:1], SCHEMA), target, spec, 2)
        assert len(model.rows(tables.read(spark, target.path))) == 1


def test_numbered_files_continue_after_the_last_version(spark, tmp_path):
    prefix = str(tmp_path / "LOAD_")
    for v, address in ((1, "a"), (2, "b")):
        (tmp_path / f"LOAD_{v}.csv").write_text(f"id,address\n1,{address}\n")
    following = numbered_files(spark, prefix, "csv", {"header": "true"})
    found = [(model.rows(df), v) for df, v in new_snapshots(following, None, None)]
    assert found == [([("1", "a")], 1), ([("1", "b")], 2)]
    assert [v for _, v in new_snapshots(following, 1, None)] == [2]
    assert list(new_snapshots(lambda latest, spec: None, 2, None)) == []
    with pytest.raises(ValueError, match="not above"):
        list(new_snapshots(lambda latest, spec: (None, 1), 1, None))


def test_versions_may_be_dates_times_or_texts(spark, tmp_path):
    import datetime as dt

    for i, (one, two) in enumerate([
        (dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
        (dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6, 0, 0, 7)),
        ("a", "b"), (1.5, 2.5),
    ]):
        target = Target(path=str(tmp_path / f"t{i}"))
        spec = SnapshotSpec(["id"], "2")
        for v in (one, two):
            tables.apply_snapshot(spark.createDataFrame([(1, str(v), 1)], SCHEMA), target, spec, v)
        assert tables.last_snapshot(spark, target) == two
        assert [r[3:] for r in model.rows(tables.read(spark, target.path))] == [(one, two), (two, None)]


def _versions(tmp_path):
    return sorted(p.name for p in (tmp_path / "t" / "state").iterdir())


def test_only_changed_buckets_are_written(spark, tmp_path):
    schema = "k int, a string, b string, m map<string,int>, l array<int>"
    target = Target(path=str(tmp_path / "t"), properties={"medallion.buckets": "8"})
    spec = SnapshotSpec(keys=["k"], scd_type="2")
    rows = [(k, None, "x", {"p": 1, "q": 2}, [None, 1]) for k in range(64)]
    steps = [rows, rows[::-1]]
    changed = list(rows)
    changed[3] = (3, "x", None, {"q": 2, "p": 1}, [None, 1])  # a null that moved
    changed[9] = (9, None, "x", {"p": 1, "q": 2}, [1, None])
    steps.append(changed)
    steps.append([r for r in changed if r[0] != 5] + [(100, "new", None, {}, [])])
    for number, snapshot in enumerate(steps, 1):
        tables.apply_snapshot(spark.createDataFrame(snapshot, schema), target, spec, number)
    shown = tables.read(spark, target.path).select("k", "a", "b", "l", "__START_AT", "__END_AT")
    got = sorted((tuple(r) for r in shown.collect()), key=lambda r: (r[0], r[4]))
    assert len(got) == 64 + 2 + 1
    assert [g for g in got if g[0] in (3, 5, 9, 100)] == sorted([
        (3, None, "x", [None, 1], 1, 3), (3, "x", None, [None, 1], 3, None), (5, None, "x", [None, 1], 1, 4),
        (9, None, "x", [None, 1], 1, 3), (9, None, "x", [1, None], 3, None), (100, "new", None, [], 4, None),
    ], key=lambda r: (r[0], r[4]))
    names = _versions(tmp_path)
    assert "__v=2" not in names  # unchanged: nothing was written
    assert len(list((tmp_path / "t" / "state" / "__v=3" / "__open=1").iterdir())) <= 2
    assert tables.last_snapshot(spark, target) == 4


def test_partition_values_of_a_snapshot_do_not_multiply_files(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    target = Target(path=str(tmp_path / "t"), partition_by=["p"], properties={"medallion.buckets": "2"})
    spec = SnapshotSpec(keys=["k"], scd_type="2")
    for number in (1, 2):
        rows = spark.range(4000).selectExpr("id AS k", "id % 20 AS p", f"id * {number} AS v")
        tables.apply_snapshot(rows, target, spec, number)
    files = list((tmp_path / "t" / "state" / "__v=2").rglob("*.parquet"))
    assert len(files) <= 2 * 2 * 20 + 8
    assert tables.read(spark, target.path).count() == 8000 - 1  # 0 stays 0
