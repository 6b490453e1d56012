import hashlib
import random
import zlib

import duckdb
import pytest
from helpers import LOWER
from pyspark.sql import functions as F

from medallion.llm.manifest import Layout, manifest, placed
from medallion.llm.oracles import ORACLES
from medallion.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, leaf int, _tree string, slots int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    fields = [row[0], row[3], row[2], row[4], row[1]]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, at, own):
    siblings = []
    for nodes in levels[:-1]:
        run, slot = nodes[at - at % 16 : at - at % 16 + 16], at % 16
        siblings += run[:slot] + run[slot + 1 :]
        own = digest("".join(run[:slot] + [own] + run[slot + 1 :]))
        at //= 16
    return siblings, own


def brute(rows):
    """The query's rows, by sorting each source."""
    groups = {}
    for row in rows:
        changed = row
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
            changed = (row[0], row[1].translate(LOWER), *row[2:])
        key = (row[3] is not None, (row[3] or "").encode())
        groups.setdefault(key, []).append(((row[0] is not None, row[0] or 0), leaf_of(row), row[0], leaf_of(changed)))
    names = sorted(groups)
    trees = {name: tree_of([leaf for _, leaf, _, _ in sorted(groups[name], key=lambda r: r[:2])]) for name in names}
    top = tree_of([trees[name][-1][0] for name in names]) if names else []
    found = []
    for n, name in enumerate(names):
        for at, (_, leaf, i, claimed) in enumerate(sorted(groups[name], key=lambda r: r[:2])):
            siblings, subroot = climb(trees[name], at, claimed)
            more, folded = climb(top, n, subroot)
            root = top[-1][0]
            found.append((i, leaf, trees[name][-1][0], root, digest("".join(siblings + more)), folded, folded == root))
    return found


def rows_of(seed, size, sources, ids):
    rng = random.Random(seed)
    found = []
    for i in range(size):
        text = rng.choice([None, "", "Some Text é", f"words {i}", f"WORDS {rng.randrange(9)} " * rng.randrange(40)])
        found.append((ids(rng, i), text, rng.choice([None, "en", "de"]), rng.choice(sources), rng.choice([None, i])))
    return found


def table(spark, rows, parts=5):
    more = [(*row, "x", 1, "y", 2) for row in rows]
    return spark.createDataFrame(more, SCHEMA).repartition(parts)


def checked(spark, rows, tmp_path, name):
    folder = tmp_path / name
    table(spark, rows).write.parquet(str(folder / "documents.parquet"))
    found = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, str(folder)).collect()), key=repr)
    assert found == sorted(brute(rows), key=repr)
    return found, folder


IDS = {
    "dense": lambda rng, i: i,
    "negative": lambda rng, i: i - 500,
    "sparse": lambda rng, i: rng.randrange(-(1 << 63), 1 << 63),
    "repeated": lambda rng, i: rng.choice([None, 7, -(1 << 63), (1 << 63) - 1, rng.randrange(40)]),
}


@pytest.mark.parametrize("kind", IDS)
def test_query_against_sorted_trees(spark, tmp_path, kind):
    rows = rows_of(3, 700, ["a", "b", "é", None, "", "B" * 30, "hot", "hot", "hot", "hot"], IDS[kind])
    found, folder = checked(spark, rows + rows[:9], tmp_path, kind)
    assert {r[6] for r in found} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert sorted(con.execute(ORACLES["op11_merkle_manifest"]).fetchall(), key=repr) == found


def test_steps_of_several_blocks(spark):
    """Blocks of 16 places, so that trees take several steps, also the tree of sources."""
    small = Layout(levels=1, fan_bits=1, copies=3)
    sources = ["hot"] * 500 + [f"s{i}" for i in range(500)]
    rows = rows_of(4, 1600, sources, lambda rng, i: rng.choice([i, i, rng.randrange(1 << 40), 5]))
    # one row many times over
    rows += [(5, "copy", "en", "hot", 1)] * 50
    built = manifest(table(spark, rows), layout=small)
    assert len(built.leaves.blocks) == 3 and len(built.trees.blocks) == 3
    expected = sorted(((*r[:5], r[3], True) for r in brute(rows)), key=repr)
    assert sorted(map(tuple, built.proofs().collect()), key=repr) == expected


@pytest.mark.parametrize("size", [1, 2, 16, 17])
def test_one_source(spark, tmp_path, size):
    rows = [(i, "T", "en", "s", i) for i in range(size)]
    found, _ = checked(spark, rows, tmp_path, str(size))
    assert all(r[2] == r[3] for r in found)
    if size == 1:
        assert found[0][1] == found[0][3] and found[0][4] == digest("")


def test_siblings_fold_to_the_root(spark):
    rows = rows_of(5, 300, ["a", "b", None], IDS["dense"])
    built = manifest(table(spark, rows))
    for row in built.proofs(siblings=True).collect():
        assert row.proof_sha256 == digest("".join(row.siblings))
        assert row.verified and row.folded_root == row.root == built.root
    groups = {r.group: r.subroot for r in built.groups().collect()}
    assert set(groups) == {"a", "b", None}


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect() == []
    built = manifest(table(spark, []))
    assert built.root is None and built.groups().collect() == []


def test_other_columns_and_names(spark):
    docs = spark.createDataFrame([("g", 2, "x", "y"), ("g", 1, "z", None)], "text string, key int, path string, root string")
    built = manifest(docs, ("key", "root"), id_column="key", group_column="text")
    found = built.proofs().collect()
    assert {r.key for r in found} == {1, 2}
    assert built.root == digest(digest("1:1-") + digest("1:21:y"))


def test_places_without_sorting_rows(spark):
    """The plan joins rows with the directory; no window runs over rows."""
    leaves = spark.range(1000).select(
        F.lit("=s").alias("_tree"), "id", F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("leaf"),
        F.lit(None).cast("binary").alias("claimed"),
    )
    found = placed(leaves)
    assert {r.id: r._place for r in found.collect()} == {i: i for i in range(1000)}
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
