"""The stages, each held against a brute-force version on its own input."""

import random
import re

import pytest
from helpers import documents, prose, words
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_jaccard import brute as grouped
from test_quality import verdicts

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    items = [(k, prose(rng, 30)) for k in range(8)]
    rows = documents(length=90)
    for k, text in items[:5]:
        rows.append((800 + k, prose(rng, 60) + " " + text + " " + prose(rng, 20), "en"))
    for k in range(6):
        rows.append((850 + k, prose(rng, 70) + f" mail me.{k}@x.org or 4111 1111 1111 1111 on 10.0.0.{k} " + prose(rng, 9), "en"))
    target = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], SCHEMA).write.parquet(f"{target}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{target}/benchmark.parquet")
    return target, items


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder[0]), f"test-{name}")
        found.append(docs)
    return dict(zip(["documents", *[n for n, _ in corpus_pipeline.STAGES]], found))


def rows_of(df):
    return [(r.doc_id, r.text, r.lang) for r in df.collect()]


def test_columns(stages):
    names = list(stages)
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns
    assert names == ["documents", "quality", "near_duplicates", "decontamination", "pii", "packing"]


def test_quality(stages):
    before, after = rows_of(stages["documents"]), rows_of(stages["quality"])
    verdict = verdicts([(at, text, lang) for at, (_, text, lang) in enumerate(before)])
    assert sorted(after, key=repr) == sorted((r for at, r in enumerate(before) if verdict[at][0]), key=repr)


def test_near_duplicates(stages):
    before, after = rows_of(stages["quality"]), rows_of(stages["near_duplicates"])
    groups = {c for _, n, c in grouped(before)}
    assert sorted((r[0] for r in after), key=repr) == sorted(groups, key=repr)
    assert all(r in before for r in after)


def test_decontamination(stages, folder):
    before, after = rows_of(stages["near_duplicates"]), rows_of(stages["decontamination"])
    clean = [i for i, _, hit, _ in contaminated(before, folder[1]) if not hit]
    assert sorted((r[0] for r in after), key=repr) == sorted(clean, key=repr)
    assert len(after) < len(before)


def test_pii(stages):
    before = {r.doc_id: r for r in stages["decontamination"].collect()}
    after = {r.doc_id: r for r in stages["pii"].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        if i is not None and 850 <= i < 860:
            assert not re.search(r"me\.\d@x\.org|4111 1111 1111 1111|10\.0\.0\.\d ", r.text)
            assert len(words(r.text)) == len(words(before[i].text))
        else:
            assert r.text == before[i].text


def test_packing(spark, stages, folder):
    found = stages["packing"].collect()
    assert sorted({r.doc_id for r in found}, key=repr) == sorted((r[0] for r in rows_of(stages["pii"])), key=repr)
    ids = {}
    for r in found:
        ids.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in ids.values():
        slots.sort()
        assert all(o == sum(n for _, n in slots[:k]) for k, (o, _) in enumerate(slots))
    whole = corpus_pipeline.run(spark, folder[0])
    key = lambda r: (repr(r.doc_id), r.piece)
    assert [(r.doc_id, r.piece, r.ids_crc32) for r in sorted(whole.collect(), key=key)] == [
        (r.doc_id, r.piece, r.ids_crc32) for r in sorted(found, key=key)
    ]


CLASHING = (
    "kept", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "perplexity", "entropy",
    "_bytes", "_log", "_c0", "_d0", "_found", "pieces", "Values", "given", "_id", "_key", "_text", "_lang", "_hit_id",
    "_hit_key", "_first_id", "_first_key", "_same", "times", "component", "class", "gram", "at", "n", "spans", "ids", "piece",
    "start", "length", "sequence_id", "offset", "ids_crc32", "a.b",
)


def test_clashing_columns(spark, folder, stages):
    """Every stage gives the rows it gives without them, with these columns as they were."""
    names = list(stages)
    for name, before, stage in zip(names[1:], names, [s for _, s in corpus_pipeline.STAGES]):
        docs = stages[before].withColumns({c: F.lit(f"x{i}") for i, c in enumerate(CLASHING)})
        found = stage(spark, docs, folder[0])
        same = stages[name].columns
        if name != "packing":
            assert found.columns == docs.columns, name
            extra = found.select(F.array(*[F.col(f"`{c}`") for c in CLASHING])).distinct().collect()
            assert [r[0] for r in extra] == [[f"x{i}" for i in range(len(CLASHING))]], name
        else:
            same = ["doc_id", "piece", "ids_crc32"]
        got, wanted = (sorted(map(tuple, df.select(*same).collect()), key=repr) for df in (found, stages[name]))
        assert got == wanted, name


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder[0])
        assert docs.collect() == []
