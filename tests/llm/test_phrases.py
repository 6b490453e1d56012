import random
import re
from collections import Counter
from types import SimpleNamespace

import duckdb
import pyarrow as pa
from helpers import LOWER, documents, frame

import medallion.llm.phrases as module
from medallion.llm.oracles import ORACLES
from medallion.llm.phrases import phrase_graph
from medallion.llm.queries import QUERIES

PIECE = re.compile("[.,;:!?\x0a-\x0d]")
WORD = re.compile("[^\x20\x09]+")


def counted(rows, order=4):
    found, words = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        grams = found.setdefault(lang, Counter())
        for piece in PIECE.split((text or "").translate(LOWER)):
            ws = WORD.findall(piece)
            words[lang] += len(ws)
            for k in range(1, order + 1):
                grams.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    return found, words


def brute(rows, least=30, top=2000, order=4):
    result = []
    for lang, grams in counted(rows, order)[0].items():
        n = counted(rows, order)[1][lang]
        phrases = {g: a for g, a in grams.items() if len(g) > 1 and a >= least}
        around = Counter()
        for g, a in phrases.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    around[g[i : i + k]] = max(around[g[i : i + k]], a)
        kept = []
        for g, a in phrases.items():
            if 100 * around[g] >= 80 * a:
                continue
            score, _, l, r = min(
                (2000000 * a // (grams[g[:k]] + grams[g[k:]]), k, grams[g[:k]], grams[g[k:]]) for k in range(1, len(g))
            )
            kept.append((-score, -a, " ".join(g).encode(), " ".join(g), a, l, r, n, score))
        result += [(lang, i + 1, *row[3:]) for i, row in enumerate(sorted(kept)[:top])]
    return sorted(result)


def long_rows(seed=3):
    """Passages that repeat, cycles of words, pieces of all lengths, texts without marks."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(40)] + ["é", "日本", "a", "the"]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = documents(seed)
    for i in range(400):
        text = " ".join(rng.choices(vocabulary, weights=[1] * 42 + [30, 40], k=rng.randrange(60)))
        text = re.sub(" ", lambda m: rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\v"]), text)
        rows.append((1000 + i, text, rng.choice(["en", "en", "de", None, "und", ""])))
        if i % 5 == 0:
            rows.append((2000 + i, f"{text} {passage}. end{i} {passage} tail", "en"))
        if i % 9 == 0:
            rows.append((3000 + i, "x y " * rng.randrange(1, 40), "de"))
    rows += [(4000, "a " * 500, "en"), (4001, "k" * 100_000, "en"), (4002, "b c d e f g h " * 60, None)] * 2
    return rows


def test_collocations(spark):
    rows = long_rows()
    found = phrase_graph(frame(spark, rows)).collocations()
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    result = sorted(map(tuple, found.collect()))
    assert result == brute(rows)
    assert len({row[0] for row in result}) >= 3 and len(result) > 40


def test_small_slices_and_flushes(monkeypatch):
    """The rows of a task do not depend on how its texts are cut."""
    rows = [(text, lang or "und") for _, text, lang in long_rows() if text]
    batch = pa.RecordBatch.from_pydict({"text": [r[0] for r in rows], "lang": [r[1] for r in rows]})
    everything = SimpleNamespace(value=module.np.full(1 << 17, 255, "uint8"))

    def grams():
        found = Counter()
        for part in module._gram_rows(4, 20, everything)(iter([batch])):
            for row in part.to_pylist():
                found[row["lang"], row["size"], row["gram"]] += row["n"]
        return found

    def pairs():
        parts = [p for b in module._pair_rows(20, 30)(iter([batch])) for p in b.to_pylist()]
        chunks = pa.RecordBatch.from_pylist(parts)
        return {r["chunk"]: r["bits"] for b in module._frequent_chunks(30)(iter([chunks])) for r in b.to_pylist()}

    whole = grams(), pairs()
    monkeypatch.setattr(module, "SLICE_BYTES", 700)
    monkeypatch.setattr(module, "FLUSH_PAIRS", 100)
    assert (grams(), pairs()) == whole


def test_counts_and_paths(spark, monkeypatch):
    monkeypatch.setattr(module, "PATH_EDGES", 7)
    rows = long_rows(5)
    graph = phrase_graph(frame(spark, rows), least=10)
    grams, words = counted(rows)
    expected = {(lang, " ".join(g), len(g), a) for lang, c in grams.items() for g, a in c.items() if a >= 10}
    assert {tuple(r) for r in graph.counts.collect()} == expected
    assert graph.counts.count() == len(expected)
    assert {r.lang: r.n for r in graph.words.collect()} == {k: v for k, v in words.items() if v}
    edges = {(lang, p, n) for lang, p, size, n in expected if size == 4}
    paths = [tuple(r) for r in graph.paths.collect()]
    read = [
        (lang, " ".join(path.split(" ")[i : i + 4]), n) for lang, path, n in paths for i in range(len(path.split(" ")) - 3)
    ]
    assert len(read) == len(set(read)) and set(read) == edges
    assert len(paths) < len(edges) / 2
    assert any(path.startswith("p0 p1 p2 p3 p4 p5 p6") for _, path, _ in paths)
    # the words of the cycle b..h only lead to each other, but it has an entry and an exit
    assert max(len(path.split(" ")) for _, path, _ in paths) <= 10


def test_cycle_without_entry(spark):
    edges = spark.createDataFrame(
        [("l", " ".join("abcde"[(i + j) % 5] for j in range(4)), 9) for i in range(5)] + [("l", "v w x y", 9), ("l", "w x y z", 9)],
        "lang string, gram string, n long",
    )
    paths = sorted(r.path for r in module._paths(edges, 4).collect())
    assert paths == ["a b c d", "b c d e", "c d e a", "d e a b", "e a b c", "v w x y z"]


def test_other_orders_and_bounds(spark):
    rows = long_rows(6)
    found = phrase_graph(frame(spark, rows), order=3, least=12).collocations(top=25)
    assert sorted(map(tuple, found.collect())) == brute(rows, 12, 25, 3)


def test_sums_beyond_64_bits(spark):
    big = 1 << 62
    phrases = spark.createDataFrame([("l", "a b", 2, big - 1)], "lang string, phrase string, size int, a long")
    counts = spark.createDataFrame([("l", "a", 1, big), ("l", "b", 1, big + 5)], "lang string, gram string, size int, n long")
    row = module._scored(phrases, counts, 4).first()
    assert (row.score, row.l, row.r) == (2000000 * (big - 1) // (2 * big + 5), big, big + 5)


def test_buckets_do_not_change_results(spark, monkeypatch):
    rows = long_rows(8)
    expected = brute(rows)
    monkeypatch.setattr(module, "_frequent_pairs", lambda texts, least: (module.np.full(1 << 17, 255, "uint8"), 20))
    assert sorted(map(tuple, phrase_graph(frame(spark, rows)).collocations().collect())) == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrase_graph(docs).collocations().collect() == []
    docs = spark.createDataFrame([(None, "en"), ("", None), (" .;", "de")], "body string, gram string")
    graph = phrase_graph(docs, text_column="body", lang_column="gram")
    assert graph.collocations().collect() == [] and graph.paths.collect() == []


def test_query_and_sql(spark, tmp_path):
    rows = long_rows(9)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = sorted(con.execute(ORACLES["op13_phrase_collocations"]).fetchall())
    assert expected == brute(rows)
    assert sorted(map(tuple, QUERIES["op13_phrase_collocations"](spark, str(tmp_path)).collect())) == expected
