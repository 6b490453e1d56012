import random

import pytest
from helpers import documents, frame, prose

from medallion.llm.decontamination import contamination, uncontaminated

import re

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def terms(text):
    return WORD.findall((text or "").encode().translate(FOLD))


def brute(rows, items, window=10):
    found = {}
    for i, text in items:
        w = terms(text)
        size = min(window, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            found.setdefault(tuple(w[p : p + size]), set()).add(i)
    out = []
    for i, text, *_ in rows:
        w, hit, which = terms(text), set(), set()
        for size in {len(k) for k in found}:
            for p in range(len(w) - size + 1):
                own = found.get(tuple(w[p : p + size]))
                if own:
                    which |= own
                    hit.update(range(p, p + size))
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(x for x in which if x is not None))))
    return sorted(out, key=repr)


def planted():
    rng = random.Random(3)
    rows = documents()
    items = [(0, None), (1, ""), (2, "...!"), (3, "one Two-three"), (None, prose(rng, 30)), (4, "zero")]
    for k in range(5, 12):
        text = prose(rng, 25)
        items += [(k, text), (k, text)]
        words = text.split()
        rows.append((1000 + k, prose(rng, 30) + " ".join(words[k - 4 : k + 8]) + " " + prose(rng, 9), "en"))
        rows.append((1100 + k, prose(rng, 30) + " ".join(words[:9]) + " " + prose(rng, 9), "en"))
        rows.append((1200 + k, text.upper() + "  " + text.replace(" ", "--"), "en"))
    items.append((12, items[8][1] + items[10][1]))
    rows.append((1300, "zero one, two THREE. zero", "en"))
    rows.append((1301, items[4][1], "en"))
    return rows, items


def test_against_brute_force(spark):
    rows, items = planted()
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    found = contamination(frame(spark, rows), table).collect()
    got = sorted(
        (
            (r.doc_id, r.n_words, tuple(p for s in r.spans for p in range(s["from"], s["to"])), tuple(r["items"]))
            for r in found
        ),
        key=repr,
    )
    assert got == brute(rows, items)
    for r in found:
        assert all(a["to"] < b["from"] for a, b in zip(r.spans, r.spans[1:]))
    left = uncontaminated(frame(spark, rows), table)
    assert left.columns == frame(spark, rows).columns
    want = sorted((r[0] for r in got if not r[2]), key=repr)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == want


@pytest.mark.parametrize("side", ["docs", "items"])
def test_empty_tables(spark, side):
    docs = frame(spark, [(1, "a b c", "en")])
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    if side == "docs":
        assert contamination(docs.filter("false"), items).collect() == []
    else:
        found = contamination(docs, items.filter("false")).collect()
        assert [(r.n_words, r.spans, r["items"]) for r in found] == [(3, [], [])]


def test_a_passage_in_a_very_long_text(spark):
    filler = [f"u{i}" for i in range(300_000)]
    passage = [f"P{i}" for i in range(40)]
    text = " ".join(filler[:200_000] + passage + filler[200_000:])
    items = spark.createDataFrame([(7, " ".join(passage).lower())], "item_id long, text string")
    [row] = contamination(frame(spark, [(1, text, "en")]), items).collect()
    assert (row.n_words, row["items"]) == (300_040, [7])
    assert [(s["from"], s["to"]) for s in row.spans] == [(200_000, 200_040)]
