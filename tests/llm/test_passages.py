import random
from collections import Counter
from functools import partial

import pytest
from helpers import documents, frame, prose, words

from medallion.llm import substrings, suffixes
from medallion.llm.passages import repeated_windows


def covered(hits, size, n):
    gone = set()
    for p in hits:
        gone.update(range(p, p + size))
    return [p in gone for p in range(n)]


def spans(gone):
    found, start = [], None
    for p, g in enumerate([*gone, False]):
        if g and start is None:
            start = p
        elif not g and start is not None:
            found.append((start, p))
            start = None
    return found


def earlier_words(rows, size):
    first = {}
    for i, text, *_ in rows:
        w = words(text)
        for p in range(len(w) - size + 1 if i is not None else 0):
            key = tuple(w[p : p + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        hits = [
            p for p in range(len(w) - size + 1 if i is not None else 0) if first[tuple(w[p : p + size])] < i
        ]
        gone = covered(hits, size, len(w))
        out.append((i, len(w), spans(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def repeated_bytes(rows, size):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = Counter(b[p : p + size] for _, b in data for p in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = covered([p for p in range(len(b) - size + 1) if count[b[p : p + size]] > 1], size, len(b))
        out.append((i, len(b), spans(gone), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    rows = documents(seed)
    common = prose(rng, 30)
    for k in range(25):  # a common passage in ever new surroundings, and periodic texts
        rows.append((2000 + k, prose(rng, rng.randrange(12)) + common + prose(rng, rng.randrange(12)), "en"))
    rows.append((2100, "a b " * 60, "en"))
    rows.append((2101, "b a " * 40 + "c", "en"))
    rows.append((2102, "x" * 300, "en"))
    return rows


def limited(monkeypatch, module, large):
    monkeypatch.setattr(module, "repeated_windows", partial(repeated_windows, large=large))


@pytest.mark.parametrize("seed, window, gram, large", [(1, 12, 4, 20_000), (2, 8, 8, 20_000), (3, 12, 4, 2), (4, 50, 16, 20_000)])
def test_words_of_earlier_documents(spark, monkeypatch, seed, window, gram, large):
    limited(monkeypatch, substrings, large)
    rows = corpus(seed)
    found = substrings.without_earlier(frame(spark, rows), window=window, gram=gram).collect()
    got = sorted(
        ((r.doc_id, r.n_words, [(s["from"], s["to"]) for s in r.spans], r.kept) for r in found), key=repr
    )
    assert got == earlier_words(rows, window)


@pytest.mark.parametrize("seed, window, gram, large", [(1, 40, 13, 20_000), (2, 24, 24, 20_000), (3, 40, 13, 2), (4, 400, 128, 20_000)])
def test_bytes_that_occur_again(spark, monkeypatch, seed, window, gram, large):
    limited(monkeypatch, suffixes, large)
    rows = corpus(seed)
    block = 50 if window == 400 else 7
    found = suffixes.without_repeats(frame(spark, rows), window=window, gram=gram, block=block).collect()
    got = sorted(
        ((r.doc_id, r.n_bytes, [(s["from"], s["to"]) for s in r.spans], bytes(r.kept)) for r in found), key=repr
    )
    assert got == repeated_bytes(rows, window)


@pytest.mark.parametrize("remove", [substrings.without_earlier, suffixes.without_repeats])
def test_empty_tables(spark, remove):
    docs = frame(spark, [(1, None, None), (2, "", None), (None, "x", None)])
    assert len(remove(docs).collect()) == 3
    assert remove(docs.filter("false")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_automaton(seed):
    rng = random.Random(seed)
    automaton, known = substrings.SuffixAutomaton(), {}
    for document in range(12):
        passage = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        for size in (1, 3, 5):
            want = [known.get(tuple(passage[p : p + size]), -1) for p in range(len(passage) - size + 1)]
            assert automaton.windows(passage, size) == want
        automaton.add(passage, document)
        for p in range(len(passage)):
            for q in range(p + 1, len(passage) + 1):
                known.setdefault(tuple(passage[p:q]), document)
    assert len(automaton.link) <= 2 * 12 * 30


def test_multikey_sort():
    import numpy as np

    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 500).astype(np.uint64)
    starts = np.arange(490)
    suffix, group = suffixes.multikey_sort(tokens, starts, [0, 1, 2, 3, 4])
    strings = [tuple(tokens[s : s + 5].tolist()) for s in starts]
    count = Counter(strings)
    assert sorted(suffix.tolist()) == [i for i, s in enumerate(strings) if count[s] > 1]
    ordered = [strings[i] for i in suffix]
    assert ordered == sorted(ordered)
    assert all((a == b) == (g == h) for a, b, g, h in zip(ordered, ordered[1:], group, group[1:]))


def test_a_passage_in_a_very_long_text(spark):
    filler = [f"u{i}" for i in range(300_000)]
    passage = [f"p{i}" for i in range(120)]
    text = " ".join(filler[:150_000] + passage + filler[150_000:])
    short = " ".join(["first", *passage, "end"])
    docs = frame(spark, [(1, short, "en"), (2, text, "en")])
    found = {r.doc_id: r for r in substrings.without_earlier(docs).collect()}
    assert found[1].kept == short and found[2].kept == " ".join(filler)
    assert [(s["from"], s["to"]) for s in found[2].spans] == [(150_000, 150_120)]
    # bytes: the spaces on both sides are the same as well
    common = " " + " ".join(passage) + " "
    found = {r.doc_id: bytes(r.kept).decode() for r in suffixes.without_repeats(docs).collect()}
    assert found == {1: short.replace(common, ""), 2: text.replace(common, "")}


def test_anchors_of_very_long_texts(monkeypatch):
    """Parts of a text give the anchors of the whole."""
    import numpy as np

    from medallion.llm import common

    grams = common.mix(np.arange(5000, dtype=np.uint64) % np.uint64(700))
    whole = common.window_anchors(grams, 40)
    monkeypatch.setattr(common, "_PLACE_BITS", 9)
    assert (common.window_anchors(grams, 40) == whole).all()
    monkeypatch.setattr(common, "_PLACE_BITS", 28)
    assert len(common.window_anchors(grams[:39], 40)) == 0
