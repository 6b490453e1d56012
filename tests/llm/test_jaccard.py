import random
from collections import defaultdict

import pytest
from helpers import LOWER, as_rows, documents, frame, words

from medallion.llm import jaccard
from medallion.llm.components import components


def sets_of(text, size):
    w = words((text or "").translate(LOWER))
    if 0 < len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[p : p + size]) for p in range(len(w) - size + 1))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, size=5, percent=80):
    found = [sets_of(t, size) for _, t, *_ in rows]
    pairs = []
    for i, x in enumerate(found):
        for j in range(i):
            y = found[j]
            shared = len(x & y)
            if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                pairs.append((i, j))
    label = groups(pairs, range(len(rows)))
    least = defaultdict(list)
    for i, n in label.items():
        if rows[i][0] is not None:
            least[n].append(rows[i][0])
    return sorted(
        ((rows[i][0], len(found[i]), min(least[n]) if found[i] and least[n] else rows[i][0]) for i, n in label.items()),
        key=repr,
    )


def chained(rng):
    """Versions that drift: neighbours are linked, ends are not; and a cloud of near copies."""
    text = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    rows, i = [], 5000
    for step in range(25):
        rows.append((i + step, " ".join(text), "en"))
        text[(step * 7) % 60] = f"x{step}"
    cloud = [f"c{rng.randrange(10**6)}" for _ in range(80)]
    for step in range(60):
        own = list(cloud)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            own[rng.randrange(80)] = f"y{rng.randrange(10**6)}"
        rows.append((6000 + step, " ".join(own), "en"))
    for n in (3, 4, 5, 8, 9):
        rows.append((7000 + n, " ".join(f"s{k}" for k in range(n)), "en"))
    return rows


@pytest.mark.parametrize("parts", [1, 5])
def test_against_all_pairs(spark, parts):
    rows = documents() + chained(random.Random(parts))
    found = jaccard.near_duplicates(frame(spark, rows, parts))
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == brute(rows)


def test_other_sizes(spark):
    rows = documents(seed=2, size=25) + chained(random.Random(9))
    found = jaccard.near_duplicates(frame(spark, rows), size=2, percent=50)
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == brute(rows, 2, 50)


def test_one_of_each(spark):
    rows = documents()
    docs = frame(spark, rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = brute(rows)
    one = {c for i, n, c in want if n} - {None}
    got = [r for r in kept.collect()]
    assert {r.doc_id for r in got if words(r.text)} - {None} == one
    assert len([r for r in got if words(r.text)]) == len(one) + ("lonely text" in {r.text for r in got if r.doc_id is None})
    assert len([r for r in got if not words(r.text)]) == sum(not words(t) for _, t, _ in rows)


def test_empty_table(spark):
    none = frame(spark, [(1, "x", "en")]).filter("false")
    assert jaccard.near_duplicates(none).collect() == []
    assert jaccard.one_of_each(none).collect() == []
    assert jaccard.near_duplicates(frame(spark, [(1, None, None), (2, "", None)])).count() == 2


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, n) for n in range(501, 560)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7)]
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(3))
    assert {r.node: r.component for r in found.collect()} == groups([p for p in pairs if p[0] != p[1]], nodes)
    assert found.count() == len(nodes)
