import math
import random
import re
from collections import Counter

import pytest
from helpers import LOWER, prose

from medallion.llm.licenses import LICENCE_FILE, TEMPLATES, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, path string, text string, license string, template int, score int"


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, least=0.8, share=0.5):
    vocabulary = {w for _, t in TEMPLATES for w in terms(t)}
    df = Counter(w for *_, t in rows for w in set(terms(t)) & vocabulary)
    idf = lambda w: math.log((1 + len(rows)) / (1 + (df[w] if w in vocabulary else 0))) + 1

    def vector(text):
        found = {w: n * idf(w) for w, n in Counter(terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in found.values()))
        return {w: x / norm for w, x in found.items()} if norm else {}

    templates = [vector(t) for _, t in TEMPLATES]
    own = []
    for i, path, text in rows:
        lines = (text or "").split("\n")
        paragraphs = re.split(r"(?:^|\n)[ \t\r\v\f]*(?=\n)", text or "")
        best = (0.0, None, 0)
        for unit in [*lines, *paragraphs]:
            v = vector(unit)
            if not v:
                continue
            similar = [round(sum(x * t.get(w, 0) for w, x in v.items()), 9) for t in templates]
            top = max(similar)
            if top >= least - 1e-9 and top > best[0]:
                best = (top, similar.index(top), len(terms(unit)) / len(terms(text)))
        name = TEMPLATES[best[1]][0] if best[1] is not None else None
        own.append((i, path, name, None if name is None else round(best[0], 6), best[2]))
    above = {}
    for i, path, name, score, part in own:
        if name and path is not None and (part >= share or re.search(LICENCE_FILE, path)):
            folder = path.rpartition("/")[0]
            above[folder] = min(above.get(folder, (9,)), (-score, path, i, name))
    out = []
    for i, path, name, score, _ in own:
        inherited = from_id = None
        folder = None if path is None else path.rpartition("/")[0]
        while name is None and folder is not None:
            if folder in above:
                inherited, from_id = above[folder][3], above[folder][2]
                break
            folder = folder.rpartition("/")[0] if folder else None
        out.append((i, path, name, score, name or inherited, from_id))
    return sorted(out, key=repr)


def files():
    rng = random.Random(5)
    rows, i = [], 0
    folders = ["", "a", "a/b", "a/b/c", "a/b/c/d", "ab", "z/y", "z"]

    def add(path, text):
        nonlocal i
        rows.append((i, path, text))
        i += 1

    for folder in folders:
        for k in range(6):
            add(f"{folder}/f{k}.txt".lstrip("/"), prose(rng, 60))
    notices = [t for _, t in TEMPLATES]
    add("a/LICENSE", notices[0] + "\n" + prose(rng, 80))
    add("a/b/c/short", notices[3])
    add("a/b/c/other", notices[5])
    add("z/y/COPYING.md", prose(rng, 30) + "\n" + notices[5].upper() + "\n" + prose(rng, 30))
    add("z/y/x/q.txt", prose(rng, 5))
    for k, notice in enumerate(notices):
        add(f"ab/n{k}.txt", prose(rng, 40) + "\n# " + notice + "\n" + prose(rng, 40))
        add(f"ab/w{k}.txt", prose(rng, 40) + "\n\n" + notice.replace(" ", "\n# ", 8) + "\n \n" + prose(rng, 40))
        add(f"ab/h{k}.txt", prose(rng, 40) + " " + notice + " " + prose(rng, 40))
        add(f"ab/c{k}.txt", notice + " " + " ".join(["some", "other", "words"][: k % 4]))
    rows += [(500, None, notices[0]), (501, None, None), (502, "a/b/c/d/null", None), (503, "ab/e", ""), (504, "long", "the " * 50_000)]
    return rows + rows[50:53]


def test_against_brute_force(spark):
    rows = files()
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    found = scan(df)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = brute(rows)
    assert found.columns == ["doc_id", "path", "own_license", "score", "license", "inherited_from"]
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6, nan_ok=True)
    assert {g[2] for g in got} >= {"MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", None}
    assert any(g[5] is not None for g in got)


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "p", "t")], "doc_id long, path string, text string")
    assert scan(df.filter("false")).collect() == []
