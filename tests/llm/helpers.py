"""Fixtures and brute-force versions shared by the tests of the training-data operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, _id string, n int, class string, piece string, spans int"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    """Words with punctuation, lines, accents and odd spaces."""
    found = []
    for _ in range(n):
        word = "w" + format(int(vocabulary * rng.random() ** 2), "x") + rng.choice(["", "", "", "é", ",", ".", "Z"])
        found += [word, rng.choice([" ", " ", " ", " ", "\n", "  ", "\t", "\r\n"])]
    return "".join(found)


def documents(seed: int = 7, size: int = 40, length: int = 60) -> list[tuple]:
    """Rows (doc_id, text, lang): nulls, empty and long texts, copies, near copies, repeated rows."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t", "one", "one two three", "One  two three", "ÉÉ é"]
    base = prose(rng, length)
    passage = prose(rng, length)
    for i in range(size):
        texts.append(prose(rng, rng.randrange(1, 2 * length)))
        if i % 4 == 0:
            texts.append(prose(rng, 20) + passage + prose(rng, 15))
        if i % 5 == 0:
            changed = base.split(" ")
            changed[rng.randrange(len(changed))] = f"new{i}"
            texts.append(" ".join(changed))
        if i % 6 == 0:
            texts.append(base)
    texts.append(prose(rng, 40 * length))
    texts.append("a " * (3 * length))
    rows = [(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:2] + [(None, base, "en"), (None, "lonely text", "en")]


def frame(spark, rows, parts: int = 3):
    """The rows with further columns whose names clash with those the operators use."""
    more = [(i, t, lang, "x", 1, "y", "z", 2) for i, t, lang in rows]
    return spark.createDataFrame(more, SCHEMA).repartition(parts)


def as_rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
