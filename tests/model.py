"""Plain Python models of the change-data semantics, for small inputs."""

from __future__ import annotations

import random

EVENT_SCHEMA = "id int, seq long, op string, a string, b int"


def random_events(seed: int, rows: int = 60, ids: int = 4, seqs: int = 200, null_share: float = 0.25):
    """Events with deletes, nulls and a null key; sequences are unique per key."""
    rng = random.Random(seed)
    keys = [None, *range(ids - 1)]
    # the first key holds a large share of the rows
    weights = [rows, *[rows // 4] * (ids - 1)]
    taken, out = set(), []
    while len(out) < rows:
        key, seq = rng.choices(keys, weights)[0], rng.randrange(seqs)
        if (key, seq) in taken:
            continue
        taken.add((key, seq))
        a = None if rng.random() < null_share else rng.choice("xy")
        b = None if rng.random() < null_share else rng.randrange(2)
        out.append((key, seq, "D" if rng.random() < 0.15 else "U", a, b))
    rng.shuffle(out)
    return out


def by_key(events):
    groups = {}
    for e in sorted(events, key=lambda e: e[1]):
        groups.setdefault(e[0], []).append(e)
    return groups


def fill(events):
    """Nulls take the latest value since the last delete."""
    out = []
    for group in by_key(events).values():
        a = b = None
        for key, seq, op, na, nb in group:
            if op == "D":
                a = b = None
                out.append((key, seq, op, na, nb))
            else:
                a, b = (a if na is None else na), (b if nb is None else nb)
                out.append((key, seq, op, a, b))
    return out


def type1(events):
    last = [group[-1] for group in by_key(events).values()]
    return {(e[0], e[3], e[4]) for e in last if e[2] != "D"}


def type2(events, tracked=("a", "b")):
    rows = []
    for key, group in by_key(events).items():
        current = None
        for _, seq, op, a, b in group:
            value = {"a": a, "b": b}
            if op == "D":
                if current:
                    rows.append((key, current["a"], current["b"], current["s"], seq))
                current = None
            elif current and all(current[t] == value[t] for t in tracked):
                current.update(value)
            else:
                if current:
                    rows.append((key, current["a"], current["b"], current["s"], seq))
                current = {**value, "s": seq}
        if current:
            rows.append((key, current["a"], current["b"], current["s"], None))
    return sorted(rows, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
