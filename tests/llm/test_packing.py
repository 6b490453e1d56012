import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm.packing import best_fit, pack, tokenized

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences(plan, capacity):
    found = {}
    for length, rank, number, sequence, offset in plan:
        for i in range(number):
            found.setdefault(sequence + i, []).append((offset, length, rank + i))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50])
    histogram = {n: rng.randrange(0, 30) for n in rng.sample(range(1, capacity + 1), min(capacity, 12))}
    found = sequences(best_fit(histogram, capacity), capacity)
    pieces = sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True)
    rooms = []
    for n in pieces:
        fitting = [i for i, r in enumerate(rooms) if r >= n]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    assert len(found) == len(rooms)
    seen = []
    for slots in found.values():
        slots.sort()
        at = 0
        for offset, length, rank in slots:
            assert offset == at
            at += length
            seen.append((length, rank))
        assert at <= capacity
    assert sorted(seen) == sorted((n, i) for n, c in histogram.items() for i in range(c))


def test_plan_does_not_grow_with_counts():
    few = best_fit({n: 50 for n in range(1, 200)}, 256)
    many = best_fit({n: 50_000_000 for n in range(1, 200)}, 256)
    assert len(many) < 3 * len(few) + 200


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_slots(spark, capacity):
    rows = documents(length=40)
    rows += [(500, "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b don't it's 'S 12.5%|x '|s' é", "en"),
             (501, "A b c Été... 世界 ##!! x\x00y", "en")]
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            want.append((i, start // capacity, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    found = pack(frame(spark, rows), PATH, capacity=capacity, derive={"crc": F.crc32("ids")}).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.crc) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in by.values():
        slots.sort()
        assert all(o == sum(n for _, n in slots[:k]) for k, (o, _) in enumerate(slots))
        assert sum(n for _, n in slots) <= capacity
    assert sorted(by) == list(range(len(by)))


def test_ids_are_returned_and_empty_tables(spark):
    one = pack(frame(spark, [(1, "hello world", "en")]), PATH).collect()
    assert np.frombuffer(one[0].ids, "<u4").tolist() == Tokenizer.from_file(PATH).encode(
        "hello world", add_special_tokens=False
    ).ids + [0]
    none = frame(spark, [(1, "x", "en")]).filter("false")
    assert pack(none, PATH).collect() == []
    assert tokenized(none, PATH).count() == 0
