"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

The plan is made over a histogram of lengths, which has at most ``capacity``
entries whatever the number of documents: best-fit places whole runs of equal
pieces into runs of equal sequences. Pieces then take the planned slots by their
rank among the pieces of their length.

Defined results: a null text counts as empty; every document has at least its
separator; repeated rows are packed like any others; an empty table gives no rows.
Only the id and text columns are read, so other columns may have any names.
"""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .common import SPACE, Words, binary, byte_sums, ranges, ship, slices, written

#: tokenized units that a Python worker remembers; it forgets all when there are more
CACHE_UNITS = 1_000_000
#: units given to the tokenizer at once
ENCODE_UNITS = 4_000
_LETTER, _MARK = np.zeros((2, 256), bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_MARK[list(b"'|")] = False
_BAR = ord("|")


class WordTokens:
    """Ids of the units of texts, remembered by hash.

    The tokenizer lower-cases and splits at white space and between letters and
    marks, so the ids of a text are those of such units, one after the other. Units
    are not split at apostrophes and bars, which can join a mark and a letter
    (contractions, special tokens); those with bars are told apart by case too.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """keys: sorted hashes that are not known yet."""
        count, flat = np.empty(len(words), np.int64), []
        for i in range(0, len(words), ENCODE_UNITS):
            found = self.tokenizer.encode_batch_fast(words[i : i + ENCODE_UNITS], add_special_tokens=False)
            ids = [e.ids for e in found]
            count[i : i + len(ids)] = [len(x) for x in ids]
            flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
        at = len(self.ids) + np.cumsum(count) - count
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)
        self.count = np.insert(self.count, place, count)
        self.ids = np.concatenate([self.ids, *flat])

    def _units(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first bytes, ends, hashes) of the units of the words."""
        data = words.data
        letter, mark = _LETTER[data], _MARK[data]
        cut = np.flatnonzero((letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])) + 1
        cut = cut[~np.isin(cut, words.offsets)]
        starts = np.sort(np.concatenate([words.starts, cut]))
        ends = np.sort(np.concatenate([words.ends, cut]))
        hashes = byte_sums(data, fold_case=True).hashes(starts, ends)
        bars = np.flatnonzero(data == _BAR)
        if len(bars):
            own = np.unique(np.searchsorted(starts, bars, side="right") - 1)
            hashes[own] = byte_sums(data).hashes(starts[own], ends[own])
        return starts, ends, hashes

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, how many of them come before each document and after the last)."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(words.offsets), np.int64)
        starts, ends, hashes = self._units(words)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        distinct, sample = ordered[new], order[new]
        if len(self.keys) > CACHE_UNITS:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        if not known.all():
            data, some = words.data.tobytes(), sample[~known]
            texts = [
                data[a:b].decode("utf-8", "replace")
                for a, b in zip(starts[some].tolist(), ends[some].tolist())
            ]
            self._learn(distinct[~known], texts)
            place = np.searchsorted(self.keys, distinct)
        which = np.empty(len(hashes), np.int64)
        which[order] = place[np.cumsum(new) - 1]
        count = self.count[which]
        before = np.r_[0, np.cumsum(count)][np.searchsorted(starts, words.offsets)]
        return self.ids[ranges(self.at[which], count)], before


@functools.lru_cache(1)
def _word_tokens(path: str) -> WordTokens:
    """One per Python worker."""
    return WordTokens(path)


def _pieces(path: str, id_column: str, text_column: str, capacity: int, separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _word_tokens(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, data, offsets in slices(batches, text_column):
            words = Words(data, offsets, SPACE)
            ids, before = tokens.encode(words)
            size = np.diff(before) + 1
            ends = np.cumsum(size)
            flat = np.full(int(ends[-1]), separator, np.uint32)
            inner = np.ones(len(flat), bool)
            inner[ends - 1] = False
            flat[inner] = ids
            n_pieces = -(-size // capacity)
            document = np.repeat(np.arange(len(size)), n_pieces)
            piece = ranges(np.zeros(len(size), np.int64), n_pieces)
            length = np.minimum(capacity, size[document] - piece * capacity)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            rank = np.empty(len(length), np.int64)
            rank[order] = seen[ordered] + np.arange(len(length)) - first
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(id_column).take(pa.array(document)),
                    pa.array(piece, pa.int32()),
                    pa.array(piece * capacity, pa.int64()),
                    pa.array(length, pa.int64()),
                    binary(flat.view(np.uint8), np.r_[0, np.cumsum(length) * 4]),
                    pa.array(np.full(len(piece), part), pa.int64()),
                    pa.array(rank, pa.int64()),
                ],
                names=[id_column, "piece", "start", "length", "ids", "_part", "_rank"],
            )

    return run


def tokenized(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 2048,
    separator: int = 0,
) -> DataFrame:
    """Tokenize documents and cut those longer than ``capacity``.

    Returns the id column, ``piece``, ``start``, ``length``, ``ids`` (unsigned
    little-endian 32-bit numbers) and the place of the piece among those of its
    length in its task (``_part``, ``_rank``). The table is written once: ranks
    depend on the order of rows in a task, so they must not be computed twice.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("_part", T.LongType()),
            T.StructField("_rank", T.LongType()),
        ]
    )
    run = _pieces(tokenizer, id_column, text_column, capacity, separator)
    return written(docs.select(id_column, text_column).mapInArrow(run, schema), "pieces")


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, number, first sequence, offset) of runs.

    The longest pieces go first; each goes where the least room is left that is
    enough. Sequences with equal room are interchangeable, so they are kept as runs
    (first sequence, number) per room, and one step fills as much of a run as the
    pieces of a length can. The work depends on the number of lengths, not of pieces.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}
    opened = 0
    for length in sorted((l for l, n in histogram.items() if n > 0), reverse=True):
        left, rank = histogram[length], 0
        open_rooms = sorted(r for r in room if r >= length)
        while left:
            if open_rooms and not room.get(open_rooms[0]):
                room.pop(open_rooms.pop(0), None)
                continue
            if open_rooms:
                space = open_rooms[0]
                sequence, number = room[space].pop()
            else:
                space, sequence = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            each = space // length
            full = min(number, left // each)
            for slot in range(each if full else 0):
                plan.append((length, rank, full, sequence, capacity - space + slot * length))
                rank += full
            left -= full * each
            if full and space - each * length:
                room.setdefault(space - each * length, []).append((sequence, full))
            if number > full:
                rest = number - full
                if left:
                    for slot in range(left):
                        plan.append((length, rank + slot, 1, sequence + full, capacity - space + slot * length))
                    if space - left * length:
                        room.setdefault(space - left * length, []).append((sequence + full, 1))
                    rank, left, rest = rank + left, 0, rest - 1
                if rest:
                    room.setdefault(space, []).append((sequence + number - rest, rest))
    return plan


def _slots(plan: np.ndarray):
    """Rows with length and rank get sequence_id and offset. plan: sorted runs as columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, _, sequences, offsets = plan.value
        keys = lengths << 44 | firsts
        for rows in batches:
            length = rows.column("length").to_numpy(zero_copy_only=False)
            rank = rows.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            keep = [n for n in rows.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(n) for n in keep],
                    pa.array(sequences[at] + rank - firsts[at]),
                    pa.array(offsets[at]),
                ],
                names=[*keep, "sequence_id", "offset"],
            )

    return run


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give every piece of ``tokenized`` its sequence and its offset there.

    Sequences are numbered from 0 and filled without gaps. ``pieces`` may have lost
    or gained columns, but not ``length``, ``_part`` and ``_rank``. The broadcast plan
    has runs of lengths of at most ``capacity``; it does not grow with the rows.
    """
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = np.array(best_fit(histogram, capacity), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))].T.copy()
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rows = pieces.join(before, ["_part", "length"]).select(
        *[c for c in pieces.columns if c not in ("_part", "_rank")],
        (F.col("_rank") + F.col("_before")).alias("_rank"),
    )
    schema = T.StructType(
        [f for f in rows.schema if f.name != "_rank"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return rows.mapInArrow(_slots(spark.sparkContext.broadcast(plan)), schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 2048,
    separator: int = 0,
    derive: dict[str, Column] | None = None,
) -> DataFrame:
    """Documents in sequences: id column, piece, start, length, derived columns, sequence_id, offset.

    ``derive`` has columns over ``ids`` (say, a checksum) that are computed before
    pieces meet their slots; without it the ids themselves are returned.
    """
    pieces = tokenized(docs, tokenizer, id_column, text_column, capacity, separator)
    if derive is not None:
        pieces = pieces.withColumns(derive).drop("ids")
    return place(pieces, capacity)
