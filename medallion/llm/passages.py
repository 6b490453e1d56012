"""Repeated passages: where windows of a fixed size occur more than once in a corpus.

Shared by the operators on repeated substrings. Every window of ``window`` units
(words or bytes) has an anchor, the least hash of its ``gram``-unit grams, at the same
offset in all its copies. Consecutive windows with the same anchor form a segment, so
windows can only be equal if their segments have equal anchor grams. That makes the
search distributed: segments are light rows, grams that occur once drop out, copies
with equal content count as one, and only the distinct passages of repeated grams
are cut out of their texts and dealt out by gram to be compared.

A gram with more than ``LARGE`` distinct passages (a common line in ever new
surroundings) is not compared in one place: its windows are counted one by one by
an aggregation, which combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import (
    _BYTE_VALUES, Words, binary, content_sums, covered, lists, mix, ranges, ship, signed, slices,
    window_anchors, word_sums, written,
)

#: distinct passages of a gram that are compared in one place
LARGE = 8_000


class Units:
    """The units of a slice: hashes, each document's range, and byte ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        self.data, self.kind = data, kind
        if kind == "bytes":
            self.hashes, self.first, self.words = _BYTE_VALUES[data], offsets, None
        else:
            self.words = Words(data, offsets)
            self.hashes, self.first = self.words.hashes(), self.words.first

    def span(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of ranges of units that are not empty."""
        if self.words is None:
            return starts, ends
        return self.words.starts[starts], self.words.ends[ends - 1]


def _leading(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The seven bytes from each place as a number that sorts like them."""
    found = np.zeros(len(places), np.int64)
    for i in range(7):
        at = places + i
        found = found << 8 | np.where(at < len(data), data[np.minimum(at, len(data) - 1)], 0)
    return found


def _segments(window: int, gram: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            units = Units(data, offsets, kind)
            n = len(units.hashes) - window + 1
            if n <= 0:
                continue
            grams = word_sums(units.hashes).grams(gram)
            anchor = window_anchors(grams, window - gram + 1)[:n]
            document = np.repeat(np.arange(len(offsets) - 1), np.diff(units.first))
            whole = np.arange(n) + window <= units.first[1:][document[:n]]
            change = np.r_[True, (anchor[1:] != anchor[:-1]) | ~whole[:-1]]
            start = np.flatnonzero(whole & change)
            end = np.flatnonzero(whole & np.r_[change[1:] | ~whole[1:], True]) + 1
            place = anchor[start]
            content = content_sums(units.hashes).hashes(start, end + window - 1)
            content = mix(content + (place - start).astype(np.uint64))
            own = document[start]
            lead = _leading(data, units.span(place, place + 1)[0])
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_id").take(take), rows.column("_key").take(take),
                    signed(grams[place]), signed(content), pa.array(lead),
                    pa.array(start - units.first[own], pa.int32()),
                    pa.array(end - start, pa.int32()),
                    pa.array(place - start, pa.int32()),
                ],
                names=["_id", "_key", "_gram", "_content", "_lead", "_start", "_windows", "_anchor"],
            )

    return run


def _cut(window: int, kind: str):
    """Documents with a list of segments become rows of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            units = Units(data, offsets, kind)
            wanted = rows.column("_wanted")
            each = wanted.value_lengths().to_numpy(zero_copy_only=False)
            found = wanted.flatten()
            column = {f.name: found.field(i) for i, f in enumerate(found.type)}
            starts = units.first[np.repeat(np.arange(len(each)), each)] + column["_start"].to_numpy()
            low, high = units.span(starts, starts + column["_windows"].to_numpy() + window - 1)
            text = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *[column[c] for c in ("_gram", "_content", "_windows", "_anchor", "_copies", "_least", "_bucket")],
                    pa.array([text[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary()),
                ],
                names=["_gram", "_content", "_windows", "_anchor", "_copies", "_least", "_bucket", "_passage"],
            )

    return run


def _large_windows(window: int, kind: str):
    """Passages become a row per window, with the hash of its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_passage"):
            units = Units(data, offsets, kind)
            number = rows.column("_windows").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(number)), number)
            place = ranges(np.zeros(len(number), np.int64), number)
            start = units.first[row] + place
            found = content_sums(units.hashes).hashes(start, start + window)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c).take(take) for c in ("_gram", "_content", "_copies", "_least")],
                    pa.array(place, pa.int32()), signed(found),
                ],
                names=["_gram", "_content", "_copies", "_least", "_place", "_hash"],
            )

    return run


def runs_of(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal runs of equal values of an owner, in a sorted sequence."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])])
    return new, np.r_[new[1:], len(values)]


#: what a comparison returns per passage: runs of windows with the copies and the least id of their content
FOUND = "_gram bigint, _content bigint, _runs array<struct<first: int, end: int, copies: bigint, least: bigint>>"
_RUN = pa.struct(
    [("first", pa.int32()), ("end", pa.int32()), ("copies", pa.int64()), ("least", pa.int64())]
)


def found_rows(
    gram: pa.Array, content: pa.Array, owner: np.ndarray, place: np.ndarray, copies: np.ndarray, least: np.ndarray
) -> pa.RecordBatch:
    """Rows of FOUND from windows (owner: index of the passage, sorted with place)."""
    first, end = runs_of(mix(copies.astype(np.uint64)) + least.astype(np.uint64), owner)
    each = np.bincount(owner[first], minlength=len(gram)) if len(first) else np.zeros(len(gram), np.int64)
    runs = pa.StructArray.from_arrays(
        [
            pa.array(place[first], pa.int32()), pa.array(place[end - 1] + 1, pa.int32()),
            pa.array(copies[first], pa.int64()), pa.array(least[first], pa.int64()),
        ],
        fields=list(_RUN),
    )
    return pa.RecordBatch.from_arrays(
        [gram, content, lists(runs, np.r_[0, np.cumsum(each)])], names=["_gram", "_content", "_runs"]
    )


def repeated_windows(
    docs: DataFrame,
    kind: str,
    window: int,
    gram: int,
    compare: Callable,
    repeated: Column,
    deal: Callable[[DataFrame, int], DataFrame],
    chosen: Callable[[DataFrame], Column],
    bucket_bytes: int,
    only: Column | None = None,
    large: int = LARGE,
) -> DataFrame:
    """Per document row with repeated windows: ``_id``, ``_key`` and ``_ranges`` of units to be removed.

    docs: ``_id`` (long, not null), ``_key`` (a hash that tells texts of one id apart) and ``_text``.
    compare: applied to Arrow tables of passages, returns rows of FOUND.
    repeated: of a gram, over ``copies``, ``least`` and ``most`` (the least and the largest id).
    deal: adds ``_bucket`` to candidates, about as many as asked for; a gram must stay in one.
    bucket_bytes: about as many bytes of passages are compared together.
    chosen: whether a run of windows is to be removed, given segments joined with runs.
    only: which documents take part. Texts are joined twice, with what is asked for and in the
    end with what is removed; both need the same shuffle of texts, so Spark runs it once.
    """
    ship(docs.sparkSession)
    schema = (
        "_id bigint, _key bigint, _gram bigint, _content bigint, _lead bigint, _start int, _windows int, _anchor int"
    )
    some = docs if only is None else docs.filter(only)
    segments = written(some.mapInArrow(_segments(window, gram, kind), schema), "segments")
    contents = segments.groupBy("_gram", "_content").agg(
        F.count(F.lit(1)).alias("_copies"),
        F.min(F.struct("_id", "_key", "_start", "_windows", "_anchor", "_lead")).alias("_at"),
        F.max("_id").alias("_most"),
    )
    grams = (
        contents.groupBy("_gram")
        .agg(
            F.sum("_copies").alias("copies"), F.min("_at._id").alias("least"), F.max("_most").alias("most"),
            F.count(F.lit(1)).alias("_contents"),
        )
        .filter(repeated)
        .select("_gram", "_contents")
    )
    candidates = written(
        contents.join(grams, "_gram").select(
            "_gram", "_content", "_copies", "_at.*", F.col("_at._id").alias("_least"),
            (F.col("_contents") > large).alias("_large"),
        ),
        "candidates",
        release=True,
    )
    size = candidates.agg(F.sum(F.col("_windows") + window - 1).alias("n")).collect()[0]["n"] or 0
    size = size * (1 if kind == "bytes" else 7)
    wanted = (
        deal(candidates, max(1, -(-size // bucket_bytes)))
        .withColumn("_bucket", F.when(F.col("_large"), F.lit(-1)).otherwise(F.col("_bucket")).cast("int"))
        .groupBy("_id", "_key")
        .agg(
            F.collect_list(
                F.struct("_gram", "_content", "_start", "_windows", "_anchor", "_copies", "_least", "_bucket")
            ).alias("_wanted")
        )
    )
    passages = (
        docs.join(wanted, ["_id", "_key"])
        .select("_text", "_wanted")
        .mapInArrow(
            _cut(window, kind),
            "_gram bigint, _content bigint, _windows int, _anchor int, _copies bigint, _least bigint, "
            "_bucket int, _passage binary",
        )
    )
    found = passages.filter("_bucket >= 0").groupBy("_bucket").applyInArrow(compare, FOUND)
    if candidates.filter("_large").limit(1).count():
        windows = passages.filter("_bucket < 0").dropDuplicates(["_gram", "_content"]).mapInArrow(
            _large_windows(window, kind),
            "_gram bigint, _content bigint, _copies bigint, _least bigint, _place int, _hash bigint",
        )
        counted = windows.groupBy("_gram", "_hash").agg(
            F.sum("_copies").alias("copies"), F.min("_least").alias("least")
        )
        one = F.struct(
            F.col("_place").alias("first"), (F.col("_place") + 1).cast("int").alias("end"), "copies", "least"
        )
        found = found.unionByName(
            windows.join(counted, ["_gram", "_hash"])
            .groupBy("_gram", "_content")
            .agg(F.collect_list(one).alias("_runs"))
        )
    joined = segments.join(found, ["_gram", "_content"]).select(
        "_id", "_key", "_start", F.explode("_runs").alias("run")
    )
    start = F.col("_start") + F.col("run.first")
    length = F.col("run.end") - F.col("run.first") + (window - 1)
    return (
        joined.filter(chosen(joined))
        .groupBy("_id", "_key")
        .agg(F.collect_list(F.struct(start.alias("start"), length.alias("length"))).alias("_ranges"))
    )


def _without(kind: str, id_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            units = Units(data, offsets, kind)
            found = rows.column("_ranges")
            each = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = found.flatten()
            owner = np.repeat(np.arange(len(each)), each)
            gone = covered(
                units.first[owner] + flat.field(0).to_numpy(), flat.field(1).to_numpy(), len(units.hashes)
            )
            document = np.repeat(np.arange(len(offsets) - 1), np.diff(units.first))
            first, end = runs_of(gone.astype(np.int64), document)
            first, end = first[gone[first]], end[gone[first]]
            of = document[first]
            spans = pa.StructArray.from_arrays(
                [pa.array(first - units.first[of]), pa.array(end - units.first[of])], names=["from", "to"]
            )
            number = np.bincount(of, minlength=len(offsets) - 1)
            if kind == "bytes":
                kept = data[~gone]
                before = np.r_[0, np.cumsum(~gone)]
                text = binary(kept, before[offsets])
            else:
                # kept words, each followed by a space but the last one of a document
                low, high = units.words.starts[~gone], units.words.ends[~gone]
                own = document[~gone]
                size = high - low
                last = np.r_[own[1:] != own[:-1], True] if len(own) else np.zeros(0, bool)
                wide = size + ~last
                flat_bytes = np.full(int(wide.sum()), 0x20, np.uint8)
                target = np.cumsum(wide) - wide
                flat_bytes[ranges(target, size)] = data[ranges(low, size)]
                total = np.bincount(own, wide, len(offsets) - 1).astype(np.int64)
                text = binary(flat_bytes, np.r_[0, np.cumsum(total)])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(id_column),
                    pa.array(np.diff(units.first).astype(np.int64)),
                    lists(spans, np.r_[0, np.cumsum(number)]),
                    text,
                ],
                names=[id_column, "n_units", "spans", "kept"],
            )

    return run


def without_ranges(docs: DataFrame, found: DataFrame, kind: str, id_column: str) -> DataFrame:
    """All documents: id, ``n_units``, removed ``spans`` of units, and ``kept`` (UTF-8 bytes).

    Kept words are joined by single spaces; kept bytes are concatenated.
    """
    renamed = found.select(F.col("_id").alias("_fid"), F.col("_key").alias("_fkey"), "_ranges")
    rows = docs.join(
        renamed, (F.col("_id") == F.col("_fid")) & (F.col("_key") == F.col("_fkey")), "left"
    ).select(F.col("_id").alias(id_column), "_text", "_ranges")
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema["_id"].dataType),
            T.StructField("n_units", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType.fromDDL("`from` bigint, `to` bigint"))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(_without(kind, id_column), schema)
