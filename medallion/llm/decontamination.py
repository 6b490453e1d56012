"""Benchmark passages in training documents, found by winnowed fingerprints.

Of every window of ``window`` words the least hash of its ``gram``-word grams is a
fingerprint, so a passage that a document and an item share has a fingerprint in
common if it is at least one window long. Fingerprints carry the word hashes around
them; after the join these are compared outwards from the fingerprint, which
extends it to the whole shared passage. An item that is shorter than a window is
one window, whose only gram is the whole item.

Most document fingerprints occur in no item. A bitmap of fixed size, with a bit
set for every item fingerprint, drops those before the join; it has no false
negatives, and with very many items it merely drops less.

Defined results: null and empty texts have no words and no hits; an item without words
matches nothing; an item without id counts for ``n_hit`` but is not listed; repeated
document rows are returned as often as they occur, repeated items count once; empty
tables give no rows or no hits. Only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Words, lists, ship, signed, slices, window_anchors, word_sums, written

#: bytes between words, once A-Z are lower-cased: all of ASCII but letters and digits
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

BITMAP_BITS = 23


def _context(words: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, left: int, right: int, hole: int):
    """Word hashes from ``left`` before to ``right`` after each place; ``hole`` beyond the document."""
    places = at[:, None] + np.arange(-left, right)
    inside = (places >= low[:, None]) & (places < high[:, None])
    found = words[np.clip(places, 0, max(0, len(words) - 1))]
    found[~inside] = hole
    return found


def _fingerprints(words: Words, hashes: np.ndarray, size: int, gram: int):
    """(places of fingerprints, their hashes) for windows of ``size`` words."""
    grams = word_sums(hashes).grams(gram)
    width = size - gram + 1
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = words.first[1:][words.documents()]
    whole = np.arange(n) + size <= ends[:n]
    places = np.unique(window_anchors(grams, width)[whole])
    return places, grams[places]


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _item_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            words = Words(data, offsets, GAP, fold_case=True)
            hashes = words.hashes()
            counts = np.diff(words.first)
            for size in np.unique(np.minimum(counts, window)):
                if not size:
                    continue
                some = np.flatnonzero(np.minimum(counts, window) == size)
                places, found = _fingerprints(words, hashes, int(size), gram if size == window else int(size))
                document = words.documents()[places]
                keep = np.isin(document, some)
                places, found, document = places[keep], found[keep], document[keep]
                k = gram if size == window else int(size)
                context = _context(
                    hashes, places, words.first[document], words.first[document + 1], int(size) - k, int(size), 1
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), size), pa.int32()),
                        signed(found),
                        rows.column("_item").take(pa.array(document)),
                        pa.array([c.tobytes() for c in context], pa.binary()),
                    ],
                    names=["_size", "_hash", "_item", "_item_context"],
                )

    return run


_FOUND = pa.struct([("size", pa.int32()), ("hash", pa.int64()), ("place", pa.int32()), ("context", pa.binary())])


def _document_rows(window: int, gram: int, sizes: list[int], bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(bitmap.value).view(bool)
        for rows, data, offsets in slices(batches, "_text"):
            words = Words(data, offsets, GAP, fold_case=True)
            hashes = words.hashes()
            parts = []
            for size in sizes:
                k = gram if size == window else size
                places, found = _fingerprints(words, hashes, size, k)
                keep = wanted[_bits(found)]
                places, found = places[keep], found[keep]
                document = words.documents()[places]
                low = words.first[document]
                context = _context(hashes, places, low, words.first[document + 1], size - k, size, 0)
                parts.append((document, np.full(len(places), size), found, places - low, [c.tobytes() for c in context]))
            document = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            order = np.argsort(document, kind="stable")
            contexts = [c for p in parts for c in p[4]]
            merged = (lambda i: np.concatenate([p[i] for p in parts])[order]) if parts else None
            found = (
                pa.StructArray.from_arrays(
                    [
                        pa.array(merged(1), pa.int32()), signed(merged(2)), pa.array(merged(3), pa.int32()),
                        pa.array([contexts[i] for i in order.tolist()], pa.binary()),
                    ],
                    fields=list(_FOUND),
                )
                if parts
                else pa.array([], _FOUND)
            )
            each = np.bincount(document, minlength=len(offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_id"), rows.column("_key"),
                    pa.array(np.diff(words.first), pa.int64()),
                    lists(found, np.r_[0, np.cumsum(each)]),
                ],
                names=["_id", "_key", "n_words", "_found"],
            )

    return run


def _extended(window: int, gram: int):
    """Joined fingerprints become the spans of words that they prove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes = rows.column("_size").to_numpy()
            for size in np.unique(sizes).tolist():
                some = pa.array(np.flatnonzero(sizes == size))
                part = rows.take(some)
                left = size - (gram if size == window else size)
                words, others = (
                    np.frombuffer(b"".join(part.column(n).to_pylist()), np.uint64).reshape(-1, left + size)
                    for n in ("_context", "_item_context")
                )
                same = words == others
                before = np.cumprod(same[:, :left][:, ::-1], axis=1).sum(axis=1).astype(np.int64)
                after = np.cumprod(same[:, left:], axis=1).sum(axis=1).astype(np.int64)
                keep = before + after >= size
                places = part.column("_place").to_numpy()
                kept = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("_id"), kept.column("_key"), kept.column("_item"),
                        pa.array((places - before)[keep], pa.int64()),
                        pa.array((places + after)[keep], pa.int64()),
                    ],
                    names=["_id", "_key", "_item", "_from", "_to"],
                )

    return run


def _found(docs, items, id_column, text_column, item_column, item_text_column, window, gram):
    """(light rows of all documents, ordered spans and items of those with hits)."""
    spark = docs.sparkSession
    ship(spark)
    item_kind, id_kind = items.schema[item_column].dataType, docs.schema[id_column].dataType
    item_schema = T.StructType(
        [
            T.StructField("_size", T.IntegerType()), T.StructField("_hash", T.LongType()),
            T.StructField("_item", item_kind), T.StructField("_item_context", T.BinaryType()),
        ]
    )
    prints = written(
        items.select(F.col(item_column).alias("_item"), F.col(item_text_column).alias("_text"))
        .mapInArrow(_item_rows(window, gram), item_schema)
        .distinct(),
        "item-fingerprints",
    )
    sizes = sorted(r["_size"] for r in prints.select("_size").distinct().collect())
    taken = (
        prints.select(F.shiftrightunsigned("_hash", 64 - BITMAP_BITS).alias("slot"))
        .groupBy(F.expr("shiftright(slot, 3) AS byte"))
        .agg(F.expr("bit_or(shiftright(128, cast(slot % 8 AS int))) AS bits"))
        .collect()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in taken:
        bitmap[r["byte"]] = r["bits"]

    light_schema = T.StructType(
        [
            T.StructField("_id", id_kind), T.StructField("_key", T.LongType()), T.StructField("n_words", T.LongType()),
            T.StructField(
                "_found", T.ArrayType(T.StructType.fromDDL("size int, hash bigint, place int, context binary"))
            ),
        ]
    )
    wanted = spark.sparkContext.broadcast(bitmap)
    light = written(
        docs.select(
            F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_key"), F.col(text_column).alias("_text")
        ).mapInArrow(
            _document_rows(window, gram, sizes, wanted), light_schema
        ),
        "document-fingerprints",
    )
    wanted.destroy()
    found = light.select("_id", "_key", F.explode("_found").alias("f")).select(
        "_id", "_key", F.col("f.size").alias("_size"), F.col("f.hash").alias("_hash"),
        F.col("f.place").alias("_place"), F.col("f.context").alias("_context"),
    )
    hit_schema = T.StructType(
        [
            T.StructField("_id", id_kind), T.StructField("_key", T.LongType()), T.StructField("_item", item_kind),
            T.StructField("_from", T.LongType()), T.StructField("_to", T.LongType()),
        ]
    )
    hits = (
        found.join(prints, ["_size", "_hash"])
        .select("_id", "_key", "_size", "_place", "_context", "_item", "_item_context")
        .mapInArrow(_extended(window, gram), hit_schema)
    )
    ordered = F.sort_array(F.collect_set(F.struct("_from", "_to")))
    spans = F.expr(
        """aggregate(_ordered, cast(array() as array<struct<from: bigint, to: bigint>>), (found, x) ->
             if(size(found) > 0 and element_at(found, -1).to >= x._from,
                concat(slice(found, 1, size(found) - 1),
                       array(named_struct('from', element_at(found, -1).from,
                                          'to', greatest(element_at(found, -1).to, x._to)))),
                concat(found, array(named_struct('from', x._from, 'to', x._to)))))"""
    )
    by_document = (
        hits.groupBy("_id", "_key")
        .agg(ordered.alias("_ordered"), F.sort_array(F.collect_set("_item")).alias("items"))
        .select(F.col("_id").alias("_hit_id"), F.col("_key").alias("_hit_key"), spans.alias("spans"), "items")
    )
    return light, by_document


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """Per document row: id, ``n_words``, ``spans`` of words that lie in item windows, ``items``.

    ``spans`` are maximal disjoint (from, to) word ranges in ascending order.
    """
    light, hits = _found(docs, items, id_column, text_column, item_column, item_text_column, window, gram)
    none = F.expr("cast(array() as array<struct<from: bigint, to: bigint>>)")
    same = F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_key") == F.col("_hit_key"))
    return light.join(hits, same, "left").select(
        F.col("_id").alias(id_column), "n_words",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast(T.ArrayType(items.schema[item_column].dataType))).alias("items"),
    )


def uncontaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """The documents without a word in an item window, all columns."""
    _, hits = _found(docs, items, id_column, text_column, item_column, item_text_column, window, gram)
    hits = hits.select("_hit_id", "_hit_key")
    same = docs[id_column].eqNullSafe(hits["_hit_id"]) & (F.xxhash64(docs[text_column]) == hits["_hit_key"])
    return docs.join(hits, same, "left_anti")
