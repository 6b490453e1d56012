"""Phrase collocations from a weighted de Bruijn graph of word n-grams.

Nodes are grams of ``order - 1`` words, an edge is a gram of ``order`` words and joins
the two nodes that overlap in it; its weight is how often it occurs. Only edges are
counted from texts. A shorter gram needs no counting: it occurs as often as the edges
that leave its node together, plus as often as it ends a piece, where no edge leaves.
So every word of a text gives one row: the edge that starts there, or the shorter gram
up to the end of its piece. Counts of grams of k words are the sums of those of k + 1
words by their first k words, plus the piece ends of k words.

Edges that can be phrases (``least`` occurrences or more) are compacted: where a node
has one such edge in and one out, of equal weight, the two are one path. Paths are
found by pointer doubling in a number of rounds that is the logarithm of the longest
one, and are kept as texts with a weight; edges and the flow of inner nodes are read
off them. A cycle without an entry is left as single edges.

Most pairs of words are rare, and no phrase has a rare pair in it. A first pass counts
pairs of neighbours in hash buckets; pieces are cut between words whose bucket has
fewer than ``least`` pairs. A cut is a piece end like any other, so counts of ``least``
and more stay exact whatever the buckets are; a smaller count may come out smaller.
Buckets are as many as the input has bytes / 32, from 2^20 to 2^28 (a broadcast bitmap
of 32 MB): from some 50 GB on more and more rare pairs pass, and cost their shuffle.

Defined results: a null text has no pieces; a null language is ``und``; repeated rows
count each time; an empty table gives no rows. Texts are read whole. Only the text and
language columns are read, so other columns may have any names. Ties are ordered by
count, then by the bytes of the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import Words, as_text, byte_sums, mix, ranges, raw, ship, slices, trim, word_sums, written

#: bytes of text that are handled at once: the larger, the more equal grams meet before the shuffle
SLICE_BYTES = 1 << 21
#: pairs that a task sorts at once
FLUSH_PAIRS = 1 << 21
#: buckets of a row of the shuffle of pairs
CHUNK_BITS = 16
LEAST_BITS, MOST_BITS = 20, 28
#: edges of a row of the table of paths
PATH_EDGES = 1024

#: bytes that end a piece: . , ; : ! ? and \n \v \f \r
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\n\v\f\r")] = True
_GAPS = _ENDS.copy()
_GAPS[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- words, pieces and pairs ---------------------------------------------------------


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, document of each word, is the next word in the same piece)."""
    words = Words(data, offsets, _GAPS)
    document = words.documents()
    before = np.cumsum(_ENDS[data])[words.starts] if len(words) else np.zeros(0, np.int64)
    near = np.zeros(len(words), bool)
    near[:-1] = (before[1:] == before[:-1]) & (document[1:] == document[:-1])
    return words, document, near


def _buckets(words: Words, document: np.ndarray, near: np.ndarray, langs: pa.Array, bits: int) -> np.ndarray:
    """The bucket of the pair that each word with a neighbour begins."""
    places = np.flatnonzero(near)
    text, ends = raw(as_text(langs))
    own = byte_sums(text).hashes(ends[:-1], ends[1:])
    pairs = word_sums(words.hashes()).grams(2)[places] if len(places) else np.zeros(0, np.uint64)
    return (mix(pairs ^ own[document[places]]) >> np.uint64(64 - bits)).astype(np.uint32)


def _slices(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in slices(batches, "text", SLICE_BYTES):
        yield rows, _LOWER[data], offsets


def _pair_rows(bits: int, least: int):
    """Sorted places of pairs within chunks of buckets; no more than ``least`` equal ones at once."""

    def flushed(parts: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(parts))
        first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        rank = np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)]))
        found = found[rank < least]
        chunks, start = np.unique(found >> CHUNK_BITS, return_index=True)
        low = (found & ((1 << CHUNK_BITS) - 1)).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunks.astype(np.int32)),
                pa.array([low[a:b].tobytes() for a, b in zip(start, np.r_[start[1:], len(low)])], pa.binary()),
            ],
            names=["chunk", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for rows, data, offsets in _slices(batches):
            words, document, near = _pieces(data, offsets)
            parts.append(_buckets(words, document, near, rows.column("lang"), bits))
            size += len(parts[-1])
            if size >= FLUSH_PAIRS:
                yield flushed(parts)
                parts, size = [], 0
        if size:
            yield flushed(parts)

    return run


def _frequent_chunks(least: int):
    """Per chunk one bit for each bucket: are there ``least`` pairs or more?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places in zip(batch.column("chunk").to_pylist(), batch.column("places")):
                found = np.bincount(np.frombuffer(places.as_buffer(), "<u2"), minlength=1 << CHUNK_BITS)
                counts[chunk] = np.minimum(counts.get(chunk, 0) + found, least).astype(np.uint32)
        bits = [np.packbits(c >= least).tobytes() for c in counts.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(bits, pa.binary())], names=["chunk", "bits"]
        )
        trim()

    return run


def _frequent_pairs(texts: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """(bitmap of the buckets with frequent pairs, bits of a bucket's number)."""
    size = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bits = min(max((size // 32).bit_length(), LEAST_BITS), MOST_BITS)
    chunks = texts.mapInArrow(_pair_rows(bits, least), "chunk int, places binary").repartition("chunk")
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    step = 1 << (CHUNK_BITS - 3)
    for row in chunks.mapInArrow(_frequent_chunks(least), "chunk int, bits binary").collect():
        bitmap[row.chunk * step : (row.chunk + 1) * step] = np.frombuffer(row.bits, np.uint8)
    return bitmap, bits


# -- edges and piece ends ------------------------------------------------------------


def _gram_rows(order: int, bits: int, bitmap):
    """Per slice and language how often each edge and each shorter gram at a piece end occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _slices(batches):
            words, document, near = _pieces(data, offsets)
            if not len(words):
                continue
            bucket = _buckets(words, document, near, rows.column("lang"), bits)
            near[near] = (bitmap.value[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1
            # words from each one to the end of its piece
            last = np.flatnonzero(~near)
            place = np.arange(len(words))
            size = np.minimum(last[np.searchsorted(last, place)] - place + 1, order)
            # the words one after the other, with one space behind each
            lengths = words.ends - words.starts + 1
            starts = np.r_[0, np.cumsum(lengths)]
            text = np.full(starts[-1], 0x20, np.uint8)
            text[ranges(starts[:-1], lengths - 1)] = data[ranges(words.starts, lengths - 1)]
            ends = starts[place + size] - 1
            grams = pa.LargeStringArray.from_buffers(
                len(words), pa.py_buffer(np.r_[0, np.cumsum(ends - starts[:-1])]),
                pa.py_buffer(text[ranges(starts[:-1], ends - starts[:-1])]),
            )
            langs = rows.column("lang").dictionary_encode()
            keys = pa.table(
                {"lang": langs.indices.take(pa.array(document)), "gram": grams, "size": pa.array(size.astype(np.int8))}
            )
            found = keys.group_by(["lang", "gram", "size"], use_threads=False).aggregate([([], "count_all")])
            found = found.combine_chunks()
            columns = {name: found.column(name) for name in ("lang", "size", "gram", "count_all")}
            for at in range(0, found.num_rows, 50_000):
                part = {n: c.slice(at, 50_000).combine_chunks() for n, c in columns.items()}
                part = {n: c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for n, c in part.items()}
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(part["lang"]).cast(pa.string()), part["size"].cast(pa.int32()),
                        part["gram"].cast(pa.string()), part["count_all"],
                    ],
                    names=["lang", "size", "gram", "n"],
                )

    return run


# -- paths -----------------------------------------------------------------------------


def _first(column: str, words: int) -> Column:
    return F.substring_index(column, " ", words)


def _last(column: str, words: int) -> Column:
    return F.substring_index(column, " ", -words)


def _links(edges: DataFrame, order: int) -> DataFrame:
    """(lang, gram, up): edges whose first node has one edge in, ``up``, and one out, of equal weight."""
    out = edges.groupBy("lang", _first("gram", order - 1).alias("node")).agg(
        F.count("*").alias("outs"), F.max("gram").alias("gram"), F.max("n").alias("n")
    )
    into = edges.groupBy("lang", _last("gram", order - 1).alias("node")).agg(
        F.count("*").alias("ins"), F.max("gram").alias("up"), F.max("n").alias("m")
    )
    joined = out.filter("outs = 1").join(into.filter("ins = 1"), ["lang", "node"])
    return joined.filter("n = m AND gram <> up").select("lang", "gram", "up")


def _ranked(edges: DataFrame, links: DataFrame) -> DataFrame:
    """(lang, gram, n, up, dist): the first edge of each edge's path and the steps from there."""
    rows = edges.join(links, ["lang", "gram"], "left").select(
        "lang", "gram", "n", F.coalesce("up", "gram").alias("up"),
        F.when(F.col("up").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("dist"),
        F.col("up").isNull().alias("done"),
    )
    rows = written(rows, "phrases-edges")
    open_rows = rows.filter(~F.col("done")).count()
    while open_rows:
        # edges that are still open point to different ones, so no key of this join is frequent
        other = rows.select("lang", F.col("gram").alias("up"), F.col("up").alias("_up"), F.col("dist").alias("_dist"), F.col("done").alias("_done"))
        moved = rows.filter(~F.col("done")).join(other, ["lang", "up"]).select(
            "lang", "gram", "n", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_done").alias("done")
        )
        rows = written(rows.filter("done").unionByName(moved), "phrases-edges")
        before, open_rows = open_rows, rows.filter(~F.col("done")).count()
        if open_rows == before:  # only cycles are left
            break
    single = ~F.col("done")
    return rows.select(
        "lang", "gram", "n", F.when(single, F.col("gram")).otherwise(F.col("up")).alias("up"),
        F.when(single, F.lit(0).cast("long")).otherwise(F.col("dist")).alias("dist"),
    )


def _paths(edges: DataFrame, order: int) -> DataFrame:
    """(lang, path, n): edges as paths without branches, PATH_EDGES edges at most in a row."""
    ranked = _ranked(edges, _links(edges, order))
    step = F.struct("dist", "gram", _last("gram", 1).alias("word"))
    rows = ranked.groupBy("lang", "up", "n", F.expr(f"dist div {PATH_EDGES}").alias("part")).agg(
        F.array_sort(F.collect_list(step)).alias("steps")
    )
    more = F.transform(F.slice("steps", 2, PATH_EDGES), lambda s: s["word"])
    path = F.concat_ws(" ", F.col("steps")[0]["gram"], more)
    return rows.select("lang", path.alias("path"), "n")


def _grams_of_paths(paths: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) of the edges of paths."""
    words = paths.select("lang", F.split("path", " ").alias("words"), "n")
    at = F.explode(F.expr(f"sequence(1, size(words) - {order - 1})"))
    return words.select("lang", "words", "n", at.alias("at")).select(
        "lang", F.concat_ws(" ", F.slice("words", F.col("at"), order)).alias("gram"), "n"
    )


# -- collocations ------------------------------------------------------------------------


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _scored(phrases: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """The lowest-scoring cut of each phrase: lang, phrase, size, a, l, r, score."""
    cuts = F.array(*[
        F.when(
            F.col("size") > k,
            F.array(
                F.struct(F.lit(2 * k).alias("at"), _first("phrase", k).alias("part")),
                F.struct(F.lit(2 * k + 1).alias("at"), F.expr(f"substring_index(phrase, ' ', {k} - size)").alias("part")),
            ),
        )
        for k in range(1, order)
    ])
    parts = phrases.withColumn("cut", F.explode(F.flatten(F.filter(cuts, lambda c: c.isNotNull()))))
    parts = parts.select("lang", "phrase", "size", "a", F.col("cut.at").alias("at"), F.col("cut.part").alias("part"))
    found = parts.join(counts.select("lang", F.col("gram").alias("part"), "n"), ["lang", "part"])
    sides = [F.max(F.when(F.col("at") == i, F.col("n"))).alias(f"_{i}") for i in range(2, 2 * order)]
    found = found.groupBy("lang", "phrase", "size", "a").agg(*sides)
    options = []
    for k in range(1, order):
        score = F.expr(
            f"cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) "
            f"div (cast(_{2 * k} as decimal(20,0)) + cast(_{2 * k + 1} as decimal(20,0)))"
        )
        option = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"_{2 * k}").alias("l"), F.col(f"_{2 * k + 1}").alias("r"))
        options.append(F.when(F.col("size") > k, option))
    best = found.select("lang", "phrase", "size", "a", F.array_min(F.array(*options)).alias("best"))
    return best.select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def _within_longer(phrases: DataFrame, order: int) -> DataFrame:
    """(lang, phrase, longest): the most frequent longer phrase around each phrase."""
    def inner(size: int) -> Column:
        at = F.expr(f"sequence(1, size - {size - 1})")
        parts = F.transform(at, lambda i: F.concat_ws(" ", F.slice(F.split("phrase", " "), i, size)))
        return F.when(F.col("size") > size, parts).otherwise(F.array().cast("array<string>"))

    around = F.explode(F.flatten(F.array(*[inner(size) for size in range(2, order)])))
    longer = phrases.filter("size > 2").select("lang", around.alias("phrase"), "a")
    return longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))


@dataclass
class PhraseGraph:
    """Counts of the grams of a corpus; those of ``least`` and more are exact and complete."""

    order: int
    least: int
    #: (lang, path, n): the compacted edges
    paths: DataFrame
    #: (lang, gram, size, n) of all grams of 1 to ``order`` words that occur ``least`` times or more
    counts: DataFrame
    #: (lang, n): occurrences of words
    words: DataFrame

    def collocations(self, top: int = 2000, kept_percent: int = 80) -> DataFrame:
        """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

        A phrase's score is that of its worst cut in two: 2,000,000 * a / (l + r), rounded
        down. Phrases within a longer one that occurs ``kept_percent`` as often are left out.
        """
        phrases = self.counts.filter("size > 1").select("lang", F.col("gram").alias("phrase"), "size", F.col("n").alias("a"))
        scored = _scored(phrases, self.counts, self.order)
        found = scored.join(_within_longer(phrases, self.order), ["lang", "phrase"], "left")
        inside = F.col("longest").isNotNull() & (100 * _whole("longest") >= kept_percent * _whole("a"))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = found.filter(~inside).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        return ranked.join(self.words, "lang").select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
        )


def phrase_graph(
    docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", order: int = 4, least: int = 30
) -> PhraseGraph:
    """Count the edges of a corpus and derive the counts of all shorter grams."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.col(f"`{text_column}`").alias("text"), F.coalesce(F.col(f"`{lang_column}`"), F.lit("und")).alias("lang")
    ).filter(F.col("text").isNotNull())
    bitmap, bits = _frequent_pairs(texts, least)
    shared = spark.sparkContext.broadcast(bitmap)
    rows = texts.mapInArrow(_gram_rows(order, bits, shared), "lang string, size int, gram string, n long")
    grams = written(rows.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "phrases-grams")
    shared.destroy()

    edges = grams.filter(F.col("size") == order).select("lang", "gram", "n")
    paths = written(_paths(edges.filter(F.col("n") >= least), order), "phrases-paths")
    frequent = _grams_of_paths(paths, order)
    flow = frequent.unionByName(edges.filter(F.col("n") < least))
    counts = frequent.withColumn("size", F.lit(order))
    for size in range(order - 1, 0, -1):
        through = flow.select("lang", _first("gram", size).alias("gram"), "n")
        ends = grams.filter(F.col("size") == size).select("lang", "gram", "n")
        flow = through.unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        if size > 1:
            flow = written(flow, "phrases-flow")
        counts = counts.unionByName(flow.filter(F.col("n") >= least).withColumn("size", F.lit(size)))
    counts = written(counts.select("lang", "gram", "size", "n"), "phrases-counts")
    # every occurrence of a word begins one edge or piece end
    words = written(grams.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-words")
    return PhraseGraph(order, least, paths, counts, words)
