"""Quality rules: counts over words, lines and symbols, and bands of n-gram perplexity.

The language model is an interpolated modified Kneser-Ney model over the bytes of
the texts, one per language. Spark counts the n-grams of the highest order over all
documents; each lower order counts the distinct n-grams that end in its own. Every
n-gram of the documents is in the tables of all orders, so joining them order by order
gives the probability of each n-gram of the highest one. That table is searched by
bisection, as sorted arrays of n-gram codes. A document is rejected if its perplexity lies outside the band of its
language, which is placed around the median of the language by the distances of the
median from the outer quartiles: LOW_REACH of them below, HIGH_REACH above.

Size: counts, shares and probabilities are complete tables of Spark and grow with the
documents. The last one is broadcast in shards of about ``shard_grams`` n-grams by the
hash of the code, one after the other; each is a pass over the documents, whose sums add
up. The driver and the workers hold one shard at a time, and results don't depend on
their number.

Defined results: a null text counts as empty; an empty text has no perplexity, and
only the count rules judge it; a null language is a language of its own; repeated rows
are judged each on their own; an empty table gives no rows. Columns other than id,
text and language are not read, whatever their names, unless they are to be carried.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .common import SPACE, Words, byte_sums, covered, mix, ship, slices, word_sums, written

ORDER = 5
#: n-grams that are broadcast at once (12 bytes each)
SHARD_GRAMS = 8_000_000
#: reach of the bands below and above the median. The rule: of the rows that labels.parquet of sf0.1
#: calls good and that pass the count rules (3,243), at most 0.25 % may fall out on a side; the least
#: multiple of 0.5 that holds it. Below it is 7 rows (0.22 %), above 4 (0.12 %).
LOW_REACH, HIGH_REACH = 6.0, 4.0
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


# -- n-gram codes ------------------------------------------------------------------


def _low(order: int) -> np.uint64:
    """The bits of the last ``order`` bytes; those of the language are above ORDER bytes."""
    return np.uint64((1 << 8 * order) - 1)


_LANGUAGE = np.uint64(0xFFFFFF << 8 * ORDER)


def codes(data: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """Per byte the code of it and the bytes before it: the byte itself is the lowest one.

    Bytes before the start of a document are 0; the number of the language is on top.
    """
    found = data.astype(np.uint64)
    starts, sizes = offsets[:-1], np.diff(offsets)
    for back in range(1, ORDER):
        if len(data) <= back:
            break
        shifted = np.zeros(len(data), np.uint64)
        shifted[back:] = data[:-back]
        for i in range(back):
            shifted[starts[sizes > i] + i] = 0
        found |= shifted << np.uint64(8 * back)
    return found | np.repeat(languages.astype(np.uint64) << np.uint64(8 * ORDER), sizes)


def _counted(values: np.ndarray, weights: np.ndarray | None = None):
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, weights = values[order], weights[order]
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    if weights is None:
        return values[new], np.diff(np.r_[new, len(values)])
    return values[new], np.add.reduceat(weights, new) if len(new) else weights


def _counts(text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for rows, data, offsets in slices(batches, text_column):
            languages = rows.column("_lang").to_numpy(zero_copy_only=False)
            parts.append(_counted(codes(data, offsets, languages)))
            held += len(parts[-1][0])
            if held > 1_500_000:
                parts = [_counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                held = len(parts[0][0])
                if held > 1_000_000:
                    yield _count_rows(*parts[0])
                    parts, held = [], 0
        if parts:
            yield _count_rows(
                *_counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            )

    return run


def _count_rows(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["code", "n"]
    )


# -- the model ---------------------------------------------------------------------


def _discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many n-grams were seen 1 to 4 times."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return tuple(float(x) for x in np.clip(found, 0.05, [0.95, 1.95, 2.95]))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in sorted keys, whether they hold the wanted ones)."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _context(codes_: np.ndarray) -> np.ndarray:
    return (codes_ & _LANGUAGE) | ((codes_ & _low(ORDER)) >> np.uint64(8))


class Model:
    """Sorted code arrays with interpolated probabilities, and back-off weights per context."""

    def __init__(self):
        self.keys, self.probability, self.contexts, self.backoff = [], [], [], []

    def add(self, keys: np.ndarray, share: np.ndarray, backoff: np.ndarray) -> None:
        """The next order: discounted shares of n-grams and the back-off weights of their contexts."""
        by = np.argsort(keys)
        keys, share, backoff = keys[by], share[by], backoff[by]
        lower = self.probabilities(keys, len(self.keys))
        contexts, first = np.unique(_context(keys), return_index=True)
        self.keys.append(keys)
        self.probability.append((share + backoff * lower).astype(np.float32))
        self.contexts.append(contexts)
        self.backoff.append(backoff[first].astype(np.float32))

    def probabilities(self, wanted: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of codes, given the bytes before: the longest known n-gram, times back-off weights."""
        language = wanted & _LANGUAGE
        found = np.full(len(wanted), 1 / 256)
        left = np.arange(len(wanted))
        weight = np.ones(len(wanted))
        for size in range(order, 0, -1):
            some = wanted[left]
            at, known = _find(self.keys[size - 1], language[left] | (some & _low(size)))
            found[left[known]] = self.probability[size - 1][at[known]]
            left, some = left[~known], some[~known]
            if not len(left):
                break
            context = language[left] | ((some & _low(size)) >> np.uint64(8))
            at, known = _find(self.contexts[size - 1], context)
            weight[left[known]] *= self.backoff[size - 1][at[known]]
        return found * weight


def language_numbers(docs: DataFrame, lang_column: str) -> dict:
    found = {r[0] for r in docs.select(lang_column).distinct().collect()}
    if len(found) > 0xFFFF:
        raise ValueError(f"{lang_column} has {len(found)} values; it does not look like a language")
    return {lang: i for i, lang in enumerate(sorted(found, key=lambda x: (x is not None, str(x))), 1)}


def _numbered(rows: DataFrame, numbers: dict) -> DataFrame:
    """Rows with the number of their ``_language`` as ``_lang`` in its place; there are 65,535 at most."""
    schema = T.StructType(
        [T.StructField("_known", rows.schema["_language"].dataType), T.StructField("_lang", T.LongType())]
    )
    listed = rows.sparkSession.createDataFrame(list(numbers.items()), schema)
    return rows.join(F.broadcast(listed), F.col("_language").eqNullSafe(F.col("_known"))).drop("_language", "_known")


def levels(docs: DataFrame, numbers: dict, text_column: str, lang_column: str) -> list[DataFrame]:
    """(code, n) of orders 1 to ORDER: the n-grams of all documents, counted by Spark."""
    ship(docs.sparkSession)
    rows = _numbered(
        docs.select(F.col(f"`{text_column}`").alias("_text"), F.col(f"`{lang_column}`").alias("_language")), numbers
    )
    parts = rows.mapInArrow(_counts("_text"), "code bigint, n bigint")
    grams = written(parts.groupBy("code").agg(F.sum("n").alias("n")), "grams", release=True)
    found = [grams]
    for order in range(ORDER - 1, 0, -1):
        shorter = found[0].select(F.col("code").bitwiseAND(F.lit(_LANGUAGE_BITS | int(_low(order)))).alias("code"))
        found.insert(0, written(shorter.groupBy("code").agg(F.count(F.lit(1)).alias("n")), f"grams-{order}"))
    return found


def train(
    docs: DataFrame, numbers: dict, text_column: str, lang_column: str, max_grams: int | None = None
) -> Model:
    """A model in the driver's memory, for any texts; ``measure`` doesn't need it.

    With ``max_grams`` the n-grams seen least are left to the lower orders, so that no order keeps more.
    """
    model = Model()
    for level in levels(docs, numbers, text_column, lang_column):
        found = _shares(level, max_grams).toArrow()
        columns = [found.column(c).to_numpy() for c in ("code", "share", "backoff")]
        model.add(columns[0].astype(np.int64).view(np.uint64), *columns[1:])
    return model


#: the bits of the language in a code, as Spark's long; numbers of languages leave the sign alone
_LANGUAGE_BITS = 0x7FFFFF << 8 * ORDER


def _shares(level: DataFrame, max_grams: int | None = None) -> DataFrame:
    """(code, share, backoff) of all n-grams; with ``max_grams`` the least seen ones are left out.

    share is the discounted part of its context's count, backoff what the context leaves
    to the lower orders, that of n-grams left out included. A context has at most 256
    n-grams, one per byte.
    """
    spark = level.sparkSession
    least = 1
    while max_grams and level.filter(F.col("n") >= least).count() > max_grams:
        least *= 2
    level = level.withColumn("_lang", F.shiftright("code", 8 * ORDER))
    seen: dict[int, list[float]] = {}
    for r in level.groupBy("_lang", F.least("n", F.lit(5)).alias("n")).agg(F.count(F.lit(1)).alias("k")).collect():
        seen.setdefault(r["_lang"], [0.0] * 5)[r["n"] - 1] = float(r["k"])
    cuts = spark.createDataFrame(
        [(lang, *_discounts(*ns[:4])) for lang, ns in seen.items()], "_lang bigint, d1 double, d2 double, d3 double"
    )
    low = F.col("code").bitwiseAND(F.lit(int(_low(ORDER))))
    context = F.col("code").bitwiseAND(F.lit(_LANGUAGE_BITS)).bitwiseOR(F.shiftright(low, 8))
    whole = Window.partitionBy("context")
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    share = (F.col("n") - cut) / F.col("total")
    return (
        level.join(cuts, "_lang")
        .withColumn("context", context)
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("share", share)
        .withColumn("kept", F.sum(F.when(F.col("n") >= least, F.col("share"))).over(whole))
        .filter(F.col("n") >= least)
        .select(
            "code", "share", F.least(F.greatest(1 - F.col("kept"), F.lit(1e-9)), F.lit(1.0)).alias("backoff")
        )
    )


def log_probabilities(counted: list[DataFrame]) -> DataFrame:
    """(code, log): all n-grams of the highest order of ``levels``, and the logarithms of their probabilities."""
    lower = None
    for order, level in enumerate(counted, 1):
        found = _shares(level)
        if lower is None:
            found = found.withColumn("lower", F.lit(1 / 256))
        else:
            shorter = F.col("code").bitwiseAND(F.lit(_LANGUAGE_BITS | int(_low(order - 1))))
            found = found.withColumn("shorter", shorter).join(lower, "shorter")
        p = F.col("share") + F.col("backoff") * F.col("lower")
        lower = found.select(F.col("code").alias("shorter"), p.alias("lower"))
    return lower.select(F.col("shorter").alias("code"), F.log("lower").cast("float").alias("log"))


def shards(grams: DataFrame, shard_grams: int) -> Iterator[DataFrame]:
    """The rows of ``log_probabilities``, dealt by hash into parts of about ``shard_grams``."""
    n = -(-grams.count() // shard_grams) or 1
    for i in range(n):
        yield grams.filter(F.pmod(F.xxhash64("code"), F.lit(n)) == i)


def _searched(shard: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted codes, logarithms)."""
    found = shard.toArrow()
    keys = found.column("code").to_numpy().astype(np.int64).view(np.uint64)
    by = np.argsort(keys)
    return keys[by], found.column("log").to_numpy().astype(np.float32)[by]


def _log_sums(shard, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """Per document of a slice the sum of the logarithms of those of its n-grams that the shard has."""
    of = codes(data, offsets, languages)
    order = np.argsort(of)
    ordered = of[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(of) else np.zeros(0, bool)
    keys, values = shard
    at, known = _find(keys, ordered[new])
    logs = np.zeros(len(at))
    logs[known] = values[at[known]]
    each = np.empty(len(of))
    each[order] = logs[np.cumsum(new) - 1]
    size = np.diff(offsets)
    return np.bincount(np.repeat(np.arange(len(size)), size), each, len(size))


# -- counts of a document ------------------------------------------------------------


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of the documents of a slice; see ``measure``."""
    words = Words(data, offsets)
    n = len(offsets) - 1
    gap = np.ones(len(data), bool)
    np.take(SPACE, data, out=gap)

    def per_document(flags: np.ndarray) -> np.ndarray:
        before = np.r_[0, np.cumsum(flags)]
        return before[offsets[1:]] - before[offsets[:-1]]

    # lines: ranges between line feeds and the ends of documents
    cuts = np.flatnonzero(data == 10)
    starts = np.sort(np.r_[offsets[:-1], cuts + 1])
    ends = np.sort(np.r_[offsets[1:], cuts])
    filled = np.r_[0, np.cumsum(~gap)]
    some = filled[ends] > filled[starts]
    starts, ends = starts[some], ends[some]
    document = np.searchsorted(offsets, starts, side="right") - 1
    lines = mix(byte_sums(data).hashes(starts, ends) + mix(document.astype(np.uint64)))
    order = np.argsort(lines, kind="stable")
    again = np.zeros(len(lines), bool)
    again[order[1:]] = lines[order[1:]] == lines[order[:-1]]

    # windows of three words found again in their document
    hashes, of = words.hashes(), words.documents()
    repeated = np.zeros(len(words), bool)
    if len(words) > 2:
        grams = word_sums(hashes).grams(3)
        at = np.flatnonzero(of[:-2] == of[2:])
        grams = mix(grams[at] + mix(of[at].astype(np.uint64)))
        order = np.argsort(grams)
        ordered = grams[order]
        same = ordered[1:] == ordered[:-1]
        twice = at[order[np.r_[False, same] | np.r_[same, False]]] if len(at) else at
        repeated = covered(twice, np.full(len(twice), 3), len(words))
    return {
        "n_words": np.diff(words.first).astype(np.int64),
        "word_chars": per_document(~gap & ((data & 0xC0) != 0x80)),
        "n_symbols": per_document(_SYMBOLS[data]),
        "n_dup_lines": np.bincount(document[again], minlength=n),
        "n_repeat_words": np.bincount(of[repeated], minlength=n),
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(shard, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            counts = base_counts(data, offsets)
            logs = _log_sums(shard.value, data, offsets, rows.column("_lang").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c) for c in carried],
                    *[pa.array(counts[c].astype(np.int64)) for c in _COUNTS],
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(logs),
                ],
                names=[*carried, *_COUNTS, "_bytes", "_log"],
            )

    return run


def _log_summed(shard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            logs = _log_sums(shard.value, data, offsets, rows.column("_lang").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [rows.column("_lang"), rows.column("_key"), pa.array(logs)], names=["_lang", "_key", "_log"]
            )

    return run


def bands(measured: DataFrame, low_reach: float, high_reach: float) -> DataFrame:
    """Per language the lowest and highest accepted entropy (the logarithm of the perplexity).

    The quartiles are exact over bins of 0.001, of which there are a few thousand.
    """
    ordered = (
        measured.filter("not base_failed and entropy is not null")
        .groupBy("_lang", F.floor(F.col("entropy") * 1000).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_lang")
        .agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("all"))
    )

    def at(share: float) -> str:
        return f"""aggregate(bins, named_struct('seen', 0L, 'bin', cast(null as bigint)), (found, x) ->
            if(found.bin is not null or found.seen + x.n < {share} * all,
               named_struct('seen', found.seen + x.n, 'bin', found.bin),
               named_struct('seen', found.seen, 'bin', x.bin))).bin / 1000"""

    return ordered.select(
        "_lang", F.expr(at(0.25)).alias("q1"), F.expr(at(0.5)).alias("q2"), F.expr(at(0.75)).alias("q3")
    ).selectExpr(
        "_lang",
        f"q2 - {low_reach} * greatest(q2 - q1, 0.02) AS lowest",
        f"q2 + {high_reach} * greatest(q3 - q2, 0.02) + 0.001 AS highest",
    )


def measure(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    carry: tuple[str, ...] = (),
    low_reach: float = LOW_REACH,
    high_reach: float = HIGH_REACH,
    shard_grams: int = SHARD_GRAMS,
) -> DataFrame:
    """Per document row: id, carried columns, counts, ``base_failed``, ``perplexity`` and ``kept``.

    n_words; word_chars: code points in words; n_symbols: characters of #*$%&|<>;
    n_dup_lines: lines with a word that equal an earlier one; n_repeat_words: words in
    three-word windows that occur again. ``low_reach`` and ``high_reach`` are the widths of
    the bands below and above the median, in its distances from the quartiles. Carried columns may include the text.
    """
    spark = docs.sparkSession
    numbers = language_numbers(docs, lang_column)
    grams = written(log_probabilities(levels(docs, numbers, text_column, lang_column)), "grams-log")
    names = list(dict.fromkeys([id_column, *carry]))
    # a carried text goes to the executors once
    hidden = ["_text" if n == text_column else f"_c{i}" for i, n in enumerate(names)]
    text = F.col(f"`{text_column}`")
    rows = docs.select(
        *[F.col(f"`{n}`").alias(h) for n, h in zip(names, hidden) if h != "_text"],
        text.alias("_text"), F.col(f"`{lang_column}`").alias("_language"), F.coalesce(F.md5(text), F.lit("")).alias("_key"),
    )
    rows = _numbered(rows, numbers)
    schema = T.StructType(
        [T.StructField(h, docs.schema[n].dataType) for n, h in zip(names, hidden)]
        + [T.StructField("_lang", T.LongType()), T.StructField("_key", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in (*_COUNTS, "_bytes")]
        + [T.StructField("_log", T.DoubleType())]
    )
    measured, further = None, []
    for i, part in enumerate(shards(grams, shard_grams)):
        shard = spark.sparkContext.broadcast(_searched(part))
        if measured is None:
            found = rows.mapInArrow(_measured(shard, [*hidden, "_lang", "_key"]), schema)
            measured = written(found, "measured")
        else:
            found = rows.select("_text", "_lang", "_key").mapInArrow(
                _log_summed(shard), "_lang bigint, _key string, _log double"
            )
            # rows with equal texts have equal sums
            found = found.groupBy("_lang", "_key").agg(F.max("_log").alias("_log"))
            further.append(written(found, f"measured-{i}"))
        shard.destroy()
    if further:
        rest = functools.reduce(DataFrame.unionByName, further).groupBy("_lang", "_key").agg(F.sum("_log").alias("_rest"))
        measured = measured.join(rest, ["_lang", "_key"], "left").withColumn("_log", F.col("_log") + F.col("_rest"))
    measured = measured.withColumn("entropy", F.when(F.col("_bytes") > 0, -F.col("_log") / F.col("_bytes"))).withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    )
    # one row per language
    limits = F.broadcast(written(bands(measured, low_reach, high_reach), "bands"))
    inside = F.col("entropy").between(F.col("lowest"), F.col("highest"))
    return measured.join(limits, "_lang", "left").select(
        *[F.col(h).alias(n) for n, h in zip(names, hidden)], *_COUNTS, "base_failed",
        F.exp("entropy").alias("perplexity"),
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
