"""Removal of long byte strings that occur more than once, by sorting suffixes.

Only suffixes that start in a passage with a repeated anchor gram take part (see
``passages``); copies of a passage count as one suffix with a weight. Sampled
splitters over the leading bytes (with the gram behind them) range-partition the
passages into buckets, and a splitter never parts equal leading grams, so strings
that could be equal across a boundary meet in one bucket. Each bucket sorts its
suffixes by multikey quicksort, all groups at once: a group with equal strings so
far is sorted by its next token, groups without a difference stay as they are, and
suffixes that are alone are done. It ends at the depth of the window; groups that
are left, weighing two or more, are the repeated strings.

A token is a block of bytes, represented by its 64-bit hash, so eight comparisons
reach a depth of 400 bytes.

Defined results: null and empty texts have no bytes; documents without id are
documents like others; repeated rows are documents of their own, so they are
copies of each other; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_text, byte_sums, one_batch, ranges, raw, trim
from .passages import found_rows, repeated_windows, without_ranges

BUCKET_BYTES = 2_000_000


def multikey_sort(tokens: np.ndarray, starts: np.ndarray, depths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, group of each): those that equal another one at all depths, in sorted order.

    tokens: the token at each place; starts: where the suffixes begin.
    """
    suffix = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    for depth in depths:
        if not len(suffix):
            break
        key = tokens[starts[suffix] + depth]
        same = group[1:] == group[:-1]
        differs = same & (key[1:] != key[:-1])
        mixed = np.zeros(int(group[-1]) + 1, bool)
        mixed[group[1:][differs]] = True
        some = np.flatnonzero(mixed[group])
        if len(some):
            # the members of mixed groups, sorted by (group, token), take the places they had
            order = some[np.lexsort((key[some], group[some]))]
            suffix[some], key[some] = suffix[order], key[order]
        begins = np.r_[True, ~(same & (key[1:] == key[:-1]))]
        alone = begins & np.r_[begins[1:], True]
        group = np.cumsum(begins) - 1
        suffix, group = suffix[~alone], group[~alone]
        if len(group):
            group = np.cumsum(np.r_[0, group[1:] != group[:-1]])
    return suffix, group


def _compared(window: int, block: int):
    depths = sorted({*range(0, window - block, block), window - block})

    def run(table: pa.Table) -> pa.Table:
        rows = one_batch(table)
        gram, content = rows.column("_gram").to_numpy(), rows.column("_content").to_numpy()
        order = np.lexsort((content, gram))
        once = np.r_[True, (np.diff(content[order]) != 0) | (np.diff(gram[order]) != 0)] if len(order) else order
        rows = rows.take(pa.array(order[once]))
        data, offsets = raw(as_text(rows.column("_passage")))
        number = rows.column("_windows").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(number)), number)
        starts = ranges(offsets[:-1], number)
        weight = rows.column("_copies").to_numpy()[owner]
        total = weight.copy()
        suffix, group = multikey_sort(byte_sums(data).grams(block), starts, depths)
        if len(suffix):
            total[suffix] = np.bincount(group, weight[suffix])[group].astype(np.int64)
        batch = found_rows(
            rows.column("_gram"), rows.column("_content"), owner, starts - offsets[:-1][owner],
            np.minimum(total, 2), np.zeros(len(owner), np.int64),
        )
        trim()
        return pa.Table.from_batches([batch])

    return run


def _dealt(candidates: DataFrame, number: int) -> DataFrame:
    """Range partitions over leading bytes; Spark samples the splitters."""
    return candidates.repartitionByRange(number, "_lead", "_gram").withColumn("_bucket", F.spark_partition_id())


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 400,
    gram: int = 128,
    block: int = 50,
) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts anywhere else.

    Returns per document row: id, ``n_bytes``, ``spans`` (removed maximal byte ranges)
    and ``kept`` (the other bytes, concatenated).
    """
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("_id"),
        F.xxhash64(text_column).alias("_key"), F.col(text_column).alias("_text"),
    )
    found = repeated_windows(
        rows, "bytes", window, gram, _compared(window, block),
        repeated=F.col("copies") > 1, deal=_dealt,
        chosen=lambda joined: F.col("run.copies") > 1,
        bucket_bytes=BUCKET_BYTES,
    )
    kept = without_ranges(rows, found, "bytes", "_id")
    return kept.select(
        F.when(F.col("_id") != (1 << 63) - 1, F.col("_id")).cast(docs.schema[id_column].dataType).alias(id_column),
        F.col("n_units").alias("n_bytes"), "spans", "kept",
    )
