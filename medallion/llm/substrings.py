"""Removal of long word sequences that an earlier document has, by suffix automata.

The reference is cut into shards, and a suffix automaton is built per shard, in
ascending order of document ids, so the first document of a state is the least one
that has its sequences. Streaming a passage through the automaton gives its matching
statistics: after each word the longest match that ends there. Where it reaches
the window length, the window is known, and its state names the first document.

Here every document is a reference for later ones, so the automata together grow
with the corpus, and sending each to all documents would cost the square of it.
Shards are therefore made of the passages of anchor grams (see ``passages``), and
documents send to a shard only passages with grams in it. A passage that brings no
new window is not added to the automaton.

Defined results: null and empty texts have no words; documents without id are
neither cut nor a reference; documents with equal ids are no reference for each
other; repeated rows are returned as often as they occur; an empty table gives no
rows. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, as_text, one_batch, raw, trim
from .passages import found_rows, repeated_windows, without_ranges

#: candidates per shard, in bytes of passages
SHARD_BYTES = 1_000_000
_LAST = (1 << 63) - 1


class SuffixAutomaton:
    """A generalised suffix automaton over words; states know the first document of their sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def _state(self, transitions: dict[int, int], link: int, length: int, first: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def add(self, words: list[int], document: int) -> None:
        """Add a sequence; documents must come in ascending order."""
        following, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            known = following[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            at = last
            if known is None:
                new = self._state({}, 0, length[last] + 1, document)
                while at != -1 and word not in following[at]:
                    following[at][word] = new
                    at = link[at]
                last = new
                if at == -1:
                    continue
                known = following[at][word]
                if length[known] == length[at] + 1:
                    link[new] = known
                    continue
                copy = self._split(at, word, known)
                link[new] = copy
            else:
                last = self._split(at, word, known)

    def _split(self, at: int, word: int, known: int) -> int:
        """The shorter sequences of a state get a state of their own."""
        following, link = self.next, self.link
        copy = self._state(dict(following[known]), link[known], self.length[at] + 1, self.first[known])
        while at != -1 and following[at].get(word) == known:
            following[at][word] = copy
            at = link[at]
        link[known] = copy
        return copy

    def windows(self, words: list[int], size: int) -> list[int]:
        """Per window of ``size`` words the first document that has it, or -1.

        The matching statistics are cut at ``size``: longer matches don't matter.
        """
        following, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        found = []
        for i, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            state = following[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched >= size:
                while length[link[state]] >= size:
                    state = link[state]
                matched = size
                found.append(first[state])
            elif i >= size - 1:
                found.append(-1)
        return found


def _matched(window: int):
    """A shard: build the automaton of its passages while they stream through it."""

    def run(table: pa.Table) -> pa.Table:
        rows = one_batch(table)
        least = rows.column("_least").to_numpy()
        gram, content = rows.column("_gram").to_numpy(), rows.column("_content").to_numpy()
        order = np.lexsort((content, gram, least))
        once = np.r_[True, (np.diff(content[order]) != 0) | (np.diff(gram[order]) != 0)] if len(order) else order
        rows = rows.take(pa.array(order[once]))
        data, offsets = raw(as_text(rows.column("_passage")))
        words = Words(data, offsets)
        _, numbers = np.unique(words.hashes(), return_inverse=True)
        numbers, first = numbers.tolist(), words.first.tolist()
        automaton = SuffixAutomaton()
        found: list[int] = []
        for i, document in enumerate(rows.column("_least").to_pylist()):
            passage = numbers[first[i] : first[i + 1]]
            known = automaton.windows(passage, window)
            if -1 in known:
                automaton.add(passage, document)
                known = [document if k == -1 else k for k in known]
            found += known
        number = rows.column("_windows").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(number)), number)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        batch = found_rows(
            rows.column("_gram"), rows.column("_content"), owner, place,
            np.zeros(len(owner), np.int64), np.array(found, np.int64),
        )
        trim()
        return pa.Table.from_batches([batch])

    return run


def without_earlier(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 50, gram: int = 16
) -> DataFrame:
    """Remove every word covered by a window of words that also starts in a document with a smaller id.

    Returns per document row: id, ``n_words``, ``spans`` (removed maximal word ranges)
    and ``kept`` (the kept words, joined by single spaces).
    """
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("_id"),
        F.xxhash64(text_column).alias("_key"), F.col(text_column).alias("_text"),
    )
    found = repeated_windows(
        rows, "words", window, gram, _matched(window),
        repeated=F.col("least") < F.col("most"),
        deal=lambda candidates, number: candidates.withColumn("_bucket", F.expr(f"cast(pmod(_gram, {number}) as int)")),
        chosen=lambda joined: F.col("run.least") < F.col("_id"),
        bucket_bytes=SHARD_BYTES,
        only=F.col("_id") != _LAST,
    )
    kept = without_ranges(rows, found, "words", "_id")
    return kept.select(
        F.when(F.col("_id") != _LAST, F.col("_id")).cast(docs.schema[id_column].dataType).alias(id_column),
        F.col("n_units").alias("n_words"), "spans", F.col("kept").cast("string").alias("kept"),
    )
