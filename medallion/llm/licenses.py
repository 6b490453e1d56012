"""Licence scans: TF-IDF cosine of text to licence templates, then inheritance along directories.

Every line and every paragraph of a text is compared with all templates as sparse
TF-IDF vectors. Document frequencies of the templates' words come from Spark counts
over all texts; a word in no template weighs like a word seen nowhere, so that other
text in a line lowers its similarity. Most lines have too little weight in template
words to reach the threshold whatever the rest; a bound over counts drops those
before any vector is built.

A file whose name says so, or that consists mostly of a licence, is the licence
file of its directory. A file without a licence of its own inherits that of the
nearest directory above it that has one: directories, not files, are joined with
the prefixes of their paths, then files with their directories.

Broadcast: the templates, which the caller passes as a list, at most ``MAX_TEMPLATES``.

Defined results: null and empty texts have no licence of their own but inherit; a
null path has no directory and does not inherit; of equal similarities the template
listed first wins, of licence files of a directory the most similar one, then the one with
the least path; repeated rows are scanned each; an empty table gives no rows. Only
the id, path and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import Words, ranges, ship, slices, written

#: bytes between words: all of ASCII but letters and digits
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
MAX_TEMPLATES = 10_000
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicen[cs]e|notice)([.-][^/]*)?$"

#: fixed values: usual notices, (licence, text)
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
        " in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met:",
    ),
]


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, word hash) of all words of a few texts."""
    found = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(found), np.uint8)
    words = Words(data, np.r_[0, np.cumsum([len(f) for f in found])], GAP, fold_case=True)
    return words.documents(), words.hashes()


class Vectors:
    """Templates as sparse unit vectors: per word of their vocabulary the templates that have it, with its weight there."""

    def __init__(self, texts: list[str], vocabulary: np.ndarray, counts: np.ndarray, total: int):
        self.vocabulary = vocabulary
        self.idf = np.log((1 + total) / (1 + counts)) + 1
        self.unknown = np.log(1 + total) + 1
        owner, hashes = _hashed(texts)
        self.templates = len(texts)
        entries, times = np.unique(np.searchsorted(vocabulary, hashes) * len(texts) + owner, return_counts=True)
        word, self.owner = entries // len(texts), entries % len(texts)
        weight = times * self.idf[word]
        norm = np.sqrt(np.bincount(self.owner, weight**2, len(texts)))
        self.weight = weight / np.maximum(norm, 1e-12)[self.owner]
        #: entries of word w: range(first[w], first[w + 1])
        self.first = np.searchsorted(word, np.arange(len(vocabulary) + 1))

    def columns(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the vocabulary, -1 for other words."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def best(self, unit: np.ndarray, hashes: np.ndarray, least: float):
        """(units, template, similarity) of the units that reach ``least``; unit: of each word, ascending."""
        if not len(unit):
            return unit, unit, np.zeros(0)
        column = self.columns(hashes)
        n = int(unit[-1]) + 1
        inside = np.bincount(unit, np.where(column >= 0, self.idf[column], 0), n)
        outside = np.bincount(unit, column < 0, n)
        # |inside| is at most the sum of its weights, |outside|^2 at least the number of its words
        some = inside**2 * (1 - least**2) >= least**2 * self.unknown**2 * outside - 1e-9
        keep = some[unit] & (inside > 0)[unit]
        unit, hashes, column = unit[keep], hashes[keep], column[keep]
        if not len(unit):
            return unit, unit, np.zeros(0)
        order = np.lexsort((hashes, unit))
        unit, hashes, column = unit[order], hashes[order], column[order]
        first = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (hashes[1:] != hashes[:-1])])
        times = np.diff(np.r_[first, len(unit)])
        unit, column = unit[first], column[first]
        weight = times * np.where(column >= 0, self.idf[column], self.unknown)
        begins = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        norm = np.sqrt(np.add.reduceat(weight**2, begins))
        # products of the words that a unit and a template share, summed per unit and template
        number = np.cumsum(np.r_[False, unit[1:] != unit[:-1]])
        known = np.flatnonzero(column >= 0)
        shared = self.first[column[known] + 1] - self.first[column[known]]
        entry = ranges(self.first[column[known]], shared)
        pair = np.repeat(number[known], shared) * self.templates + self.owner[entry]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        product = (np.repeat(weight[known], shared) * self.weight[entry])[order]
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        of, template = pair[starts] // self.templates, pair[starts] % self.templates
        similar = np.add.reduceat(product, starts) / norm[of]
        # the most similar template of each unit, the first of equals
        order = np.lexsort((template, -similar.round(9), of))
        best = order[np.r_[True, of[order][1:] != of[order][:-1]]]
        best = best[similar[best] >= least - 1e-12]
        return unit[begins][of[best]], template[best], similar[best]


def _word_counts(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = 0, np.zeros(len(vocabulary), np.int64)
        for _, data, offsets in slices(batches, "_text"):
            words = Words(data, offsets, GAP, fold_case=True)
            hashes = words.hashes()
            at = np.searchsorted(vocabulary, hashes)
            at[at == len(vocabulary)] = 0
            known = vocabulary[at] == hashes
            once = np.unique(words.documents()[known] * len(vocabulary) + at[known])
            counts += np.bincount(once % len(vocabulary), minlength=len(vocabulary))
            total += len(offsets) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(len(vocabulary)), -1], pa.int32()), pa.array([*counts.tolist(), total], pa.int64())],
            names=["word", "n"],
        )

    return run


def _units(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Starts of the lines, and of the paragraphs, of all documents."""
    feeds = np.flatnonzero(data == 10)
    lines = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    # a paragraph starts after a line without anything but white space
    size = np.diff(np.r_[lines, len(data)])
    solid = np.r_[0, np.cumsum(~np.isin(data, np.frombuffer(b" \t\n\v\f\r", np.uint8)))]
    empty = solid[lines + size] == solid[lines]
    paragraphs = np.unique(np.concatenate([offsets[:-1], lines[np.r_[False, empty[:-1]]]]))
    return [lines, paragraphs]


def _scanned(vectors, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            words = Words(data, offsets, GAP, fold_case=True)
            hashes, n = words.hashes(), len(offsets) - 1
            score, template, share = np.zeros(n), np.full(n, -1), np.zeros(n)
            for starts in _units(data, offsets):
                unit = np.searchsorted(starts, words.starts, side="right") - 1
                found, which, similar = vectors.value.best(unit, hashes, least)
                if not len(found):
                    continue
                size = np.bincount(unit, minlength=len(starts))[found]
                document = np.searchsorted(offsets, starts[found], side="right") - 1
                order = np.lexsort((-which, similar.round(9), document))
                last = order[np.r_[document[order][1:] != document[order][:-1], True]]
                own = document[last]
                better = similar[last].round(9) > score[own].round(9)
                own, last = own[better], last[better]
                score[own], template[own] = similar[last], which[last]
                share[own] = size[last] / np.diff(words.first)[own]
            none = template < 0
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_id"), rows.column("_path"),
                    pa.array(template, pa.int32(), mask=none), pa.array(score.round(6), mask=none),
                    pa.array(share, mask=none),
                ],
                names=["_id", "_path", "template", "score", "share"],
            )

    return run


def directory(path: str) -> Column:
    """What comes before the last slash; empty at the top."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def scan(
    files: DataFrame,
    id_column: str = "doc_id",
    path_column: str = "path",
    text_column: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    least: float = 0.8,
    file_share: float = 0.5,
) -> DataFrame:
    """Per file: id, ``path``, ``own_license``, ``score``, ``license`` and ``inherited_from`` (id of a licence file).

    ``least``: the similarity of a licence notice; ``file_share``: the share of words in the
    notice from which a file counts as a licence file.
    """
    spark = files.sparkSession
    ship(spark)
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MAX_TEMPLATES} are broadcast")
    texts = [t for _, t in templates]
    vocabulary = np.unique(_hashed(texts)[1])
    rows = files.select(
        F.col(id_column).alias("_id"), F.col(path_column).alias("_path"), F.col(text_column).alias("_text")
    )
    counted = (
        rows.select("_text").mapInArrow(_word_counts(vocabulary), "word int, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    )
    counts = {r["word"]: r["n"] for r in counted}
    of_word = np.array([counts.get(i, 0) for i in range(len(vocabulary))])
    vectors = spark.sparkContext.broadcast(Vectors(texts, vocabulary, of_word, counts.get(-1, 0)))
    schema = T.StructType(
        [T.StructField("_id", files.schema[id_column].dataType), T.StructField("_path", T.StringType())]
        + T.StructType.fromDDL("template int, score double, share double").fields
    )
    names = F.array(*[F.lit(name) for name, _ in templates])
    found = rows.mapInArrow(_scanned(vectors, least), schema).withColumns(
        {"own_license": F.get(names, F.col("template")), "_dir": directory("_path")}
    )
    # texts are scanned once; directories meet over these light rows
    found = written(found, "scanned")
    vectors.destroy()
    licence_files = found.filter(
        F.col("own_license").isNotNull() & ((F.col("share") >= file_share) | F.col("_path").rlike(LICENCE_FILE))
    )
    # the most similar one of a directory, then the least path
    of_dir = licence_files.groupBy("_dir").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "_path", "_id", "own_license")).alias("best")
    ).select(F.col("_dir").alias("above"), F.col("best._id").alias("inherited_from"), F.col("best.own_license").alias("inherited"))
    parts = F.split("_dir", "/")
    above = F.when(F.col("_dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(
            F.array(F.lit("")),
            F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")),
        )
    )
    nearest = (
        found.select("_dir").distinct().select("_dir", F.explode(above).alias("above"))
        .join(of_dir, "above")
        .groupBy("_dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "inherited_from", "inherited")).alias("near"))
        .select(F.col("_dir").alias("_near_dir"), "near.inherited_from", "near.inherited")
    )
    # one row per directory; as a table of its own, so that Spark can split a directory with many files in the join
    nearest = written(nearest, "nearest-licences")
    own = F.col("own_license").isNotNull()
    return found.join(nearest, F.col("_dir") == F.col("_near_dir"), "left").select(
        F.col("_id").alias(id_column), F.col("_path").alias("path"), "own_license", "score",
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(~own, F.col("inherited_from")).alias("inherited_from"),
    )
