"""Jaccard join of documents on word n-grams by prefix filtering.

Documents with equal n-gram sets form a class; the join is between classes.

* Order: n-grams are sorted rare first. Their document frequencies come from a
  count table of fixed size over all documents (n-grams share a counter if the high
  bits of their hashes agree), which is small enough to broadcast at any input size.
  Any common order gives the same pairs; the frequencies only keep lists short.
* Prefix filter: sets with Jaccard similarity t share one of their first
  n - ceil(t n) + 1 n-grams, so classes are joined on those.
* Length and positional filters: sizes must be within t, and the places of the
  shared n-gram in both orders must leave room for the overlap that t asks for.
* Suffix filter: sets are folded to 512 parities; differing parities are a lower
  bound of the n-grams that only one set has.
* Verification: once per pair, over the texts.

Linked documents form components, so a pair within a component needs no look once
it is known to be one. First every class is compared with the first and with the
preceding class of each list, which is linear in the list; components follow from
the links found. Only then are pairs of different components that share a
list compared, all of them that the filters leave; the join of the lists applies the
filters itself, so other pairs never become rows. So the result is that of all
pairs, but a large group of near copies costs a few comparisons per member.

Defined results: null and empty texts have no n-grams and link with nothing; a
text with fewer words than n has one n-gram, the whole sequence; repeated rows are
copies; a document without id takes part and is never a component's name unless all
of it have none; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .common import Words, as_text, mix, one_batch, ranges, raw, ship, signed, slices, word_sums, written
from .components import components

#: counters of the frequency table, and how they are cut into rows
COUNTER_BITS, CHUNK_BITS = 20, 14
#: tasks whose tables are added in the first step
FAN_IN = 256


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct n-grams of the documents of a slice, sorted."""
    words = Words(data, offsets, fold_case=True)
    sums = word_sums(words.hashes())
    counts = np.diff(words.first)
    document = words.documents()
    grams = sums.grams(size)
    whole = np.flatnonzero(document[: len(grams)] == document[size - 1 :][: len(grams)])
    short = np.flatnonzero((counts > 0) & (counts < size))
    owner = np.concatenate([document[whole], short])
    found = np.concatenate([grams[whole], sums.hashes(words.first[short], words.first[short + 1])])
    order = np.argsort(found)
    by = owner[order]
    order = order[np.argsort(by.astype(np.uint16) if len(counts) < 1 << 16 else by, kind="stable")]
    owner, found = owner[order], found[order]
    if len(found):
        new = np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]
        owner, found = owner[new], found[new]
    return owner, found


def class_hashes(owner: np.ndarray, found: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of n-grams, hash of the set) per document."""
    size = np.bincount(owner, minlength=n)
    first = np.cumsum(size) - size
    total, folded = np.zeros((2, n), np.uint64)
    some = size > 0
    if some.any():
        scrambled = mix(found + np.uint64(0x2545F4914F6CDD1D))
        total[some] = np.add.reduceat(scrambled, first[some])
        folded[some] = np.bitwise_xor.reduceat(mix(scrambled), first[some])
    return size, mix(total + mix(folded + size.astype(np.uint64)))


def _first_seen(seen: set, classes: np.ndarray) -> np.ndarray:
    """Which documents bring a class that the task has not had."""
    new = np.zeros(len(classes), bool)
    for i, c in enumerate(classes.tolist()):
        if c not in seen:
            seen.add(c)
            new[i] = True
    return new


def _light(size: int):
    """Per document its set's size and hash; at the end the task's counters, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen = np.zeros(1 << COUNTER_BITS, np.uint32), set()
        names = ["_id", "_key", "n", "class", "chunk", "task", "counts"]
        kind = None
        for rows, data, offsets in slices(batches, "_text"):
            kind = rows.column("_id").type
            owner, found = shingle_sets(data, offsets, size)
            number, classes = class_hashes(owner, found, len(offsets) - 1)
            new = _first_seen(seen, classes)
            counters += np.bincount(
                (found[new[owner]] >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(counters)
            ).astype(np.uint32)
            none = pa.nulls(len(number), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_id"), rows.column("_key"), pa.array(number, pa.int32()), signed(classes),
                    none, none, pa.nulls(len(number), pa.binary()),
                ],
                names=names,
            )
        if seen:
            chunks = counters.reshape(-1, 1 << CHUNK_BITS)
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                    pa.array(np.arange(n), pa.int32()),
                    pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()),
                    pa.array([c.tobytes() for c in chunks], pa.binary()),
                ],
                names=names,
            )

    return run


def _added(table: pa.Table) -> pa.Table:
    rows = one_batch(table)
    total = np.zeros(1 << CHUNK_BITS, np.uint64)
    for counts in rows.column("counts"):
        total += np.frombuffer(counts.as_buffer(), np.uint32)
    total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
    return pa.table({"chunk": rows.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _frequencies(light: DataFrame) -> np.ndarray:
    """The sum of the tasks' counters."""
    tables = light.filter("chunk is not null").select("chunk", F.floor(F.col("task") / FAN_IN).alias("part"), "counts")
    some = tables.groupBy("chunk", "part").applyInArrow(_added, "chunk int, counts binary")
    total = np.zeros((1 << (COUNTER_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint32)
    for r in some.groupBy("chunk").applyInArrow(_added, "chunk int, counts binary").collect():
        total[r["chunk"]] = np.frombuffer(r["counts"], np.uint32)
    return total.reshape(-1)


#: numbers of 64 parities that a set is folded to
CELLS = 8
_CELL_NAMES = [f"c{i}" for i in range(CELLS)]


def _parities(owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """CELLS numbers per document: parities of how many n-grams fall in each of 64 * CELLS cells."""
    size = 64 * CELLS
    cell = ((found >> np.uint64(8)) % np.uint64(size)).astype(np.int64)
    cells = np.bincount(owner * size + cell, minlength=n * size)
    return np.packbits((cells & 1).astype(np.uint8).reshape(n, size), axis=1).view(np.uint64).reshape(n, CELLS)


def _prefixes(size: int, frequencies, percent: int):
    """Rows (gram, class, at) of the prefixes of the classes; ``at`` is n * 2^32 + place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = frequencies.value, set()
        for rows, data, offsets in slices(batches, "_text"):
            owner, found = shingle_sets(data, offsets, size)
            number, classes = class_hashes(owner, found, len(offsets) - 1)
            new = _first_seen(seen, classes)
            some = new[owner]
            owner, found = owner[some], found[some]
            number = np.where(new, number, 0)
            # rare first; equal frequencies by hash, which the sets are sorted by
            rarity = table[(found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64)
            order = np.argsort(rarity << np.uint64(32) | (found << np.uint64(COUNTER_BITS)) >> np.uint64(32), kind="stable")
            by = owner[order]
            order = order[np.argsort(by.astype(np.uint16) if len(number) < 1 << 16 else by, kind="stable")]
            length = np.where(number > 0, number - -(-number * percent // 100) + 1, 0)
            # sets this small can only link with equal ones
            length[number * 100 < (number + 1) * percent] = 0
            first = np.cumsum(number) - number
            at = ranges(first, length)
            document = np.repeat(np.arange(len(number)), length)
            yield pa.RecordBatch.from_arrays(
                [
                    signed(found[order[at]]), signed(classes[document]),
                    pa.array(number[document].astype(np.int64) << 32 | (at - first[document])),
                ],
                names=["gram", "class", "at"],
            )

    return run


def _fetched(size: int):
    """Texts of classes with the parities of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text"):
            owner, found = shingle_sets(data, offsets, size)
            cells = _parities(owner, found, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [rows.column("class"), rows.column("_text"), *[signed(cells[:, i].copy()) for i in range(CELLS)]],
                names=["class", "_text", *_CELL_NAMES],
            )

    return run


def _overlaps(size: int):
    """Pairs of texts get the sizes of their sets and of the intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "_text_a"):
            one = shingle_sets(data, offsets, size)
            two = shingle_sets(*raw(as_text(rows.column("_text_b"))), size)
            n = len(offsets) - 1
            owner, found = (np.concatenate(x) for x in zip(one, two))
            order = np.lexsort((found, owner))
            owner, found = owner[order], found[order]
            both = np.flatnonzero((owner[1:] == owner[:-1]) & (found[1:] == found[:-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("a"), rows.column("b"),
                    pa.array(np.bincount(one[0], minlength=n) + np.bincount(two[0], minlength=n)),
                    pa.array(np.bincount(owner[both], minlength=n)),
                ],
                names=["a", "b", "sizes", "shared"],
            )

    return run


def _possible(percent: int, x: str, y: str) -> Column:
    """Length and positional filters of two list entries."""
    nx, ny = F.shiftright(x, 32), F.shiftright(y, 32)
    px, py = F.col(x).bitwiseAND(F.lit(0xFFFFFFFF)), F.col(y).bitwiseAND(F.lit(0xFFFFFFFF))
    least = F.lit(percent) * (nx + ny)  # (100 + percent) * overlap must reach this
    room = F.least(px, py) + 1 + F.least(nx - px, ny - py) - 1
    return (
        (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent)
        & (room * (100 + percent) >= least)
    )


def _alike(percent: int, x: str, y: str) -> Column:
    """Suffix filter of two sets with n and parities."""
    apart = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in _CELL_NAMES), F.lit(0))
    return apart * (100 + percent) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (100 - percent)


def _pairs(one: str, two: str) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose similarity reaches percent / 100; others are dropped."""
    sides = [texts.select(*[F.col(c).alias(f"{s}_{c}") for c in ("class", "n", *_CELL_NAMES)]) for s in "ab"]
    # the suffix filter goes first, over numbers only
    possible = (
        pairs.join(sides[0], F.col("a") == F.col("a_class"))
        .join(sides[1], (F.col("b") == F.col("b_class")) & _alike(percent, "a_", "b_"))
        .select("a", "b")
    )
    both = possible.join(texts.select(F.col("class").alias("a"), F.col("_text").alias("_text_a")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("_text").alias("_text_b")), "b"
    )
    found = both.select("a", "b", "_text_a", "_text_b").mapInArrow(
        _overlaps(size), "a bigint, b bigint, sizes bigint, shared bigint"
    )
    return found.filter((100 + percent) * F.col("shared") >= percent * F.col("sizes")).select("a", "b")


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_key"), F.col(text_column).alias("_text")
    )


def _labelled(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(_id, _key, n, class) of all documents, and (class, least, at, component) of all classes."""
    ship(rows.sparkSession)
    schema = T.StructType(
        [T.StructField("_id", rows.schema["_id"].dataType)]
        + T.StructType.fromDDL("_key bigint, n int, class bigint, chunk int, task int, counts binary").fields
    )
    light = written(rows.mapInArrow(_light(size), schema), "sets")
    sets = light.filter("chunk is null").select("_id", "_key", "n", "class")
    classes = written(
        sets.filter("n > 0").groupBy("class").agg(
            F.min("_id").alias("least"),
            F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")).alias("at"),
            F.min("n").alias("n"),
        ),
        "classes",
    )
    shared = _shared(rows, light, size, percent)
    texts = _texts(rows, shared, classes, size)
    component = components(_links(shared, texts, size, percent))
    named = (
        classes.select("class", "least", "at")
        .join(component.select(F.col("node").alias("class"), "component"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    return sets, named


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """Per document row: id, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets
    of ``size``-word shingles (A-Z lower-cased).
    """
    sets, named = _labelled(_rows(docs, id_column, text_column), size, percent)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "component").select(F.col("class").alias("_class"), "component_id")
    return sets.withColumn("_class", F.when(F.col("n") > 0, F.col("class"))).join(of_class, "_class", "left").select(
        F.col("_id").alias(id_column), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The documents without near duplicates, all columns: of each component the row with the least id.

    Documents without words stay. Of rows with equal id and text one stays.
    """
    sets, named = _labelled(_rows(docs, id_column, text_column), size, percent)
    first = named.groupBy("component").agg(F.min("at").alias("at")).select(
        F.col("at._id").alias("_first_id"), F.col("at._key").alias("_first_key")
    )
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.xxhash64(text_column).alias("_key")
    )
    words = F.coalesce(F.col(names[text_column]), F.lit("")).rlike("[^ \\x09-\\x0D]")
    same = F.col(names[id_column]).eqNullSafe(F.col("_first_id")) & (F.col("_key") == F.col("_first_key"))
    kept = rows.filter(words).join(first, same).drop("_first_id", "_first_key")
    twice = sets.filter("n > 0").groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    if twice.limit(1).count():
        # only rows that stand there more than once are shuffled again
        again = F.col(names[id_column]).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_same"))
        twice = twice.select("_id", F.col("_key").alias("_same"))
        once = kept.join(twice, again, "left_anti")
        kept = once.unionByName(
            kept.join(twice, again, "left_semi").dropDuplicates([names[id_column], "_key"])
        )
    kept = kept.unionByName(rows.filter(~words))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def _shared(rows: DataFrame, light: DataFrame, size: int, percent: int) -> DataFrame:
    """Prefix entries of n-grams that two or more classes have, with two partners each."""
    frequencies = rows.sparkSession.sparkContext.broadcast(_frequencies(light))
    prefixes = rows.mapInArrow(
        _prefixes(size, frequencies, percent), "gram bigint, class bigint, at bigint"
    )
    lists = Window.partitionBy("gram").orderBy("class")
    whole = lists.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.struct("class", "at")
    found = written(
        prefixes.withColumns(
            {
                "first": F.first(entry).over(lists),
                "before": F.lag(entry).over(lists),
                "last": F.max("class").over(whole),
            }
        )
        # a class that several tasks have seen stands there once
        .filter("first.class <> last and (before is null or before.class <> class)")
        .drop("last"),
        "prefixes",
        release=True,
    )
    frequencies.destroy()
    return found


def _texts(rows: DataFrame, shared: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """One text per class that has a list in common with another one."""
    wanted = shared.select("class").distinct().join(classes, "class").select(
        "class", "n", F.col("at._id").alias("_id"), F.col("at._key").alias("_key")
    )
    found = wanted.select("class", F.col("_id").alias("_wid"), F.col("_key").alias("_wkey"))
    texts = rows.join(
        found, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_key") == F.col("_wkey"))
    ).select("class", "_text")
    schema = "class bigint, _text string, " + ", ".join(f"{c} bigint" for c in _CELL_NAMES)
    return written(texts.mapInArrow(_fetched(size), schema), "texts", release=True).join(
        wanted.select("class", "n"), "class"
    )


def _links(shared: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that connect what all links connect."""
    near = [
        shared.withColumn("_at", F.col(f"{who}.at"))
        .filter(f"{who}.class <> class")
        .filter(_possible(percent, "at", "_at"))
        .select(*_pairs("class", f"{who}.class"))
        for who in ("first", "before")
    ]
    tried = written(near[0].union(near[1]).distinct(), "pairs")
    links = written(linked(tried, texts, size, percent), "links", release=True)
    labels = components(links)
    marked = shared.select("gram", "class", "at").join(
        labels.select(F.col("node").alias("class"), "component"), "class", "left"
    ).withColumn("label", F.coalesce("component", "class"))
    split = marked.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    open_lists = written(
        marked.join(split.select("gram"), "gram")
        .select("gram", "class", "at", "label")
        .join(texts.select("class", "n", *_CELL_NAMES), "class"),
        "open-lists",
    )
    other = open_lists.select("gram", *[F.col(c).alias(f"_{c}") for c in open_lists.columns if c != "gram"])
    rest = (
        open_lists.join(other, "gram")
        .filter((F.col("class") < F.col("_class")) & (F.col("label") != F.col("_label")))
        .filter(_possible(percent, "at", "_at") & _alike(percent, "", "_"))
        .select(*_pairs("class", "_class"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    return links.union(linked(rest, texts, size, percent))
