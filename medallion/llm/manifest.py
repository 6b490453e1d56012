"""A Merkle manifest of a dataset: one digest for all rows, a proof for each of them.

Rows are the leaves. Each group of rows (a source) is a tree of its own, the roots of
the groups are the leaves of one more tree. A node is the SHA-256 of the hexadecimal
digests of up to FANOUT children.

No row is sorted to find its place among the leaves of its group. Each group has a
bitmap of its ids, compressed to its 64-bit words that are not empty; partial words
are merged by OR before and after one shuffle. Directories of popcounts say how many
ids come before a word: running sums within blocks of words, of blocks within
super-blocks, and of those within the group, so no sum runs over a whole group. The
place of a row is the directory's count and the number of set bits below its own.

Levels are reduced by keyed slot arrays: the leaves of a block of 16 ** 3 places meet in an array, slots are filled by place, and a block's root is one of the
leaves of the next step. So a step shrinks the tree 4096 times and no group of rows
is ever larger than a block.

Defined results: a null in a hashed column is the field ``-``; a null group is a
group of its own before all others; null ids come before all others. Rows with equal
ids are ordered by leaf, and rows that are equal in all hashed columns are leaves of
their own with equal digests. A group with one row has the leaf as its root, and a
table with one group has that group's root. An empty table has no rows in any result.
Only the hashed columns, the id and the group are read, so other columns may have any
names. Ids are whole numbers up to 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .common import ship, trim, written

#: children of a node
FANOUT = 16
#: the word of null ids: below those of all others
_NULL_WORD = -(1 << 57) - 1


@dataclass(frozen=True)
class Layout:
    """How the work is cut; results do not depend on it."""

    #: levels that a step reduces
    levels: int = 3
    #: a bitmap word has 64 ids; a block and a super-block have 2 ** fan_bits of the smaller ones
    fan_bits: int = 20
    #: equal rows that one row of a work table stands for while their places are listed
    copies: int = 4096

    @property
    def width(self) -> int:
        """Leaves of a block."""
        return FANOUT**self.levels


# -- leaves and their places ---------------------------------------------------------


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hexadecimal SHA-256 of columns: each ``-`` if null, else bytes, colon, value."""
    fields = []
    for value in columns.values():
        text = value.cast("string")
        field = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        fields.append(F.coalesce(field, F.lit("-")))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def _before(keys: list[str], order: str, *more: str) -> Column:
    """The sum of ``_n`` over the rows before this one."""
    window = Window.partitionBy(*keys).orderBy(order, *more).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0).cast("long"))


def directory(rows: DataFrame, layout: Layout) -> DataFrame:
    """(_tree, _word, _bits, _n, _base, _total) of rows with _tree, _word, _bit.

    The bitmap words of each tree with their rows, the rows of the tree before the
    word, and all rows of the tree.
    """
    bit = F.expr("shiftleft(1L, _bit)")
    words = rows.groupBy("_tree", "_word").agg(F.bit_or(bit).alias("_bits"), F.count("*").alias("_n"))
    words = words.withColumn("_block", F.shiftright("_word", layout.fan_bits))
    blocks = words.groupBy("_tree", "_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.withColumn("_super", F.shiftright("_block", layout.fan_bits))
    supers = blocks.groupBy("_tree", "_super").agg(F.sum("_n").alias("_n"))
    supers = supers.select(
        "_tree", "_super", _before(["_tree"], "_super").alias("_supers"),
        F.sum("_n").over(Window.partitionBy("_tree")).alias("_total"),
    )
    blocks = blocks.select("_tree", "_super", "_block", _before(["_tree", "_super"], "_block").alias("_blocks"))
    words = words.select("_tree", "_block", "_word", "_bits", "_n", _before(["_tree", "_block"], "_word").alias("_words"))
    joined = words.join(blocks, ["_tree", "_block"]).join(supers, ["_tree", "_super"])
    base = F.col("_supers") + F.col("_blocks") + F.col("_words")
    return joined.select("_tree", "_word", "_bits", "_n", base.alias("_base"), "_total")


def _repeated_ids(rows: DataFrame, layout: Layout) -> DataFrame:
    """(_tree, _place, _total, id, leaf, claimed) of the rows of words with repeated ids.

    Equal rows are counted first. Then places are found by id, by the first bytes of
    the leaf and by leaf, each within groups that have a bounded number of counts.
    """
    keys = ["_tree", "_word", "_bit", "_part"]
    counted = rows.groupBy("_tree", "_word", "_bit", "_base", "_total", "id", "leaf", "claimed").agg(
        F.count("*").alias("_n")
    )
    part = F.conv(F.hex(F.substring("leaf", 1, 2)), 16, 10).cast("int")
    counted = written(counted.withColumn("_part", part), "manifest-repeated")
    parts = counted.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    ids = parts.groupBy(*keys[:3]).agg(F.sum("_n").alias("_n"))
    ids = ids.select(*keys[:3], _before(keys[:2], "_bit").alias("_ids"))
    parts = parts.select(*keys, _before(keys[:3], "_part").alias("_parts"))
    counted = counted.withColumn("_leaves", _before(keys, "leaf", "claimed"))
    found = counted.join(parts, keys).join(ids, keys[:3])
    first = F.col("_base") + F.col("_ids") + F.col("_parts") + F.col("_leaves")
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {layout.copies}")))
    found = found.withColumn("_first", first).withColumn("_piece", pieces)
    found = found.withColumn("_first", F.col("_first") + F.col("_piece") * layout.copies)
    found = found.withColumn("_n", F.least(F.col("_n") - F.col("_piece") * layout.copies, F.lit(layout.copies)))
    # a much repeated row is spread over the tasks before it is listed
    found = found.repartition("_tree", "_first")
    place = F.explode(F.expr("sequence(_first, _first + _n - 1)"))
    return found.select("_tree", place.alias("_place"), "_total", "id", "leaf", "claimed")


def placed(leaves: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(_tree, _place, _total, id, leaf, claimed) of (_tree, id, leaf, claimed)."""
    word = F.coalesce(F.shiftright("id", 6), F.lit(_NULL_WORD).cast("long"))
    bit = F.coalesce(F.col("id").bitwiseAND(F.lit(63).cast("long")), F.lit(0).cast("long")).cast("int")
    rows = leaves.withColumns({"_word": word, "_bit": bit})
    words = written(directory(rows, layout), "manifest-directory")
    joined = rows.join(words, ["_tree", "_word"])
    single = F.col("_n") == F.bit_count("_bits")
    below = F.bit_count(F.expr("_bits & ~shiftleft(-1L, _bit)"))
    found = joined.filter(single).select(
        "_tree", (F.col("_base") + below).alias("_place"), "_total", "id", "leaf", "claimed"
    )
    if words.filter(~single).isEmpty():
        return found
    return found.unionByName(_repeated_ids(joined.filter(~single), layout))


# -- levels --------------------------------------------------------------------------


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode("ascii")


def _levels(digests: list[bytes], total: int, layout: Layout) -> list[list[bytes]]:
    """The nodes of a block, level by level, as hexadecimal digests; the last has one node.

    total: nodes of the tree; if they are one block, the tree ends at its first single node.
    """
    found = [digests]
    while len(found[-1]) > 1 if total <= layout.width else len(found) <= layout.levels:
        below = found[-1]
        found.append([_digest(b"".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return found


def _slots(row: dict, digest: str) -> tuple[list[dict], list[bytes]]:
    """The slots of a block in order, and their digests."""
    slots = sorted(row["slots"], key=lambda s: s["slot"])
    return slots, [s[digest].hex().encode("ascii") for s in slots]


def _blocks(nodes: DataFrame, layout: Layout, name: str, *payload: str) -> DataFrame:
    """Keyed slot arrays: (_tree, _block, _total, slots) of nodes (_tree, _place, _total, payload)."""
    slot = F.col("_place").bitwiseAND(F.lit(layout.width - 1).cast("long")).cast("int").alias("slot")
    filled = nodes.select(
        "_tree", F.shiftright("_place", layout.width.bit_length() - 1).alias("_block"), "_total", F.struct(slot, *payload).alias("_slot")
    )
    return written(filled.groupBy("_tree", "_block", "_total").agg(F.collect_list("_slot").alias("slots")), name)


def _roots(blocks: DataFrame, layout: Layout, digest: str) -> DataFrame:
    """The nodes of the next step: (_tree, _place, _total, digest), one per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.select(["_total", "slots"]).to_pylist():
                _, digests = _slots(row, digest)
                found.append(bytes.fromhex(_levels(digests, row["_total"], layout)[-1][0].decode("ascii")))
            total = [-(-t // layout.width) for t in batch.column("_total").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_tree"), batch.column("_block"), pa.array(total, pa.int64()), pa.array(found, pa.binary())],
                names=["_tree", "_place", "_total", "digest"],
            )
        trim()

    pruned = F.transform("slots", lambda s: F.struct(s["slot"].alias("slot"), s[digest].alias(digest)))
    return blocks.select("_tree", "_block", "_total", pruned.alias("slots")).mapInArrow(
        run, "_tree string, _place long, _total long, digest binary"
    )


@dataclass
class Steps:
    """The steps of the trees of a forest, from the leaves up, and the last node of each tree."""

    blocks: list[DataFrame]
    #: _tree, _step, digest; None if there is no tree
    roots: DataFrame | None


def _reduced(nodes: DataFrame, layout: Layout, name: str, digest: str, *payload: str) -> Steps:
    """Steps until every tree has one node; the driver sees the largest number of nodes of a tree."""
    steps, ends, columns, at = [], [], (digest, *payload), 0
    while True:
        blocks = _blocks(nodes, layout, f"manifest-{name}-blocks", *columns)
        nodes = written(_roots(blocks, layout, columns[0]), f"manifest-{name}-nodes")
        largest = nodes.agg(F.max("_total")).first()[0]
        if largest is None:
            return Steps([], None)
        steps.append(blocks)
        ends.append(nodes.filter("_total = 1").select("_tree", F.lit(at).alias("_step"), "digest"))
        if largest == 1:
            break
        nodes, columns, at = nodes.filter("_total > 1"), ("digest",), at + 1
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return Steps(steps, found)


def _ordered(trees: DataFrame) -> DataFrame:
    """Trees as the leaves of one more tree, by name: a distributed sort, then counts per part."""
    parts = trees.repartitionByRange(F.col("_tree")).withColumn("_part", F.spark_partition_id())
    parts = written(parts, "manifest-trees")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row per partition of the sort
    counts = counts.select(
        "_part", _before([F.lit(0)], "_part").alias("_parts"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total")
    )
    place = F.col("_parts") + F.row_number().over(Window.partitionBy("_part").orderBy("_tree")) - 1
    found = parts.join(F.broadcast(counts), "_part").withColumn("_place", place)
    return found.select(F.lit("").alias("_tree"), "_place", "_total", "digest", F.col("_tree").alias("name"), "_step")


# -- proofs --------------------------------------------------------------------------
#
# A path is, level by level from a node up to the root, one byte for the node's slot in
# its run, one for the number of its siblings, and their digests of 32 bytes each.


#: what the leaves of the tree of groups carry
_PAYLOAD = {"digest": ("binary", pa.binary()), "name": ("string", pa.string()), "_step": ("int", pa.int32())}


def _path(levels: list[list[bytes]], at: int) -> bytes:
    """The path of a node within its block."""
    found = []
    for nodes in levels[:-1]:
        run, slot = nodes[at - at % FANOUT : at - at % FANOUT + FANOUT], at % FANOUT
        others = run[:slot] + run[slot + 1 :]
        found += [bytes((slot, len(others))), bytes.fromhex(b"".join(others).decode("ascii"))]
        at //= FANOUT
    return b"".join(found)


def _siblings(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Per level the hexadecimal digests before and after the node."""
    at = 0
    while at < len(path):
        slot, count = path[at], path[at + 1]
        others = path[at + 2 : at + 2 + 32 * count].hex().encode("ascii")
        yield others[: 64 * slot], others[64 * slot :]
        at += 2 + 32 * count


def _down(blocks: DataFrame, above: DataFrame, layout: Layout, digest: str, *payload: str) -> DataFrame:
    """(_tree, _place, path, subroot, root, payload) of the nodes of blocks, from the paths of the blocks' roots."""
    schema = "_tree string, _place long, path binary, subroot binary, root binary" + "".join(
        f", {p} {_PAYLOAD[p][0]}" for p in payload
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                slots, digests = _slots(row, digest)
                levels = _levels(digests, row["_total"], layout)
                size = len(slots)
                columns = [
                    pa.array([row["_tree"]] * size, pa.string()),
                    pa.array([row["_block"] * layout.width + i for i in range(size)], pa.int64()),
                    pa.array([_path(levels, i) + row["path"] for i in range(size)], pa.binary()),
                    pa.array([row["subroot"]] * size, pa.binary()), pa.array([row["root"]] * size, pa.binary()),
                    *[pa.array([s[p] for s in slots], _PAYLOAD[p][1]) for p in payload],
                ]
                names = ["_tree", "_place", "path", "subroot", "root", *payload]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        trim()

    return blocks.join(above, ["_tree", "_block"]).mapInArrow(run, schema)


def _above(paths: DataFrame) -> DataFrame:
    return paths.select("_tree", F.col("_place").alias("_block"), "path", "subroot", "root")


def _proven(batches: Iterator[pa.RecordBatch], layout: Layout, with_siblings: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of leaves with the paths of their roots: the proof of each leaf, and the root it leads to."""
    for batch in batches:
        for row in batch.to_pylist():
            slots, leaves = _slots(row, "leaf")
            levels = _levels(leaves, row["_total"], layout)
            upper = list(_siblings(row["path"]))
            above = b"".join(a + b for a, b in upper)
            root = row["root"].hex()
            # the siblings of each run's node and of all above it, from the top down
            tails = [above]
            for level in range(len(levels) - 2, 0, -1):
                nodes, found = levels[level], []
                for at in range(len(nodes)):
                    first = at - at % FANOUT
                    others = nodes[first:at] + nodes[at + 1 : first + FANOUT]
                    found.append(b"".join(others) + tails[at // FANOUT])
                tails = found
            proofs, folds, siblings = [], [], []
            for at, slot in enumerate(slots):
                own = slot["claimed"].hex().encode("ascii") if slot["claimed"] is not None else leaves[at]
                others, place = b"", at
                for level, nodes in enumerate(levels[:-1]):
                    first, end = place - place % FANOUT, place - place % FANOUT + FANOUT
                    before, after = b"".join(nodes[first:place]), b"".join(nodes[place + 1 : end])
                    if level == 0:
                        others = before + after
                    own = _digest(before + own + after)
                    place //= FANOUT
                for before, after in upper:
                    own = _digest(before + own + after)
                proof = others + (tails[at // FANOUT] if len(levels) > 1 else above)
                proofs.append(hashlib.sha256(proof).hexdigest())
                folds.append(own.decode("ascii"))
                if with_siblings:
                    text = proof.decode("ascii")
                    siblings.append([text[i : i + 64] for i in range(0, len(text), 64)])
            size = len(slots)
            columns = [
                pa.array([s["id"] for s in slots], pa.int64()),
                pa.array([leaf.decode("ascii") for leaf in leaves], pa.string()),
                pa.array([row["subroot"].hex()] * size, pa.string()), pa.array([root] * size, pa.string()),
                pa.array(proofs, pa.string()), pa.array(folds, pa.string()),
                pa.array([fold == root for fold in folds], pa.bool_()),
            ]
            names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            if with_siblings:
                columns.append(pa.array(siblings, pa.list_(pa.string())))
                names.append("siblings")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    trim()


# -- manifest ------------------------------------------------------------------------


@dataclass
class Manifest:
    """The trees of a dataset, kept as tables in the shared folder."""

    spark: SparkSession
    leaves: Steps
    trees: Steps | None
    id_column: str
    layout: Layout

    @property
    def root(self) -> str | None:
        """The dataset's digest; None for an empty one."""
        return self.trees.roots.first().digest.hex() if self.trees else None

    def groups(self) -> DataFrame:
        """(group, subroot): the digest of each group of rows."""
        empty = "group string, subroot string"
        if self.trees is None:
            return self.spark.createDataFrame([], empty)
        name = F.when(F.col("_tree") != "", F.expr("substring(_tree, 2)"))
        return self.leaves.roots.select(name.alias("group"), F.lower(F.hex("digest")).alias("subroot"))

    def proofs(self, siblings: bool = False) -> DataFrame:
        """One row per row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

        The proof of a leaf is its siblings, from its own level up to the root. folded_root
        is what the claimed leaf (the leaf itself, where nothing is claimed) and these
        siblings lead to. siblings: also their digests.
        """
        schema = (
            "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
            "verified boolean" + (", siblings array<string>" if siblings else "")
        )
        if self.trees is None:
            found = self.spark.createDataFrame([], schema)
            return found.withColumnRenamed("id", self.id_column)
        top = self.trees.roots.select(
            "_tree", F.lit(0).cast("long").alias("_place"), F.lit(b"").alias("path"),
            F.lit(b"").alias("subroot"), F.col("digest").alias("root"),
        )
        for at in range(len(self.trees.blocks) - 1, -1, -1):
            last = at == 0
            payload = ("digest", "name", "_step") if last else ()
            top = _down(self.trees.blocks[at], _above(top), self.layout, "digest", *payload)
        # a table of all groups: name, the step of their last node, their path
        tops = written(
            top.select(
                F.col("name").alias("_tree"), F.lit(0).cast("long").alias("_place"), "path",
                F.col("digest").alias("subroot"), "root", "_step",
            ),
            "manifest-tops",
        )
        columns = ["_tree", "_place", "path", "subroot", "root"]
        above = None
        for at in range(len(self.leaves.blocks) - 1, -1, -1):
            ending = tops.filter(F.col("_step") == at).select(*columns)
            above = ending if above is None else ending.unionByName(above)
            if at:
                below = _down(self.leaves.blocks[at], _above(above), self.layout, "digest")
                above = written(below.select(*columns), "manifest-paths")
        layout = self.layout
        joined = self.leaves.blocks[0].join(_above(above), ["_tree", "_block"])
        found = joined.mapInArrow(lambda batches: _proven(batches, layout, siblings), schema)
        return found.withColumnRenamed("id", self.id_column)


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), *,
    id_column: str = "doc_id", group_column: str = "source", claimed: dict[str, Column] | None = None,
    layout: Layout = Layout(),
) -> Manifest:
    """The manifest of a table: its leaves hash ``columns`` in this order.

    claimed: other values for some of the columns, as an untrusted copy of the rows has
    them; ``Manifest.proofs`` says which rows such a copy still proves.
    """
    spark = docs.sparkSession
    ship(spark)
    own = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_digest(own)
    other = F.lit(None).cast("string")
    if claimed:
        other = leaf_digest({**own, **claimed})
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit(""))
    leaves = docs.select(
        group.alias("_tree"), F.col(f"`{id_column}`").cast("long").alias("id"),
        F.unhex(leaf).alias("leaf"), F.unhex(other).alias("claimed"),
    )
    leaves = leaves.withColumn("claimed", F.when(F.col("claimed") != F.col("leaf"), F.col("claimed")))
    steps = _reduced(placed(written(leaves, "manifest-leaves"), layout), layout, "leaves", "leaf", "id", "claimed")
    trees = None
    if steps.roots is not None:
        trees = _reduced(_ordered(steps.roots), layout, "trees", "digest", "name", "_step")
    return Manifest(spark, steps, trees, id_column, layout)
