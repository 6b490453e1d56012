"""Helpers shared by the operators: code on the executors, work tables, text arrays.

Texts are handled in slices of Arrow batches. A slice is one byte array with the
offsets of its documents, so words, n-grams and hashes of all documents of a
slice come from a few array operations instead of a loop over characters.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import sys
import tempfile
import time
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from medallion.storage import work_folder

#: bytes of text that are handled at once; a longer document is a slice of its own
SLICE_BYTES = 1 << 19
#: bytes of an Arrow batch
ARROW_BYTES = 4 << 20
#: characters of a plan's description that the driver keeps
PLAN_CHARACTERS = 20_000
MASK = (1 << 64) - 1
_SHIPPED: set[str] = set()


# -- Spark ---------------------------------------------------------------------


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Arrow batches of the session get smaller: texts are handled in slices, and what
    else a batch holds would wait in the memory of both the executor and its Python.
    Descriptions of plans get shorter, which long jobs would fill the driver with.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(limit, str(ARROW_BYTES)))) > ARROW_BYTES:
        spark.conf.set(limit, str(ARROW_BYTES))
    # the driver keeps a description of every plan and of each of its adaptive versions
    if int(re.sub(r"\D", "", spark.conf.get("spark.sql.maxPlanStringLength"))) > PLAN_CHARACTERS:
        spark.conf.set("spark.sql.maxPlanStringLength", str(PLAN_CHARACTERS))
    context: SparkContext = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="medallion-code-"), "medallion_code.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    target.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def written(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """The rows of a DataFrame, computed once and kept as a table in the shared folder.

    release: for writes with large shuffles. Spark deletes their files once the driver's
    garbage collector finds that nothing refers to them, which an idle driver may not
    do for long; the files of all steps would add up on the executors' disks. So it is
    asked to look, twice, because references go in turn.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    for _ in range(2 if release else 0):
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


# -- slices of Arrow batches -----------------------------------------------------


def as_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts without nulls (null counts as empty), with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = pa.large_string() if pa.types.is_string(column.type) else pa.large_binary()
        column = column.cast(kind)
    empty = "" if pa.types.is_large_string(column.type) else b""
    return pc.fill_null(column, pa.scalar(empty, column.type))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of texts; document i is bytes[offsets[i]:offsets[i + 1]]."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of slices of about ``limit`` bytes of text."""
    for batch in batches:
        texts = as_text(batch.column(column))
        _, offsets = raw(texts)
        at = 0
        while at < len(texts):
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), len(texts))
            part = texts.slice(at, end - at)
            yield (batch.slice(at, end - at), *raw(part))
            at = end
    trim()


def trim() -> None:
    """Give free memory back to the system: Spark keeps Python workers, also idle ones."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
            ctypes.CDLL(None).malloc_trim(0)


def one_batch(table: pa.Table) -> pa.RecordBatch:
    """The rows of a group in one batch."""
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in table.columns],
        names=table.column_names,
    )


# -- hashes ------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = np.full((2, size), 1, np.uint64)
            self.up[1:], self.down[1:] = self.base, self.inverse
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _CONTENT = (
    Powers(0x9E3779B97F4A7C15), Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F),
)
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_values(fold_case: bool = False) -> np.ndarray:
    """A random 64-bit value per byte; with fold_case A-Z have those of a-z."""
    values = _BYTE_VALUES.copy()
    if fold_case:
        values[65:91] = values[97:123]
    return values


class Sums:
    """Hashes of any ranges of a sequence of 64-bit values.

    sum(value[i] * base^i) modulo 2^64 over a range, divided by base^start, does
    not depend on where the range starts; prefix sums give it for all ranges.
    """

    def __init__(self, values: np.ndarray, powers: Powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all ranges of a size, one per start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[:n] + np.uint64(size))


def byte_sums(data: np.ndarray, fold_case: bool = False) -> Sums:
    return Sums(byte_values(fold_case)[data], _BYTES)


def word_sums(words: np.ndarray) -> Sums:
    """Sums over word hashes."""
    return Sums(words, _WORDS)


def content_sums(symbols: np.ndarray) -> Sums:
    """Sums with other powers, for hashes that don't depend on those of grams."""
    return Sums(symbols, _CONTENT)


# -- words -------------------------------------------------------------------------

#: bytes between words: space and \t \n \v \f \r
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of the documents of a slice: byte ranges, hashes, and each document's range of words."""

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, fold_case: bool = False
    ):
        self.data, self.offsets = data, offsets
        gap = np.ones(len(data) + 1, bool)
        np.take(space, data, out=gap[:-1])
        inner = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
        begins = ~gap[:-1]
        begins[1:] &= gap[:-2]
        begins[inner] = ~gap[inner]
        ends = ~gap[:-1]
        ends &= gap[1:]
        ends[inner - 1] = ~gap[inner - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: words of document i: range(first[i], first[i + 1])
        self.first = np.searchsorted(self.starts, offsets)
        self.first[-1] = len(self.starts)
        self.fold_case = fold_case

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return byte_sums(self.data, self.fold_case).hashes(self.starts, self.ends)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window of a width (van Herk's two passes)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    if width == 1:
        return values
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values: pieces of a byte array."""
    return pa.Array.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(values.tobytes())],
    )


#: low bits of a scrambled hash that are replaced by its place when a minimum is searched
_PLACE_BITS = 28
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


def window_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: per window of ``width`` hashes the place of the least one, the leftmost of equals.

    Two windows with equal content have their anchors at the same offset. Only the
    high bits of the hashes are compared, which is a function of the content too.
    """
    most = 1 << _PLACE_BITS
    if len(grams) > most:
        # places are counted anew in parts, which overlap by the windows that reach across
        step = most - width + 1
        starts = range(0, len(grams) - width + 1, step)
        return np.concatenate([window_anchors(grams[a : a + most], width) + a for a in starts])
    packed = grams & ~_PLACE
    packed |= np.arange(len(grams), dtype=np.uint64)
    return (sliding_min(packed, width) & _PLACE).astype(np.int64)


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """A list per row from flat values."""
    return pa.ListArray.from_arrays(pa.array(np.ascontiguousarray(offsets, np.int32)), values)
