"""SentencePiece encoding and decoding, exact, by backtracking over longest matches.

A merge-type (BPE) model gives the same ids for a text as this search: a sequence of
pieces is the model's encoding if and only if each piece is the encoding of its own
text and each two neighbours are the encoding of theirs. So an Aho-Corasick automaton
finds the longest piece at every place; the search takes the longest one that goes
with its left neighbour (checked by merging the two texts again, remembered), tries
shorter ones where none fits, and steps back where all fail. The prefix up to a place
has one encoding, whatever follows, so a place that failed once has failed for good:
one bit per place is kept, and no place is searched twice.

Texts are cut before space marks, and between a letter and a punctuation mark, where the
model has no piece that reaches across; the pieces of a cut unit are remembered. Characters without a piece become the pieces of their bytes.

Defined results: a null text counts as empty; an empty text has the end id only (no
ids without an end); repeated rows are encoded like any others; an empty table gives
no rows. Texts are encoded whole, whatever their length. Only the id and text columns
are read, so other columns may have any names. Decoding ignores control ids; a null
list of ids decodes to an empty text; an id outside the vocabulary is an error.

The model file must be readable at the same path on every executor.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import lists, ranges, ship, slices, trim

#: units of text whose pieces a task remembers; it forgets all when there are more
CACHE_UNITS = 500_000
#: longer units are encoded anew each time
UNIT_CHARACTERS = 64
#: pairs of pieces whose check a worker remembers
CACHE_PAIRS = 500_000
SPACE_MARK = "▁"
NEVER = float("-inf")
#: marks before which a text may be cut, if the model allows it
MARKS = ".,;:!?"
# fixed values: kinds of pieces in a model file
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


# -- model files -------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 2: None, 5: 4}[key & 7]
        size = number() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """Pieces, scores and kinds of a model file; refuses what this encoder would get wrong."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer, normalizer = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL, **dict(_fields(value))}
                self.pieces.append(piece[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0])
                self.kinds.append(piece[3])
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        self.end_id = trainer.get(42, 2)
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode("utf-8")
        self.prefix = bool(normalizer.get(3, 1))
        wanted = {
            "a merge-type model": trainer.get(3, 1) == 2,
            "byte pieces": bool(trainer.get(35, 0)) and self.kinds.count(BYTE) == 256,
            "texts that are not normalized": not normalizer.get(2) and not normalizer.get(4, 1),
            "marked spaces": bool(normalizer.get(5, 1)) and not trainer.get(24, 0),
            "no user-defined or unused pieces": not {USER_DEFINED, UNUSED} & set(self.kinds),
        }
        missing = [name for name, there in wanted.items() if not there]
        if missing:
            raise ValueError(f"only models with {', '.join(missing)} are supported")


# -- encoding ----------------------------------------------------------------------


class Encoder(dict):
    """The ids of units of text, packed; the dictionary holds those that were asked for before."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        normal = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        self.ids = normal
        self.scores = {p: model.scores[i] for p, i in normal.items()}
        self.known = {p for p in normal if len(p) == 1}
        self.byte_ids = [0] * 256
        for i, kind in enumerate(model.kinds):
            if kind == BYTE:
                self.byte_ids[int(model.pieces[i][1:-1], 16)] = i
        self.length = [len(p) for p in model.pieces]
        #: the next shorter piece with which the text of a piece begins, -1 if there is none
        self.shorter = [-1] * len(model.pieces)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in normal.items():
            self.automaton.add_word(piece, i)
            self.shorter[i] = next((normal[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in normal), -1)
        self.automaton.make_automaton()
        # a text can be cut where no piece has these two characters side by side
        beside = {a + b for p in normal for a, b in itertools.pairwise(p)}
        letters = set(re.findall(r"[^\W\d_]", "".join(normal)))
        marks = "".join(m for m in MARKS if not any(c + m in beside for c in letters))
        if any(pair[1] == SPACE_MARK != pair[0] for pair in beside):
            self.units = re.compile("(?s).+")
        else:
            word = f"{SPACE_MARK}*[^\\W\\d_]+(?=[{SPACE_MARK}{marks}])"
            self.units = re.compile(f"{word}|{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")
        self.merged: dict[int, tuple] = {}
        self.fits: dict[int, bool] = {}

    def merges(self, piece: int) -> tuple[list[float], list[str], list[str], bool]:
        """How a piece's text is merged, alone: the best score first, the leftmost of equals.

        (scores of the merges, then -inf; the first part before each merge and at the
        end; the last part likewise; whether one part remains).
        """
        found = self.merged.get(piece)
        if found is None:
            parts = list(self.model.pieces[piece])
            scores, first, last = [], [parts[0]], [parts[-1]]
            while True:
                pairs = [self.scores.get(a + b, NEVER) for a, b in itertools.pairwise(parts)]
                best = max(pairs, default=NEVER)
                if best == NEVER:
                    break
                at = pairs.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                scores.append(best)
                first.append(parts[0])
                last.append(parts[-1])
            found = self.merged[piece] = (scores + [NEVER], first, last, len(parts) == 1)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Does merging the texts of two neighbours give these two again? Left is -1 at the start.

        The merges of both are replayed side by side, in the order they have in the
        joined text, until none is left or the parts at the border would merge.
        """
        if len(self.fits) > CACHE_PAIRS:
            self.fits.clear()
        scores, _, ends, whole = self.merges(left) if left >= 0 else ([NEVER], [""], [""], True)
        other_scores, starts, _, other_whole = self.merges(right)
        found, i, j = whole and other_whole, 0, 0
        while found and left >= 0:
            here, there = scores[i], other_scores[j]
            across = self.scores.get(ends[i] + starts[j], NEVER)
            if across > here and across >= there:
                found = False
            elif here == there == NEVER:
                break
            elif here >= there:
                i += 1
            else:
                j += 1
        self.fits[left * len(self.length) + right] = found
        return found

    def search(self, text: str) -> list[int]:
        """The ids of a text whose characters all have pieces."""
        size, length, shorter, pieces = len(text), self.length, self.shorter, len(self.length)
        longest = array("i", bytes(4 * size))
        for end, piece in self.automaton.iter(text):
            # matches come by their ends, so later ones with the same start are longer
            longest[end + 1 - length[piece]] = piece
        failed = bytearray((size >> 3) + 1)
        known = self.fits.get
        found: list[int] = []
        at, piece, left = 0, longest[0], -1
        while at < size:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = known(left * pieces + piece)
                    if fits or (fits is None and self.compatible(left, piece)):
                        break
                piece = shorter[piece]
            if piece >= 0:
                found.append(piece)
                at, left = end, piece
                if at < size:
                    piece = longest[at]
            elif found:
                failed[at >> 3] |= 1 << (at & 7)
                at -= length[left]
                piece = shorter[found.pop()]
                left = found[-1] if found else -1
            else:
                raise ValueError("no sequence of pieces fits")
        return found

    def __missing__(self, unit: str) -> bytes:
        if self.known.issuperset(unit):
            found = array("i", self.search(unit)).tobytes()
        else:
            found = b""
            for known, run in itertools.groupby(unit, self.known.__contains__):
                part = "".join(run)
                ids = self.search(part) if known else [self.byte_ids[b] for b in part.encode("utf-8")]
                found += array("i", ids).tobytes()
        if len(unit) <= UNIT_CHARACTERS:
            self[unit] = found
        return found

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if len(self) > CACHE_UNITS:
            self.clear()
        if not text:
            return b""
        marked = (" " + text if self.model.prefix else text).replace(" ", SPACE_MARK)
        return b"".join(map(self.__getitem__, self.units.findall(marked)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


# -- decoding ----------------------------------------------------------------------


class Decoder:
    """Texts of lists of ids."""

    def __init__(self, model: Model):
        self.model = model
        self.texts = []
        for piece, kind in zip(model.pieces, model.kinds):
            if kind == BYTE:
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            elif kind == CONTROL:
                self.texts.append(b"")
            elif kind == UNKNOWN:
                self.texts.append(model.unknown_text.encode("utf-8"))
            else:
                self.texts.append(piece.replace(SPACE_MARK, " ").encode("utf-8"))
        self.controls = {i for i, kind in enumerate(model.kinds) if kind == CONTROL}
        self.bytes = {i for i, kind in enumerate(model.kinds) if kind == BYTE}
        # the same as arrays
        self.pool = np.frombuffer(b"".join(self.texts), np.uint8)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.is_control = np.array([kind == CONTROL for kind in model.kinds])
        #: a byte that is no character alone
        self.is_part = np.array([kind == BYTE and t[0] > 127 for kind, t in zip(model.kinds, self.texts)])
        self.has_front = np.array(
            [model.prefix and kind == NORMAL and t[:1] == b" " for kind, t in zip(model.kinds, self.texts)]
        )

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of many lists of ids, each with control ids at its end only."""
        starts, lengths = self.starts[ids], self.lengths[ids]
        some = np.flatnonzero(np.diff(offsets) > 0)
        first = offsets[some]
        first = first[self.has_front[ids[first]]]
        starts[first] += 1
        lengths[first] -= 1
        data = self.pool[ranges(starts, lengths)]
        ends = np.r_[0, np.cumsum(lengths)][offsets]
        odd = np.zeros(len(offsets) - 1, bool)
        parts = np.flatnonzero(self.is_part[ids])
        for at in np.unique(np.searchsorted(offsets, parts, side="right") - 1).tolist():
            try:
                data[ends[at] : ends[at + 1]].tobytes().decode("utf-8")
            except UnicodeDecodeError:
                odd[at] = True
        # control ids between others part runs of bytes
        inner = np.flatnonzero(self.is_control[ids[:-1]] & ~self.is_control[ids[1:]]) + 1
        odd[np.searchsorted(offsets, inner[~np.isin(inner, offsets)], side="right") - 1] = True
        if odd.any():
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in itertools.pairwise(offsets)], pa.string())
        return pa.StringArray.from_buffers(
            len(odd), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
        )

    def decode(self, ids: list[int]) -> str:
        if ids and (min(ids) < 0 or max(ids) >= len(self.texts)):
            raise ValueError("an id outside the vocabulary")
        last = len(ids)
        while last and ids[last - 1] in self.controls:
            last -= 1
        ids = ids[:last]
        # a space that the encoder put in front goes; the first piece with a text has it, unless it is a byte
        first = next((n for n, i in enumerate(ids) if i not in self.controls), None)
        if first is None:
            return ""
        found = b"".join(map(self.texts.__getitem__, ids[first:]))
        front = self.model.prefix and self.model.kinds[ids[first]] == NORMAL and found[:1] == b" "
        if self.controls.isdisjoint(ids[first:]):
            try:
                return found[front:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        # runs of bytes that aren't text: each byte that begins no character is replaced
        parts = []
        for as_bytes, run in itertools.groupby(ids[first:], self.bytes.__contains__):
            joined = b"".join(map(self.texts.__getitem__, run))
            parts.append(_replaced(joined) if as_bytes else joined.decode("utf-8"))
        return "".join(parts)[front:]


def _replaced(data: bytes) -> str:
    """Bytes as text, with U+FFFD for each single byte that begins no character."""
    found, at = [], 0
    while at < len(data):
        for size in range(1, 5):
            try:
                found.append(data[at : at + size].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            found.append("�")
        at += size
    return "".join(found)


@functools.lru_cache(1)
def _tools(path: str) -> tuple[Encoder, Decoder]:
    with open(path, "rb") as file:
        model = Model(file.read())
    return Encoder(model), Decoder(model)


# -- Spark -------------------------------------------------------------------------


def encode(
    docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text",
    end: bool = True, round_trip: bool = False,
) -> DataFrame:
    """id_column and ``ids`` (list of int), one row per row of ``docs``.

    end: the model's end id comes last. round_trip: also ``decoded``, the text that the
    ids decode to, from the same pass.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    fields = [T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if round_trip:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(path)
        last = array("i", [encoder.model.end_id] if end else []).tobytes()
        for rows, _, _ in slices(batches):
            found = [encoder.packed(text or "") + last for text in rows.column("text").to_pylist()]
            ids = np.frombuffer(b"".join(found), np.int32)
            offsets = np.cumsum([0, *map(len, found)]) // 4
            columns = [rows.column("id"), lists(pa.array(ids), offsets)]
            if round_trip:
                columns.append(decoder.decode_all(ids, offsets))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        # the units of a task are not kept while its worker waits for another one
        encoder.clear()
        trim()

    picked = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return picked.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_column)


def decode(rows: DataFrame, path: str, *, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """id_column and ``decoded``, the text of the ids, one row per row."""
    ship(rows.sparkSession)
    fields = [T.StructField("id", rows.schema[id_column].dataType), T.StructField("decoded", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(path)
        for batch in batches:
            texts = [decoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "decoded"])
        trim()

    picked = rows.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{ids_column}`").cast("array<int>").alias("ids")
    )
    return picked.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_column)
