"""WARC archives compressed with Zstandard: a dictionary first, then one frame per record.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary,
itself plain or compressed, and each record is a frame of its own. Every writing
task trains the dictionary of a file on the first records that go into it and names
its files anew, and only files of tasks that succeeded get into the returned list,
so repeated tasks leave no record twice. Files go to a folder that all executors
reach, through the file systems that Arrow knows (file, hdfs, s3, gs ...).

Records with equal payloads (of at least ``least_bytes``) are written once: the one
with the smallest id as response, the others as revisit records that refer to it
and carry only the HTTP header with the length.

Defined results: a null payload counts as empty; a null URI is left out; a record
without id is never referred to while another one has an id; rows with equal ids and
payloads are all responses; an empty table gives no file and no records. Line breaks
in URIs are percent-encoded. Columns other than the three named are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from medallion.storage import work_folder

from .common import ship, written

SKIPPABLE, DICTIONARY, FRAME = 0x184D2A5D, 0xEC30A437, 0xFD2FB528
#: fixed values of the format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
FILE_BYTES = 64 << 20
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 2 << 20, 400, 32 << 10
READ_BYTES = 64 << 10
_SCHEMA = (
    "id string, record_type string, uri string, refers_to string, payload binary, "
    "payload_bytes bigint, payload_digest string, path string, error string"
)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# -- writing -----------------------------------------------------------------------


def _lines(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "\r\n".join([first, *[f"{k}: {v}" for k, v in fields], "", ""]).encode()


def record(
    kind: str, identity: str, date: str, block: bytes, content_type: str, more: list[tuple[str, str]] = ()
) -> bytes:
    """A WARC record as bytes."""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{identity}>"), ("WARC-Date", date), *more,
        ("Content-Type", content_type), ("Content-Length", str(len(block))),
    ]
    return _lines("WARC/1.1", fields) + block + b"\r\n\r\n"


def page_record(identity, uri, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response, or a revisit of the page it refers to."""
    more = [] if uri is None else [("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A"))]
    more.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    http = _lines(
        "HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    )
    kind, block = "response", http + payload
    if refers_to is not None:
        kind, block = "revisit", http
        more += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Truncated", "length"),
        ]
    name = "urn:page:" if identity is None else f"urn:page:{identity}"
    return record(kind, name, date, block, "application/http; msgtype=response", more)


class _Writer:
    """One archive file; the dictionary is trained when enough records wait or the file ends."""

    def __init__(self, folder: str):
        import zstandard

        self.zstandard, self.folder = zstandard, folder
        self.waiting: list[bytes] = []
        self.held, self.compressor, self.stream = 0, None, None
        self.path, self.bytes, self.records = None, 0, 0

    def _start(self) -> None:
        zstandard = self.zstandard
        self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
        files, place = _open(self.folder)
        files.create_dir(place, recursive=True)
        self.stream = files.open_output_stream(f"{place}/{self.path.rpartition('/')[2]}", compression=None)
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting, level=3)
        except zstandard.ZstdError:  # too few records to learn from
            dictionary = None
        if dictionary is not None:
            content = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
            self._put(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for one in self.waiting:
            self._put(self.compressor.compress(one))
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def add(self, one: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._put(self.compressor.compress(one))
            return
        self.waiting.append(one)
        self.held += len(one)
        if self.held >= SAMPLE_BYTES or len(self.waiting) >= SAMPLE_RECORDS:
            self._start()

    def close(self) -> tuple[str, int, int]:
        if self.compressor is None:
            self._start()
        self.stream.close()
        return self.path, self.records, self.bytes


def _archived(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, writer = [], None
        for rows in batches:
            columns = [rows.column(n) for n in ("id", "uri", "payload", "digest", "refers_to")]
            for i in range(rows.num_rows):
                if writer is None:
                    writer = _Writer(folder)
                    information = b"software: medallion\r\nformat: WARC File Format 1.1\r\n"
                    writer.add(
                        record("warcinfo", f"urn:uuid:{uuid.uuid4()}", date, information, "application/warc-fields")
                    )
                identity, uri, payload, digest, refers_to = (c[i].as_py() for c in columns)
                writer.add(page_record(identity, uri, payload, digest, refers_to, date))
                if writer.bytes >= file_bytes:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            paths, records, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "records", "bytes"],
            )

    return run


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    uri_column: str = "url",
    payload_column: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    least_bytes: int = 100,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per page; returns the files: path, records (with the leading warcinfo), bytes."""
    spark = pages.sparkSession
    ship(spark)
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(uri_column).cast("string").alias("uri"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    copies = (
        rows.filter(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    kept = rows.join(copies, F.col("digest") == F.col("_digest"), "left").select(
        F.col("id").cast("string").alias("id"), "uri", "payload", "digest",
        F.when(F.coalesce(F.col("first") != F.col("id"), F.col("first").isNotNull()), F.col("first"))
        .cast("string").alias("refers_to"),
    )
    target = folder or work_folder(spark, "warc")
    return written(
        kept.mapInArrow(_archived(target, date, file_bytes), "path string, records bigint, bytes bigint"),
        "warc-files",
    )


# -- reading -----------------------------------------------------------------------


def frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive; the dictionary is loaded from the leading frame."""
    import zstandard

    held = b""

    def more(size: int) -> bool:
        nonlocal held
        while len(held) < size:
            data = stream.read(max(READ_BYTES, size - len(held)))
            if not data:
                return False
            held += data
        return True

    reader, leading = zstandard.ZstdDecompressor(), True
    while more(1):
        if not more(4):
            raise ValueError("the file ends within a frame header")
        (magic,) = struct.unpack_from("<I", held)
        if magic & 0xFFFFFFF0 == SKIPPABLE & 0xFFFFFFF0:
            if not more(8):
                raise ValueError("the file ends within a skippable frame")
            (size,) = struct.unpack_from("<I", held, 4)
            if not more(8 + size):
                raise ValueError("the file ends within a skippable frame")
            content, held = held[8 : 8 + size], held[8 + size :]
            if leading and magic == SKIPPABLE:
                if content[:4] == struct.pack("<I", FRAME):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                if content[:4] != struct.pack("<I", DICTIONARY):
                    raise ValueError("the leading skippable frame holds no dictionary")
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            leading = False
            continue
        if magic != FRAME:
            raise ValueError(f"no frame starts with {magic:#x}")
        leading = False
        one, parts = reader.decompressobj(), []
        while not one.eof:
            if not more(1):
                raise ValueError("the file ends within a frame")
            parts.append(one.decompress(held))
            held = one.unused_data if one.eof else b""
        yield b"".join(parts)


def _fields(head: bytes, first: str) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"the record starts with {lines[0][:40]!r}")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:40]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def _number(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def parse(content: bytes) -> dict | None:
    """One record, validated: headers, lengths, and the digest of a response. Others than pages: None."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the record's header has no end")
    fields = _fields(head, "WARC/1.")
    missing = [n for n in MANDATORY if n.lower() not in fields]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    size = _number(fields)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {size}, the record has {len(rest) - 4}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the HTTP header has no end")
    length = _number(_fields(http, "HTTP/"))
    digest = fields.get("warc-payload-digest", "")
    if not digest.startswith("sha256:"):
        raise ValueError("no SHA-256 payload digest")
    digest = digest.removeprefix("sha256:")
    refers_to = fields.get("warc-refers-to")
    if kind == "response":
        if len(payload) != length:
            raise ValueError(f"the payload has {len(payload)} bytes, its header says {length}")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("the payload does not match its digest")
    elif payload or refers_to is None or fields.get("warc-profile") != REVISIT_PROFILE:
        raise ValueError("the revisit record is not one of an identical payload")

    def page(name: str | None):
        return (name or "").strip("<>").removeprefix("urn:page:") or None

    return {
        "id": page(fields["warc-record-id"]), "record_type": kind, "uri": fields.get("warc-target-uri"),
        "refers_to": page(refers_to), "payload": payload if kind == "response" else None,
        "payload_bytes": length, "payload_digest": digest,
    }


def _records(strict: bool):
    schema = pa.schema(
        [
            ("id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
            ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("path", pa.string()), ("error", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            batch = pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
            return batch

        for rows in batches:
            for path in rows.column("path").to_pylist():
                files, place = _open(path)
                with files.open_input_stream(place, compression=None) as stream:
                    content = frames(stream)
                    while True:
                        try:
                            one = next(content, None)
                            if one is None:
                                break
                            found = parse(one)
                        except Exception as error:
                            # what follows a damaged frame can't be found, a bad record is left alone
                            if strict:
                                raise ValueError(f"{path}: {error}") from error
                            found = {"error": str(error)}
                        if found is None:
                            continue
                        held.append(found | {"path": path})
                        size += found.get("payload_bytes") or 0
                        if size > 4 << 20 or len(held) >= 2000:
                            yield flush()
        if held:
            yield flush()

    return run


def read_archives(files: DataFrame, strict: bool = True) -> DataFrame:
    """The page records of archives (column ``path``), a task per few files.

    With ``strict`` a damaged record fails the job; otherwise it is a row with ``error``,
    and a file is read as far as its frames can be told apart.
    """
    spark: SparkSession = files.sparkSession
    ship(spark)
    number = files.count()
    return files.select("path").repartition(max(1, number)).mapInArrow(
        _records(strict), T.StructType.fromDDL(_SCHEMA)
    )
