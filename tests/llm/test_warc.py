import hashlib
import random
import struct

import pytest
import zstandard

from medallion.llm import warc

SCHEMA = "page_id long, url string, html string, id string, payload string, digest int, path string"


def pages():
    rng = random.Random(2)
    bodies = [None, "", "x" * 99, "x" * 100, "é" * 50, "long " * 40_000]
    bodies += [f"<p>{rng.random()} {'text ' * rng.randrange(200)}</p>" for _ in range(60)]
    rows = [(i, f"http://a.org/{i}\r\nX: y", b) for i, b in enumerate(bodies)]
    rows += [(200 + i, None, bodies[i % 7]) for i in range(40)]
    rows += [(3, "http://again", "x" * 100), (None, "http://none", "x" * 100), (None, "http://none", "alone " * 30)]
    rng.shuffle(rows)
    return rows


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA).repartition(parts)


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in data:
        refers = first.get(b) if len(b) >= 100 and first.get(b) not in (None, i) else None
        refers = None if refers is None else str(refers)
        out.append((None if i is None else str(i), len(b), hashlib.sha256(b).hexdigest(),
                    "response" if refers is None else "revisit", refers, b if refers is None else None))
    return sorted(out, key=repr)


def got(found):
    return sorted(
        (
            (r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
            for r in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("file_bytes", [200, 64 << 20])
def test_round_trip(spark, tmp_path, file_bytes):
    rows = pages()
    files = warc.write_archives(table(spark, rows), f"file://{tmp_path}/archives", file_bytes=file_bytes)
    found = warc.read_archives(files).collect()
    assert got(found) == expected(rows)
    assert all(r.error is None for r in found)
    assert {r.uri for r in found if r.id == "5"} == {"http://a.org/5%0D%0AX: y"}
    listed = files.collect()
    assert sum(r.records for r in listed) == len(rows) + len(listed)  # a warcinfo record each
    assert sorted(p.name for p in (tmp_path / "archives").iterdir()) == sorted(r.path.rpartition("/")[2] for r in listed)


def test_empty_table(spark):
    files = warc.write_archives(table(spark, [(1, "u", "x")]).filter("false"))
    assert files.count() == 0
    assert warc.read_archives(files).collect() == []


def archive(tmp_path, rows, plain_dictionary=False):
    """An archive written here, byte by byte, not by the operator."""
    records = [
        warc.page_record(i, "http://x", b, hashlib.sha256(b).hexdigest(), None, "2024-01-01T00:00:00Z") for i, b in rows
    ]
    dictionary = zstandard.train_dictionary(4096, [r + bytes([n % 256]) * 9 for n, r in enumerate(records * 40)])
    content = dictionary.as_bytes()
    if not plain_dictionary:
        content = zstandard.ZstdCompressor().compress(content)
    data = struct.pack("<II", 0x184D2A5D, len(content)) + content
    places = []
    for r in records:
        places.append(len(data))
        data += zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True).compress(r)
    path = tmp_path / "one.warc.zst"
    path.write_bytes(data)
    return path, places, data


@pytest.mark.parametrize("plain", [False, True])
def test_dictionary_of_the_leading_frame(spark, tmp_path, plain):
    rows = [(n, f"payload {n} ".encode() * 20) for n in range(30)]
    path, _, data = archive(tmp_path, rows, plain)
    path.write_bytes(data + struct.pack("<II", 0x184D2A50, 3) + b"end")  # other skippable frames are passed over
    files = spark.createDataFrame([(str(path),)], "path string")
    found = warc.read_archives(files).collect()
    assert sorted((int(r.id), bytes(r.payload)) for r in found) == rows
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[archive(tmp_path, rows, plain)[1][0] :])


def test_damage_is_reported(spark, tmp_path):
    rows = [(n, f"payload {n} ".encode() * 20) for n in range(5)]
    path, places, data = archive(tmp_path, rows)
    path.write_bytes(data[: places[4] + 20])
    files = spark.createDataFrame([(str(path),)], "path string")
    found = warc.read_archives(files, strict=False).collect()
    assert sorted(int(r.id) for r in found if r.id) == [0, 1, 2, 3]
    assert [r.error for r in found if r.error] == ["the file ends within a frame"]
    with pytest.raises(Exception, match="the file ends within a frame"):
        warc.read_archives(files).collect()


def test_records_are_validated():
    body = b"some payload"
    good = warc.page_record(7, "http://x", body, hashlib.sha256(body).hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse(good)["payload"] == body
    revisit = warc.page_record(8, None, body, hashlib.sha256(body).hexdigest(), 7, "2024-01-01T00:00:00Z")
    found = warc.parse(revisit)
    assert (found["payload"], found["payload_bytes"], found["refers_to"]) == (None, len(body), "7")
    assert warc.parse(warc.record("warcinfo", "urn:x", "d", b"a: b\r\n", "application/warc-fields")) is None
    for old, new in [
        (b"WARC/1.1", b"HTTP/1.1"), (b"WARC-Date", b"WARC-Dote"), (b"some payload", b"some pa1load"),
        (b"some payload", b"some"), (b"Content-Length: 12\r\n", b"Content-Length: -1\r\n"),
        (b"\r\n\r\n", b"\n\n"), (b"sha256:", b"sha1:"), (b"payload\r\n\r\n", b"payload\r\n"),
    ]:
        with pytest.raises(ValueError):
            warc.parse(good.replace(old, new))


def test_files_are_plain_archives(spark, tmp_path):
    """Read with nothing but the Zstandard library, as any other reader would."""
    rows = [(n, f"http://x/{n}", f"<p>{'some text ' * (n % 50)}{n}</p>") for n in range(600)]
    files = warc.write_archives(table(spark, rows, 1), f"file://{tmp_path}/archives").collect()
    data = (tmp_path / "archives" / files[0].path.rpartition("/")[2]).read_bytes()
    assert len(data) == files[0].bytes
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(data[8 : 8 + size]))
    assert dictionary.dict_id()
    rest, records = data[8 + size :], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        records.append(one.decompress(rest))
        rest = one.unused_data
    assert len(records) == 601
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    assert sorted(r.rpartition(b"<p>")[2] for r in records[1:]) == sorted(h[3:].encode() + b"\r\n\r\n" for *_, h in rows)
