import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import documents, frame

from medallion.llm.pieces import Decoder, Encoder, Model, decode, encode
from medallion.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return Model(file.read())


PARTS = [
    *" ab\n▁\t12", "  ", "é", "日", "☃", "😀", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "the", " the", "er", "ing",
    "---", "=====", "aaaa", "). ", "².", "a.b", "\r\n", " ", "ǲ", "in" * 9, " " * 20,
]


def test_ids_and_texts_equal_the_librarys(library, model):
    rng = random.Random(5)
    encoder, decoder = Encoder(model), Decoder(model)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(20)) for _ in range(500)]
    texts += ["".join(rng.choices("aeinorst", k=40)) for _ in range(1000)]
    expected = library.encode(texts)
    assert [encoder.encode(t) for t in texts] == expected
    assert [decoder.decode(ids) for ids in expected] == [library.decode(ids) for ids in expected]


def test_every_piece_alone_and_next_to_another(library, model):
    encoder = Encoder(model)
    rng = random.Random(6)
    pieces = [p for p, kind in zip(model.pieces, model.kinds) if kind == 1]
    texts = pieces + [a + b for a, b in zip(rng.sample(pieces, 4000), rng.sample(pieces, 4000))]
    assert [encoder.encode(t) for t in texts] == library.encode(texts)


def test_any_ids_decode_as_in_the_library(library, model):
    decoder = Decoder(model)
    rng = random.Random(7)
    special = [0, 1, 2, 13, 259, 28705, 3, 4, 200, 228, 132, 177, 233, 150, 130]
    lists = [
        [rng.choice(special) if rng.random() < 0.5 else rng.randrange(32000) for _ in range(rng.randrange(8))]
        for _ in range(5000)
    ]
    expected = [library.decode(ids) for ids in lists]
    assert [decoder.decode(ids) for ids in lists] == expected
    for at in range(0, len(lists), 3):
        some = lists[at : at + 3]
        flat = np.array([i for ids in some for i in ids], np.int64)
        found = decoder.decode_all(flat, np.cumsum([0, *map(len, some)]))
        assert found.to_pylist() == expected[at : at + 3], some
    with pytest.raises(ValueError):
        decoder.decode([32000])


def test_units_are_forgotten_and_found_again(library, model, monkeypatch):
    monkeypatch.setattr("medallion.llm.pieces.CACHE_UNITS", 3)
    monkeypatch.setattr("medallion.llm.pieces.CACHE_PAIRS", 5)
    encoder = Encoder(model)
    texts = ["one two three four five", "six seven one two", "one two three four five"] * 3
    assert [encoder.encode(t) for t in texts] == library.encode(texts)


def test_other_models_are_refused(model):
    with open(PATH, "rb") as file:
        data = file.read()
    # the same model as a unigram model, by the trainer's field for the kind of model
    assert data.count(b"\x18\x02\x20\x80\xfa\x01") == 1
    with pytest.raises(ValueError, match="merge-type"):
        Model(data.replace(b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01"))


def test_documents(spark, library):
    rows = documents() + [(900, "".join(f"{i}x" for i in range(60_000)), "en"), (901, " " * 5000, None)]
    found = encode(frame(spark, rows), PATH, round_trip=True)
    assert found.columns == ["doc_id", "ids", "decoded"]
    expected = [
        (i, library.encode(t or "", add_eos=True), library.decode(library.encode(t or "", add_eos=True)))
        for i, t, _ in rows
    ]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    without = encode(frame(spark, rows), PATH, end=False)
    assert sorted(len(r.ids) for r in without.collect()) == sorted(len(ids) - 1 for _, ids, _ in expected)
    again = decode(found.select("doc_id", "ids"), PATH)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(((i, t) for i, _, t in expected), key=repr)


def test_columns_named_as_the_results(spark):
    rows = [(1, "one two", "x"), (2, None, "y")]
    docs = spark.createDataFrame(rows, "decoded long, ids string, id string")
    found = encode(docs.withColumn("text", docs.ids), PATH, id_column="id", text_column="ids")
    assert {r.id: len(r.ids) for r in found.collect()} == {"x": 3, "y": 1}


def test_empty_tables_and_lists(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode(docs, PATH, round_trip=True).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [2])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(lists, PATH).collect()} == {1: "", 2: "", 3: ""}


def test_query_against_the_library(spark, library, tmp_path):
    rows = documents(seed=11)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op12_sentencepiece"](spark, str(tmp_path)).collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_eos=True)
        expected.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
