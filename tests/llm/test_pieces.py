from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from logscore.llm import pieces
from tests.llm.helpers import documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    ranges = [(32, 126), (160, 1500), (0x4E00, 0x9000), (0x1F300, 0x1F600)]
    made = ["".join(rng.choice("abehinort  ▁.,\n-=") for _ in range(rng.randint(1, 80))) for _ in range(800)]
    for _ in range(300):
        made.append("".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 40))))
    fixed = ["", "a", " a", "a ", "  a   b\n\t c", " " * 15 + "x", " " * 40, "a" * 3000, "ab" * 3000, "<s> </s> <0x41>", "\0a\0 b"]
    return fixed + made


def test_same_ids_as_the_library(library):
    model, texts = pieces.PieceModel(PATH), odd_texts(1)
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), text
        assert model.decode(ids) == library.decode(ids.tolist()), text


def test_small_batches_and_a_full_table(library, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_CHARS", 50)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 1 << 4)
    model = pieces.PieceModel(PATH)
    for text in ["the quick brown fox " * 3, "jumps over " * 9, "x" * 200, ""]:
        assert model.encode([text])[0].tolist() == library.encode(text)


def test_more_characters_than_16_bits(library):
    """One word of nearly all characters there are; most are in no piece."""
    chars = [c for c in range(0x21, 0x2FFFF) if not 0xD800 <= c <= 0xDFFF and c != ord(pieces.SPACE)]
    text = "".join(map(chr, chars[:80_000])) + "hello"
    assert len(set(text)) > 66_000
    assert pieces.PieceModel(PATH).encode([text])[0].tolist() == library.encode(text)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "aB3/+xyzé日本\U0001f600"])
def test_long_word(library, letters):
    """A word without a space falls into parts, so that it does not take a step for each character."""
    rng = random.Random(3)
    text = "".join(rng.choice(letters) for _ in range(100_000))
    model = pieces.PieceModel(PATH)
    start = time.perf_counter()
    assert model.encode([text, "a", text[:50]])[0].tolist() == library.encode(text)
    assert time.perf_counter() - start < 5


def test_documents(spark, library):
    texts = ["Hello world", None, "", "日本 x", "Hello world"]
    docs = documents(spark, texts, "1 AS ids")
    encoded = pieces.encode_documents(docs, PATH)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids == {i: library.encode(t or "") for i, t in enumerate(texts)}
    decoded = {r.doc_id: r.text for r in pieces.decode_documents(encoded, PATH).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(texts)}
    for r in pieces.round_trip(docs, PATH).collect():
        expected = np.array(ids[r.doc_id], "<u4")
        assert (r.n_pieces, r.ids_crc32, r.same) == (len(expected), zlib.crc32(expected.tobytes()), True)
    assert pieces.encode_documents(docs.where("false"), PATH).collect() == []
