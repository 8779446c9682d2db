from __future__ import annotations

import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from logscore.llm import token_store
from tests.llm.helpers import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_chunks_give_the_same_ids(library):
    rng = random.Random(1)
    texts = ["", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\n \n", "a\n \nb", "it's 's 't", "<|endoftext|> a", "a　 b"]
    texts += ["".join(rng.choice("ab's.,1   \n\t é") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    found = token_store.Encoder(PATH).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_units_that_were_forgotten_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(token_store, "KEPT_UNITS", 50)
    monkeypatch.setattr(token_store, "KEPT_BYTES", 8)
    monkeypatch.setattr(token_store, "_UNITS_AT_ONCE", 7)
    rng = random.Random(3)
    encoder = token_store.Encoder(PATH)
    letters = ["a", "b", "é", "ß", "中", "ﬁ", "\u0301", "1", "'s", ".", "?", "。", "\n", "\t", "\xa0", "\x85", "\u2003", "\x1c", "²", " "]
    for _ in range(20):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(100)]
        texts += ["long" * 30 + " " + "long" * 30 + ". x\n", "", None]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
        assert len(encoder.known) <= 50 and "long" * 30 not in encoder.known.units.to_pylist()
    assert encoder.encode([]) == []


def test_units_asked_for_again_are_kept():
    known = token_store.Units(6)
    units = pa.array(["a", "b", "c", "d"])
    known.add(units, np.array([1, 0, 2, 1]), np.array([5, 6, 7, 8], "<u4"))
    assert known.places(pa.array(["x", "c", "b"])).tolist() == [-1, 2, 1]
    known.add(pa.array(["e", "f", "g"]), np.array([1, 1, 1]), np.array([1, 2, 3], "<u4"))
    assert known.units.to_pylist() == ["b", "c"]
    assert known.sizes.tolist() == [0, 2] and known.ids.tolist() == [6, 7]


def test_words_take_no_python_call_each():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(20_000)]
    texts = pa.array([" ".join(words)])
    encoder, calls = token_store.Encoder(PATH), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        encoder.encode_column(texts)
    finally:
        sys.setprofile(None)
    assert calls < len(words) / 4


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(2)
    ids = np.unique(rng.integers(-(1 << 62), 1 << 62, 20_000))
    repeats = np.zeros(len(ids), dtype=np.int64)
    made = token_store.PerfectHash.build(ids, repeats)
    assert sorted(made.slots(ids, repeats)) == list(range(len(ids)))
    other = np.arange(50_000)
    slots = made.slots(other, np.zeros(len(other), dtype=np.int64))
    fingers = token_store._fingerprints(ids, repeats)
    stored = np.zeros(len(ids), dtype=np.uint32)
    stored[made.slots(ids, repeats)] = fingers
    hit = (slots >= 0) & (stored[slots] == token_store._fingerprints(other, np.zeros_like(other)))
    assert hit.sum() == 0
    with pytest.raises(ValueError):
        token_store.PerfectHash.build(np.array([5, 5]), np.array([0, 0]))


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_store(spark, library, monkeypatch, broadcast):
    monkeypatch.setattr(token_store, "BROADCAST_PLACES", broadcast)
    monkeypatch.setattr(token_store, "KEYS_PER_PART", 7)
    monkeypatch.setattr(token_store, "SHARD_BYTES", 60)
    texts = [(i * 3, f"text {i} " * (i % 5)) for i in range(40)]
    texts += [(None, "no id"), (None, None), (6, "again"), (6, ""), (500, "long " * 5000)]
    docs = documents(spark, texts, "1 AS start")
    store = token_store.write_store(docs, PATH)
    result = token_store.read_store(store, docs.select("doc_id")).collect()
    assert len(result) == len(texts)
    expected, start = [], 0
    for doc_id, text in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.append((doc_id, start, len(ids), crc))
        start += len(ids)
    assert sorted(map(tuple, result), key=lambda r: r[1]) == expected
    few = token_store.fetch(spark, store, [9, 500, 77777])
    assert {i: x.tolist() for i, x in few.items()} == {
        9: [*library.encode("text 3 " * 3).ids, 0], 500: [*library.encode("long " * 5000).ids, 0],
    }


def test_empty_table(spark):
    docs = documents(spark, []).where("false")
    store = token_store.write_store(docs, PATH)
    assert token_store.read_store(store, docs.select("doc_id")).collect() == []
