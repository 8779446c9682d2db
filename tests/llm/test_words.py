from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from logscore.llm import words
from tests.llm.helpers import ALNUM, SPACED, lower


def texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    letters = "abC9é日 \n\t\x0b.-"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    return ["", None, "a", *made, None, "end"]


@pytest.mark.parametrize(("kind", "pattern"), [(words.SPACED, SPACED), (words.ALNUM, ALNUM)])
def test_words_are_those_of_the_pattern(kind, pattern, monkeypatch):
    monkeypatch.setattr(words, "_CHUNK", 1 << 20)
    given = texts(1)
    found = words.words_of(pa.array(given), kind)
    expected = [pattern.findall(lower(text)) for text in given]
    assert np.diff(found.first).tolist() == [len(x) for x in expected]
    flat = [word.encode() for text in expected for word in text]
    assert found.text(0, len(flat)) == b" ".join(flat)
    by_word = dict(zip(flat, found.hashes.tolist(), strict=True))
    assert [by_word[word] for word in flat] == found.hashes.tolist()
    assert len(set(by_word.values())) == len(by_word)


def test_a_word_may_be_longer_than_a_chunk():
    long = "x" * (3 * words._CHUNK + 5)
    found = words.words_of(pa.array([f"a {long} b", long]), words.SPACED)
    assert found.first.tolist() == [0, 3, 4]
    assert found.hashes[1] == found.hashes[3]
    assert len(set(found.hashes.tolist())) == 3


def test_windows_stay_in_their_text():
    found = words.words_of(pa.array(["a b c", "d", "a b c d", None, "b c"]), words.SPACED)
    hashes, fits = found.window_hashes(3)
    assert np.flatnonzero(fits).tolist() == [0, 4, 5]
    assert hashes[0] == hashes[4] != hashes[5]
    assert len(found.window_hashes(99)[0]) == 0


def test_sliced_columns_and_runs():
    column = pa.array(["skip", "a b", None, "c"])[1:]
    assert np.diff(words.words_of(column, words.SPACED).first).tolist() == [2, 0, 1]
    batch = pa.RecordBatch.from_arrays([pa.array(["aaaa", "b", None, "cc", "d" * 9])], ["text"])
    sizes = [run.num_rows for run in words.runs(batch, "text", 5)]
    assert sizes == [3, 1, 1]


def test_hash_index():
    rng = np.random.default_rng(1)
    known = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    asked = np.concatenate([known[:20], rng.integers(0, 1 << 63, 5000).astype(np.uint64)])
    found = words.HashIndex(known).places(asked)
    assert found.tolist() == np.flatnonzero(np.isin(asked, known)).tolist()
    assert words.HashIndex(known[:0]).places(asked).tolist() == []
