from __future__ import annotations

import random
from collections import Counter

import numpy as np

from logscore.llm import quality
from tests.llm.helpers import SPACED, documents, rows_of


def brute_counts(text: str | None) -> tuple:
    text = text or ""
    w = SPACED.findall(text)
    windows = list(zip(w, w[1:], w[2:], strict=False))
    times = Counter(windows)
    again = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed)


def text(rng: random.Random, words: int, mark: str = "", letters: int = 5) -> str:
    made = []
    for i in range(words):
        made.append("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 2 * letters))) + mark)
        made.append("\n" if i % 9 == 8 else " ")
    return "".join(made)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a a a", "a a a a", "a b c a b c", "x\x0by\x0cz", "a|b <c> #1\n\na|b <c> #1"]
    texts += ["a b\n" * 30, "word " * 4000, text(rng, 60, "*"), text(rng, 300), "\xa0 é　é"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(150)]
    counted = quality.text_counts(documents(spark, texts, "1 AS words"))
    found = {r[0]: tuple(r[1:]) for r in counted.select("doc_id", *NAMES).collect()}
    assert found == {i: brute_counts(t) for i, t in enumerate(texts)}


def brute_outliers(x: np.ndarray) -> np.ndarray:
    """Squared distances from the estimate, in numpy."""
    floor = np.diag([(quality.UNIT * t) ** 2 for t in quality.TOLERANCES])

    def middle(values: np.ndarray, share: float) -> np.ndarray:
        ordered = np.sort(values, axis=0)
        return ordered[max(int(np.ceil(share * len(values))) - 1, 0)]

    centre = middle(x, 0.5)
    spread = middle(np.abs(x - centre), 0.5)
    best = None
    for start in (0, 1):
        mean, cov = centre, np.diag(2.1981 * spread**2) + floor
        for step in range(quality.STEPS):
            y = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
            d = (y**2).sum(0) if step or start == 0 else 4 * (np.abs(y).max(0)) ** 2
            d = np.floor(64 * np.log2(1 + d))
            inner = x[d <= middle(d, quality.CENTRAL)]
            mean = inner.mean(0)
            cov = quality.CONSISTENCY * np.cov(inner.T, bias=True) + floor
        size = np.linalg.slogdet(cov)[1]
        if best is None or size < best[0] - 1e-9:
            best = (size, mean, cov)
    y = np.linalg.solve(np.linalg.cholesky(best[2]), (x - best[1]).T)
    return (y**2).sum(0)


def sample(seed: int) -> list:
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        kind = rng.random()
        mark, letters = ("$$", 5) if kind < 0.15 else ("", 14) if kind < 0.25 else ("", 5)
        lang = "en" if i % 3 else "de"
        rows.append((i, text(rng, rng.randint(50, 200), mark, letters), lang, "hot" if i < 320 else f"s{i % 7}"))
    return rows


def test_verdicts_against_numpy(spark):
    rows = sample(2)
    docs = documents(spark, rows, "0 AS g")
    found = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    groups: dict = {}
    counts = Counter((lang, source) for _, _, lang, source in rows)
    for doc_id, t, lang, source in rows:
        n, chars, symbols, dup, again, failed = brute_counts(t)
        assert not failed
        lines = len([x for x in t.split("\n") if x.strip()])
        x = (np.log2(chars / n), np.sqrt(symbols / chars), dup / lines, again / n)
        big = counts[lang, source] >= quality.LEAST_ROWS
        groups.setdefault((lang, source) if big else (lang,), []).append((doc_id, x))
    small = [g for g in groups if len(g) == 1 and len(groups[g]) < quality.LEAST_ROWS]
    rest = [x for g in small for x in groups.pop(g)]
    checked = 0
    for members in groups.values():
        values = np.floor(quality.UNIT * np.array([x for _, x in members]) + 0.5)
        for (doc_id, _), d in zip(members, brute_outliers(values), strict=True):
            if abs(d - quality.CUT) > 1e-6:
                assert found[doc_id].kept == (d <= quality.CUT), doc_id
                checked += 1
    assert checked > 250
    assert all(found[doc_id].kept for doc_id, _ in rest) or len(rest) >= quality.LEAST_ROWS
    rejected = [i for i, r in found.items() if not r.kept]
    assert rejected and all("$$" in rows[i][1] or found[i].word_chars / found[i].n_words > 10 for i in rejected)
    good = quality.good_rows(docs)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {i for i, r in found.items() if r.kept}


def test_nulls_small_groups_and_repeats(spark):
    rng = random.Random(3)
    long = text(rng, 80)
    rows = [(1, long, None, None), (1, long, None, None), (None, long, "en", None), (2, None, None, "a"), (3, "", "en", "a")]
    docs = documents(spark, rows)
    assert rows_of(quality.verdicts(docs), "doc_id", "kept") == sorted(
        [(1, True), (1, True), (None, True), (2, False), (3, False)], key=repr
    )
    assert rows_of(quality.good_rows(docs), "doc_id") == [(1,), (1,), (None,)]
    assert quality.verdicts(docs.where("false")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = quality.text_counts(documents(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowConv", "")
