"""Runs of words against a search of every period at every place."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from maskflow.llm import periodic_runs, queries
from tests.llm.conftest import SF, TEXTS, clashing


def brute(words):
    """``(start, length, period)`` of all runs."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        k = 0
        while k + period < len(words):
            j = k
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j > k and j + period - k >= max(12, 2 * period):
                found.setdefault((k, j + period), period)
            k = max(j, k + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def draw():
    n, kinds = random.randint(0, 120), random.choice([1, 2, 2, 3, 5])
    words = [random.randrange(kinds) for _ in range(n)]
    for _ in range(random.randint(0, 4) if n else 0):
        a = random.randrange(n)
        p, end = random.randint(1, max(1, (n - a) // 2)), random.randint(a, n)
        for k in range(a, end):
            words[k] = words[a + (k - a) % p]
    return words


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 17])
def test_runs_in_blocks(monkeypatch, block):
    random.seed(block)
    monkeypatch.setattr(periodic_runs, "BLOCK", block)
    monkeypatch.setattr(periodic_runs, "LONG", 12)
    for _ in range(60):
        words = draw()
        assert [tuple(r) for r in periodic_runs.runs(words).tolist()] == brute(words)


def test_texts_that_defeat_rolling_hashes():
    words = [0]
    while len(words) < 4096:
        words += [1 - w for w in words]
    assert [tuple(r) for r in periodic_runs.runs(words[:2500]).tolist()] == brute(words[:2500])


def test_very_long_and_uniform_texts():
    begun = time.monotonic()
    assert periodic_runs.runs([b"a"] * 1_000_000).tolist() == [[0, 1_000_000, 1]]
    rng = np.random.default_rng(3)
    part = rng.integers(0, 1 << 40, 150_000).tolist()
    assert periodic_runs.runs(part * 3 + [0]).tolist() == [[0, 450_000, 150_000]]
    assert time.monotonic() - begun < 60


def expected(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = brute(words)
    gone = {k for a, length, p in runs for k in range(a + p, a + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha(listed), sha(kept))


def test_query_on_the_table(spark, documents):
    rows = {tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert rows == {expected(r.doc_id, r.text) for r in documents.collect()}


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "x " * 12), (3, "x " * 12), (4, "a b c\x1cd"), (None, "y\n" * 30)]
    out = periodic_runs.detect(spark, clashing(spark.createDataFrame(rows, TEXTS))).collect()
    got = sorted(((r.doc_id or 0, r.n_words, r.n_runs, r.length, r.text) for r in out))
    assert got == [(0, 30, 1, 30, "y"), (1, 0, 0, None, ""), (2, 0, 0, None, ""), (3, 12, 1, 12, "x"), (3, 12, 1, 12, "x"), (4, 2, 0, None, "a b c\x1cd")]
    assert periodic_runs.detect(spark, spark.createDataFrame([], TEXTS)).collect() == []
