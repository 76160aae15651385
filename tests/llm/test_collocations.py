"""Phrases against plain counting."""

import random
import re
from collections import Counter

from maskflow.llm import collocations, queries
from tests.llm.conftest import SF, clashing
from tests.oracle import assert_same, connect

ROWS = "doc_id long, text string, lang string"


def brute(rows, top=2000, least=10):
    counts = {}
    for _, text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            own.update(tuple(words[k : k + m]) for m in (1, 2, 3) for k in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in wanted.items():
            if any(p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in wanted.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def drawn():
    random.seed(9)
    words = ["a", "B", "b", "c", "New", "York", "é", "😀", "ẞ", "zz", " "]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "?", "\r\n"]
    rows = []
    for k in range(250):
        text = "".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(0, 40)))
        rows.append((k % 90, text, random.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, None, "en"), (1, "", None), (2, "new york city " * 12, "fr")]


def test_small_table(spark):
    rows = drawn()
    docs = clashing(spark.createDataFrame(rows, ROWS)).withColumnRenamed("a b", "f")
    assert {tuple(r) for r in collocations.mine(spark, docs).collect()} == brute(rows)
    few = collocations.mine(spark, docs, top=5)
    assert {tuple(r) for r in few.collect()} == brute(rows, top=5)


def test_flushes_buckets_and_common_prefixes(spark, monkeypatch):
    """Every stripe sent in many parts, every second word a common one, long texts in parts."""
    rows = drawn()
    monkeypatch.setattr(collocations, "HOT", 1 / 20)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 50)
    docs = spark.createDataFrame(rows, ROWS).repartition(6)
    assert {tuple(r) for r in collocations.mine(spark, docs).collect()} == brute(rows)


def test_long_texts_are_cut_between_pieces_only(monkeypatch):
    monkeypatch.setattr(collocations, "PIECE", 64)
    text = ("one two three four five, six seven eight.\n" * 30 + "no end " * 40).encode()
    parts = list(collocations._parts(text))
    assert b"".join(parts) == text and len(parts) > 10
    assert all(p[-1:] in b".,;:!?\n\x0b\x0c\r" for p in parts[:-1])


def test_exact_products(spark):
    """Products far above 64 bits."""
    from pyspark.sql import functions as F

    a, left, right = 3_000_000_019, 3_000_000_021, 3_000_000_077
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert frame.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_query_against_sql(spark):
    assert_same(queries.op11_phrase_collocations(spark, SF), connect(SF), queries.ORACLES["op11_phrase_collocations"])


def test_empty_table(spark):
    assert collocations.mine(spark, spark.createDataFrame([], ROWS)).collect() == []
    assert collocations.mine(spark, spark.createDataFrame([(1, "a b", "en")], ROWS)).collect() == []
