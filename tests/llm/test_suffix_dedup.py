import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from maskflow.llm import suffix_dedup
from maskflow.llm.run_index import RunIndex
from maskflow.llm.suffix_dedup import remove_repeats
from tests.llm.conftest import TEXTS, clashing


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = Counter()
    for (doc, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def check(spark, rows, length=200):
    df = clashing(spark.createDataFrame(rows, TEXTS))
    found = remove_repeats(spark, df, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == brute(rows, length)


def test_documents_against_all_windows(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.limit(120).collect()]
    check(spark, rows)
    check(spark, rows[:40], 50)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, ""), (None, "x" * 500), (3, "q" * 199), (4, "ü" * 150)],
        [(3, "ab" * 300), (3, "ab" * 300), (3, "c" + "ab" * 100)],
        [(1, "".join(map(str, range(400)))), (2, "-" + "".join(map(str, range(400))) + "-")],
    ],
)
def test_odd_rows(spark, rows):
    check(spark, rows)


def test_a_long_text_is_cut_into_overlapping_parts(spark, monkeypatch):
    g = random.Random(1)
    text = "".join(g.choice("abcdefgh ") for _ in range(9_000))
    monkeypatch.setattr(suffix_dedup, "PIECE", 1_000)
    check(spark, [(1, text), (2, text[2_900:4_700]), (3, "z" + text[7_000:7_300])])


def test_one_passage_with_different_neighbours(spark, monkeypatch):
    """An anchor with more contexts than an index may hold."""
    monkeypatch.setattr(suffix_dedup, "INDEX_CONTEXTS", 4)
    g = random.Random(5)
    passage = "".join(g.choice("abcdefghij ") for _ in range(260))
    text = lambda: "".join(g.choice("uvwxyz ") for _ in range(g.randint(0, 300)))
    check(spark, [(i, text() + passage + text()) for i in range(40)])


def test_two_thousand_contexts_of_one_anchor(spark):
    """More contexts than an index holds, at its real size; only marks and blocks leave it."""
    g = random.Random(8)
    draw = lambda n, kinds: "".join(g.choice(kinds) for _ in range(n))
    passage = draw(230, "abcdefghij ")
    cut = lambda: passage[g.randint(0, 20) : 230 - g.randint(0, 20)]
    check(spark, [(i, draw(g.randint(0, 90), "uvwxyz ") + cut() + draw(g.randint(0, 90), "uvwxyz ")) for i in range(2_000)])


def test_run_index_against_counting():
    g = random.Random(3)
    for _ in range(150):
        strings = []
        for _ in range(g.randint(1, 10)):
            s = "".join(g.choice(g.choice(["ab", "a", "abcd"])) for _ in range(g.randint(0, 40)))
            if strings and g.random() < 0.5:
                s = s[:5] + g.choice(strings).decode()[3:] + s[5:9]
            strings.append(s.encode())
        length = g.choice([2, 5, 20])
        index = RunIndex(strings)
        marks = index.repeated(length)
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        for s, at in zip(strings, index.starts):
            expected = [i + length <= len(s) and seen[s[i : i + length]] > 1 for i in range(len(s))]
            assert marks[at : at + len(s)].tolist() == expected
        assert int(index.run_lengths.sum()) == index.n
        assert not np.any(index.run_chars[1:] == index.run_chars[:-1])
