"""Periodic runs of words, by online dyadic square catching.

Words are appended block after block. For periods ``p`` in ``[2**j, 2**(j+1))`` a catcher
stands at every completed multiple of ``2**j``. Every square of such a period has a
catcher at most ``p`` words behind its start, and at that place the word stretches that
lie ``p`` apart agree over ``p`` words, to the left and to the right together. So one of
the catcher's two windows of half that size agrees, and this is what appended words are
compared for: the window that ends at the catcher as soon as the word ``p`` behind it is
there, and the window that begins at it as soon as its copy is. A catcher that
fires is widened by suffix and prefix comparisons to the stretch of that period. A
stretch that reaches the last word known stays open and grows with the next block.
Stretches that several catchers report are merged, and of those between equal borders the
one of smallest period is the run. Periods below 8 share catchers four words apart.

Windows are compared by names: the name of ``2**k`` words is a 64-bit mix of those of its
halves, so that unequal words have equal names with a chance of about 2**-64 only, also in
texts made to defeat rolling hashes. Work is about 28 comparisons a word at most ``log n``
levels, in numpy for all catchers of a level at once; several short texts are appended to
one row of words with a mark of its own behind each, so nothing is found across texts.

Defined cases: null and empty texts have no words and no run. A row without an id is read as
it stands. Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import lean_batches
from maskflow.llm.words import mix

#: A run has at least so many words, and at least two periods.
LEAST = 12
#: Words appended at once. It bounds temporary memory and changes no result.
BLOCK = 1 << 17
#: Names go up to 2**TOP words; longer stretches are compared in steps of that size.
TOP = 12
#: Pairs of places compared at once.
PAIRS = 1 << 20
#: Of more catches at once, each so-manieth is widened first.
SOME = 64
#: Runs of at least so many words and four periods are marked, so that they are widened once.
LONG = 64
#: Periods below this share catchers ``NEAR`` words apart, with windows of three words.
SMALL, NEAR = 8, 4


class Catchers:
    """The runs of one row of words that arrives in blocks."""

    def __init__(self, longest: int | None = None):
        #: No period above half of this is looked for; None: no bound.
        self.longest = longest
        self.n = 0
        self.names = [np.zeros(0, np.uint64) for _ in range(TOP + 1)]
        #: Of each word, the period and end of a long run that holds it; 0 if none is known.
        self.period, self.end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.open: list[np.ndarray] = []  # starts and periods that reach the last word
        self.found: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        """Take the next words (numbers, equal if and only if the words are)."""
        before, self.n = self.n, self.n + len(words)
        self._name(words.astype(np.uint64))
        self.period = np.concatenate([self.period, np.zeros(len(words), np.int64)])
        self.end = np.concatenate([self.end, np.zeros(len(words), np.int64)])
        grown = np.concatenate(self.open) if self.open else np.zeros((0, 2), np.int64)
        self.open = []
        if len(grown):
            # What reached the last word goes on where it stopped.
            at = np.full(len(grown), before)
            self._report(grown[:, 0], at + self._forward(at - grown[:, 1], at), grown[:, 1])
        # A period is bounded by the longest text, not by the words that are there so far.
        top = self.n if self.longest is None else self.longest // 2
        self._level(before, NEAR, 1, SMALL, 3)
        low = SMALL
        while low <= min(top, self.n):
            self._level(before, low, low, 2 * low, low // 2)
            low *= 2

    def finish(self) -> np.ndarray:
        """``start, length, period`` of every run, by start, then period."""
        for rows in self.open:
            self._close(rows[:, 0], np.full(len(rows), self.n), rows[:, 1])
        self.open = []
        if not self.found:
            return np.zeros((0, 3), np.int64)
        rows = np.concatenate(self.found)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[first]
        rows[:, 1] -= rows[:, 0]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def _name(self, words: np.ndarray) -> None:
        """Names of all stretches that end in the new words."""
        self.names[0] = np.concatenate([self.names[0], words])
        for k in range(TOP):
            half, known = 1 << k, len(self.names[k + 1])
            upto = self.n - 2 * half + 1
            if upto <= known:
                break
            left, right = self.names[k][known:upto], self.names[k][known + half : upto + half]
            both = mix(left + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93) + right
            self.names[k + 1] = np.concatenate([self.names[k + 1], mix(both ^ np.uint64(k + 1))])

    def _level(self, before: int, gap: int, low: int, high: int, window: int) -> None:
        """Catchers ``gap`` apart meet the appended words at the distances ``low`` to ``high``."""
        if low >= high:
            return
        # The largest name that fits into a window; two of them cover it.
        k = min(TOP, window.bit_length() - 1)
        size = min(window, 2 << k)
        name, second = self.names[k], size - (1 << k)
        # Left: the window ends at b, its copy at b + p. Right: it begins at b and at b + p.
        for offset, ready in ((-size, 0), (0, size)):
            first, last = (size + gap - 1) // gap * gap if offset else 0, self.n - ready - low
            if last < first:
                continue
            if high - low <= (last - max(first, before - ready - high) + gap) // gap:
                for p in range(low, high):
                    # The pairs whose last word came with this block.
                    begin = max(first, (before - ready - p) // gap * gap + gap)
                    b = np.arange(begin, self.n - ready - p + 1, gap)
                    if len(b):
                        at = b + offset
                        same = (name[at] == name[at + p]) & (name[at + second] == name[at + p + second])
                        self._catch(b[same], np.full(int(same.sum()), p))
            else:
                begin = max(first, (before - ready - high) // gap * gap + gap)
                for b in range(begin, last + 1, gap):
                    start, stop = max(low, before - ready - b + 1), min(high, self.n - ready - b + 1)
                    if start < stop:
                        at = b + offset
                        own = name[at + start : at + stop] == name[at]
                        own &= name[at + second + start : at + second + stop] == name[at + second]
                        p = np.flatnonzero(own) + start
                        self._catch(np.full(len(p), b), p)

    def _catch(self, b: np.ndarray, p: np.ndarray) -> None:
        if len(b) > SOME:
            # A few first: in a long run they speak for all the others.
            self._catch(b[::SOME], p[::SOME])
        # Inside a known run a multiple of its period gives the same stretch once more.
        held = self.period[np.minimum(b, self.n - 1)]
        known = (held > 0) & (p % np.maximum(held, 1) == 0) & (b + p <= self.end[np.minimum(b, self.n - 1)])
        b, p = b[~known], p[~known]
        for k in range(0, len(b), PAIRS):
            at, period = b[k : k + PAIRS], p[k : k + PAIRS]
            start = at - self._backward(at, at + period)
            end = at + period + self._forward(at, at + period)
            # Several catchers stand in one stretch.
            rows = np.unique(np.column_stack([start, end, period]), axis=0)
            self._report(rows[:, 0], rows[:, 1], rows[:, 2])

    def _report(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        for k in np.flatnonzero(end - start >= np.maximum(LONG, 4 * period)):
            self.period[start[k] : end[k]], self.end[start[k] : end[k]] = period[k], end[k]
        still = end == self.n
        if still.any():
            self.open.append(np.unique(np.column_stack([start[still], period[still]]), axis=0))
        self._close(start[~still], end[~still], period[~still])

    def _close(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        long = end - start >= np.maximum(LEAST, 2 * period)
        if long.any():
            self.found.append(np.column_stack([start, end, period])[long])

    def _forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` > ``a`` on are the same."""
        return self._extend(a, b, lambda at, size: at, lambda b, done, size: b + done + size <= self.n, 1)

    def _backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words that end before ``a`` and before ``b`` > ``a`` are the same."""
        return self._extend(a, b, lambda at, size: at - size, lambda a, done, size: a - done - size >= 0, -1)

    def _extend(self, a, b, place, fits, way: int) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        edge = b if way > 0 else a
        for k in range(TOP, -1, -1):
            name, size = self.names[k], 1 << k
            left = np.arange(len(a))
            while len(left):
                left = left[fits(edge[left], done[left], size)]
                at, by = place(a[left] + way * done[left], size), place(b[left] + way * done[left], size)
                left = left[name[at] == name[by]]
                done[left] += size
                if k < TOP:
                    break  # below the top a second step would have been one above
        return done


def numbered(words: list) -> np.ndarray:
    """Equal numbers for equal words."""
    number = {word: k for k, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def runs(words: list) -> np.ndarray:
    """``start, length, period`` of every run of one text's words."""
    return _runs_of([numbered(words)])[0]


def _runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each text, from one row of words with marks between the texts."""
    catchers = Catchers(max((len(t) for t in texts), default=0))
    marks = np.int64(1) << 40
    row = np.concatenate([part for k, t in enumerate(texts) for part in (t, [marks + k])]) if texts else []
    for k in range(0, len(row), BLOCK):
        catchers.append(row[k : k + BLOCK])
    found = catchers.finish()
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cut = np.searchsorted(found[:, 0], starts)
    out = []
    for k in range(len(texts)):
        own = found[cut[k] : cut[k + 1]].copy()
        own[:, 0] -= starts[k]
        out.append(own)
    return out


def covered(found: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def looped(words: list, doc_id: int | None) -> list:
    """The words as the query takes them: of one id in ten the tail becomes periodic."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


SCHEMA = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>, text string"
)
_RUN = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _groups(texts: list[list]):
    """Consecutive texts of about a block of words."""
    group, size = [], 0
    for words in texts:
        if group and size + len(words) >= BLOCK:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words) + 1
    if group:
        yield group


def _row(words: list, found: np.ndarray) -> tuple:
    best = (None,) * 4
    if len(found):
        start, length, period = (int(v) for v in found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]])
        best = (start, length, period, 1000 * length // period)
        out = covered(found, len(words))
        words = [word for word, gone in zip(words, out.tolist()) if not gone]
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found.tolist())
    each = [dict(zip(("start", "length", "period"), row)) for row in found.tolist()]
    return len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), each, b" ".join(words)


def _detect(prepare):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            # bytes.split() parts at exactly the six characters of white space.
            split = [prepare((t or b"").split(), d) for t, d in zip(texts, ids)]
            rows = []
            for group in _groups(split):
                number = numbered([w for words in group for w in words])
                cut = np.cumsum([0, *(len(words) for words in group)])
                parts = [number[a:b] for a, b in zip(cut[:-1], cut[1:])]
                rows += [(len(words), *_row(words, own)) for words, own in zip(group, _runs_of(parts))]
            kinds = [pa.int64()] * 6 + [pa.string(), _RUN, pa.string()]
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            columns[-1] = pa.array(columns[-1], pa.binary()).cast(pa.string())
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            yield pa.record_batch(arrays, [f.split(" ", 1)[0] for f in _NAMES])

    return run


_NAMES = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "runs", "text"]


def detect(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare=lambda words, _: words
) -> DataFrame:
    """Every row's runs, the greatest of them, and its text without the repeats.

    ``runs`` lists all by start, then period; ``start, length, period, exponent_milli`` are
    those of the longest (ties: smallest start, then period; null without a run); ``text``
    has the words that no run holds behind its first period. ``prepare(words, id)`` may
    change a text's words before.
    """
    lean_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_detect(prepare), SCHEMA)
