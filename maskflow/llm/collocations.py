"""Phrase collocations by stripes: each prefix keys a counter of the words that come next.

There are stripes for prefixes of no, one and two words. The stripe of no words counts
words; an entry of a one-word stripe counts a phrase of two words, an entry of a two-word
stripe one of three. So a prefix's total is its last word's entry one stripe up, the
extensions of a phrase are the entries of its stripe, and what may subsume it is the
greatest of them, or of those stripes that it ends: one structure holds all of it.

Tasks merge the stripes of many texts, then send each as one stretch of a packed block
(prefixes, lengths, next words, counts), dealt over buckets by prefix. Words with more than
``HOT`` of all occurrences are known from the first stripe, at most ``1 / HOT`` of them; the
stripes of prefixes made of such words only are dealt by next word as well, so no task
holds the whole stripe of a common prefix. Stripes are merged elementwise, a bucket at a
time, and lose the entries below ``least``. All later steps join rows of candidates.

Words and prefixes travel as 64-bit hashes that include the language; two of them are
the same with a chance of about 2**-64. Blocks pay while a task's flush has several entries
for a bucket, up to some 10**12 words; beyond that a block is no better than a plain row.

Defined cases: null text is empty, null language is ``und``, as is that word itself.
Repeated rows count each time; other columns are ignored. An empty table gives no row. A text
without marks between its pieces is one piece and laid out whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.llm.tables import join_hot, lean_batches, small, stored
from maskflow.llm.words import PIECE, hashes, mix

#: Share of all words above which a word's stripes are dealt by next word too.
HOT = 1 / 10_000
#: Words that a task gathers before it sends stripes, and words whose stripes share a bucket.
FLUSH, BUCKET_WORDS = 1_000_000, 1_000_000
#: Distinct words that a task holds before it sends their counts.
DISTINCT = 200_000
#: Scores that are counted as one at first.
STEP = 1_000
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_OUTSIDE = _ENDS.copy()
_OUTSIDE[[9, 32]] = True
_U = np.uint64


def _code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts, cut only where a piece ends."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(bytes([b]), at, at + PIECE) for b in b".,;:!?\n\x0b\x0c\r")
        if cut < 0:
            cut = min((p for b in b".,;:!?\n\x0b\x0c\r" if (p := text.find(bytes([b]), at + PIECE)) >= 0), default=len(text))
        yield text[at : cut + 1]
        at = cut + 1
    if at < len(text):
        yield text[at:]


def _groups(batches) -> Iterator[tuple[list[str], list[bytes]]]:
    """Texts with their languages, about ``PIECE`` bytes at a time."""
    for batch in batches:
        langs, texts, size = [], [], 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for part in _parts(text or b""):
                if texts and size + len(part) > PIECE:
                    yield langs, texts
                    langs, texts, size = [], [], 0
                langs.append(lang)
                texts.append(part)
                size += len(part) + 1
        if texts:
            yield langs, texts


class Laid:
    """The words of a group of texts: hashes with their language, and where pieces go on."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.raw = b"\n".join(texts)
        buffer = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(buffer) + 2, np.int8)
        inside[1:-1] = ~_OUTSIDE[buffer]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[0::2], edges[1::2]
        cut = np.searchsorted(self.starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        self.lang = np.repeat(np.arange(len(texts)), np.diff(cut))
        code = np.array([_code(lang) for lang in langs], _U)
        plain = hashes(buffer, self.starts, self.ends) if len(self.starts) else np.zeros(0, _U)
        self.words = mix(plain + code[self.lang]) if len(plain) else plain
        breaks = np.zeros(len(buffer) + 1, np.int64)
        np.cumsum(_ENDS[buffer], out=breaks[1:])
        #: Whether the word goes on to the next one within its piece.
        self.on = np.zeros(len(self.starts), bool)
        self.on[:-1] = breaks[self.starts[1:]] == breaks[self.ends[:-1]]


def pair_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of a two-word prefix."""
    return mix(first * _U(0x9FB21C651E98DF25) + (second ^ _U(0x9E3779B97F4A7C15)))


def _count(batches):
    """The stripe of no words: counts of words, merged in the task."""

    def rows():
        at = np.fromiter(held, np.uint64, len(held)).view(np.int64)
        lang, word, n = zip(*held.values()) if held else ((), (), ())
        return pa.record_batch(
            [pa.array(lang, pa.string()), pa.array(word, pa.binary()).cast(pa.string()), pa.array(at), pa.array(n, pa.int64())],
            ["lang", "word", "h", "n"],
        )

    held: dict[int, list] = {}
    for langs, texts in _groups(batches):
        laid = Laid(langs, texts)
        found, first, n = np.unique(laid.words, return_index=True, return_counts=True)
        for h, k, count in zip(found.tolist(), first.tolist(), n.tolist()):
            own = held.get(h)
            if own is None:
                word = laid.raw[laid.starts[k] : laid.ends[k]].lower()
                held[h] = [langs[laid.lang[k]], word, count]
            else:
                own[2] += count
        if len(held) > DISTINCT:
            yield rows()
            held = {}
    yield rows()


def merged(prefix: np.ndarray, following: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal entries of stripes added up, by prefix, then next word."""
    order = np.lexsort((following, prefix))
    prefix, following = prefix[order], following[order]
    first = np.ones(len(order), bool)
    first[1:] = (prefix[1:] != prefix[:-1]) | (following[1:] != following[:-1])
    at = np.flatnonzero(first)
    return prefix[at], following[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _pack(prefix: np.ndarray, following: np.ndarray, n: np.ndarray) -> bytes:
    first = np.ones(len(prefix), bool)
    first[1:] = prefix[1:] != prefix[:-1]
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(prefix)))
    head = np.array([len(at), len(prefix)], np.uint32)
    return b"".join(a.tobytes() for a in (head, prefix[at], length.astype(np.uint32), following, n.astype(np.uint32)))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = (int(v) for v in np.frombuffer(data, np.uint32, 2))
    prefix = np.frombuffer(data, _U, a, 8)
    length = np.frombuffer(data, np.uint32, a, 8 + 8 * a)
    following = np.frombuffer(data[8 + 12 * a :], _U, b)
    return np.repeat(prefix, length), following, np.frombuffer(data, np.uint32, b, 8 + 12 * a + 8 * b).astype(np.int64)


def _stripes(sent, buckets: int):
    """Stripes of one and two words, merged in the task, in blocks by bucket."""

    def blocks(size: int, prefix: np.ndarray, following: np.ndarray, common: np.ndarray):
        prefix, following, n = merged(prefix, following, np.ones(len(prefix), np.int64))
        # A common prefix has its own way: its stripe is dealt by next word.
        known = np.isin(prefix, common)
        bucket = (mix(prefix + np.where(known, following, _U(0))) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, prefix, following, n = bucket[order], prefix[order], following[order], n[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(cut[1:], len(bucket))
        for k in range(0, len(cut), 4096):
            own = list(zip(cut[k : k + 4096].tolist(), ends[k : k + 4096].tolist()))
            yield pa.record_batch(
                [
                    pa.array(bucket[cut[k : k + 4096]].astype(np.int32)),
                    pa.array([size] * len(own), pa.int32()),
                    pa.array([_pack(prefix[a:b], following[a:b], n[a:b]) for a, b in own], pa.binary()),
                ],
                ["bucket", "size", "data"],
            )

    def run(batches):
        hot = np.sort(sent.value)
        one, two, words = [], [], 0

        def flush():
            # Pairs of common words are at most the square of their number; only those met are looked at.
            w, x = (np.concatenate(c) for c in zip(*one))
            both = np.isin(w, hot) & np.isin(x, hot)
            pairs = np.unique(pair_of(w[both], x[both]))
            yield from blocks(1, w, x, hot)
            p, y = (np.concatenate(c) for c in zip(*two))
            yield from blocks(2, p, y, pairs)

        for langs, texts in _groups(batches):
            laid = Laid(langs, texts)
            w, on = laid.words, laid.on
            k = np.flatnonzero(on)
            one.append((w[k], w[k + 1]))
            k = k[on[k + 1]] if len(k) else k
            two.append((pair_of(w[k], w[k + 1]), w[k + 2] if len(k) else w[:0]))
            words += len(w)
            if words > FLUSH:
                yield from flush()
                one, two, words = [], [], 0
        if one:
            yield from flush()

    return run


def _merge(least: int):
    """Blocks of a bucket merged elementwise; entries below ``least`` go."""

    def done(size: int, parts: list[bytes]):
        columns = [np.concatenate(c) for c in zip(*map(_unpack, parts))]
        prefix, following, n = merged(*columns)
        keep = n >= least
        prefix, following, n = prefix[keep], following[keep], n[keep]
        at = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(prefix) else np.zeros(0, int)
        offsets = pa.array(np.append(at, len(prefix)).astype(np.int32))
        # The hash under which an entry of a one-word stripe is a prefix itself.
        pairs = pair_of(prefix, following) if size == 1 else np.zeros(len(prefix), _U)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.view(np.int64))) for v in (following, n, pairs)]
        names = ["size", "prefix", "following", "n", "pairs"]
        return pa.record_batch([pa.array([size] * len(at), pa.int32()), pa.array(prefix[at].view(np.int64)), *lists], names)

    def run(batches):
        key, parts = None, []
        for batch in batches:
            for bucket, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, size) != key:
                    if parts:
                        yield done(key[1], parts)
                    key, parts = (bucket, size), []
                parts.append(data)
        if parts:
            yield done(key[1], parts)

    return run


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` in whole numbers of up to 38 digits."""
    big = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", big(a) * big(a) * F.lit(1_000_000).cast("decimal(7,0)"), big(left) * big(right))


def mine(
    spark: SparkSession, docs: DataFrame, top: int = 2000, least: int = 10, cover: int = 50, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are phrases of two or three words within a piece that occur ``least`` times
    or more. ``score`` is that of the cut that scores lowest, ``l`` and ``r`` are the counts
    of its parts. A candidate goes when a longer one that holds it has ``cover`` percent of its
    count or more. Ranked by score and count, both descending, then by the phrase's bytes.
    """
    lean_batches(spark)
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    counted = rows.mapInArrow(_count, "lang string, word string, h bigint, n bigint")
    words = stored(spark, counted.groupBy("h", "lang", "word").agg(F.sum("n").alias("f")), "words")
    total = words.agg(F.sum("f")).first()[0] or 0
    per_lang = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.filter(F.col("f") >= least)
    # Bounded by 1 / HOT whatever the data.
    hot = [r.h for r in words.filter(F.col("f") > max(1.0, HOT * total)).select("h").collect()]
    sent = spark.sparkContext.broadcast(np.array(sorted(hot), np.int64).view(_U))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, 1 + total // BUCKET_WORDS)
    blocks = rows.mapInArrow(_stripes(sent, buckets), "bucket int, size int, data binary")
    dealt = blocks.repartition(max(tasks, buckets // 4), "bucket").sortWithinPartitions("bucket", "size")
    form = "size int, prefix bigint, following array<bigint>, n array<bigint>, pairs array<bigint>"
    stripes = stored(spark, dealt.mapInArrow(_merge(least), form), "stripes")

    entries = F.explode(F.arrays_zip("following", "n", "pairs")).alias("e")
    first = known.select(F.col("h").alias("prefix"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    second = known.select(F.col("h").alias("x"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    one = (
        stripes.filter("size = 1").join(first, "prefix")
        .select("lang", F.col("prefix").alias("w"), "w1", "f1", entries)
        .select("lang", "w", "w1", "f1", F.col("e.following").alias("x"), F.col("e.n").alias("a"), F.col("e.pairs").alias("pair"))
    )
    two_words = stored(spark, join_hot(one, second, "x", "f2", total), "two-words")

    longer = stripes.filter("size = 2")
    start = two_words.select(F.col("pair").alias("prefix"), "lang", "w", "x", "w1", "f1", "w2", F.col("a").alias("f12"))
    three = longer.join(start, "prefix").select(
        "lang", "w1", "f1", "w2", "f12", "x", F.explode(F.arrays_zip("following", "n")).alias("e")
    ).select("lang", "w1", "f1", "w2", "f12", F.struct("x", F.col("e.following").alias("y")).alias("rest"), F.col("e.n").alias("a"))
    three_words = stored(spark, three, "three-words")
    # What a two-word phrase ends, and how often at most: the other half of what may subsume it.
    ended = three_words.groupBy("rest").agg(F.max("a").alias("before"), F.count(F.lit(1)).alias("size"))
    ends = two_words.select(
        F.struct(F.col("w").alias("x"), F.col("x").alias("y")).alias("rest"),
        F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("f23"),
    )
    tails = stored(spark, ended.join(ends, "rest"), "tails")
    full = join_hot(three_words, tails, "rest", "size", three_words.count())

    after = longer.groupBy(F.col("prefix").alias("pair")).agg(F.max(F.array_max("n")).alias("after"))
    before = tails.select("rest", "before")
    most = F.greatest(F.coalesce("after", F.lit(0)), F.coalesce("before", F.lit(0)))
    free = (
        two_words.withColumn("rest", F.struct(F.col("w").alias("x"), F.col("x").alias("y")))
        .join(after, "pair", "left").join(before, "rest", "left").filter(100 * most < cover * F.col("a"))
    )
    short = free.select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )
    early, late = _score(F.col("a"), F.col("f1"), F.col("f23")), _score(F.col("a"), F.col("f12"), F.col("f3"))
    long = full.withColumns({"s1": early, "s2": late}).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(F.col("s1") <= F.col("s2"), F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    per_lang = stored(spark, per_lang, "languages")
    langs = per_lang.count()
    ranked = _ranked(stored(spark, short.unionByName(long), "phrases"), top, langs)
    return ranked.join(small(per_lang, langs, 64), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _ranked(phrases: DataFrame, top: int, langs: int) -> DataFrame:
    """The first ``top`` of each language.

    Scores are whole numbers up to a million: counting them first, by thousands and then one by
    one, finds the score that reaches ``top``, so that about so many phrases, and the ties of
    the last score, are ranked. A language has some thousand counts in either step.
    """
    near = phrases.withColumn("level", F.floor(F.col("score") / STEP))
    for _ in range(2):
        levels = near.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("m"))
        above = F.sum("m").over(Window.partitionBy("lang").orderBy(F.col("level").desc()))
        needed = levels.withColumn("upto", above).filter(F.col("upto") - F.col("m") < top)
        last = needed.groupBy("lang").agg(F.min("level").alias("last"))
        near = near.join(small(last, langs, 64), "lang").filter(F.col("level") >= F.col("last"))
        # Above the last level all stay, so they are one level; within it each score is one.
        near = near.withColumn("level", F.least("score", (F.col("last") + 1) * STEP)).drop("last")
    near = near.drop("level")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return near.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= top)
