"""A hashed maximum-entropy language model with a class-factored softmax.

A token is a lower-cased word or the end of its text. Its probability is that of its
class given the words before it, times that of the word within its class. The first
factor is a softmax over the classes, linear in hashed features of the context: the
word before, the word before that (a skip), and the two together. The second is the
maximum-entropy distribution with the word's own feature alone, so its weights are
the smoothed shares of the counts, with one share for all unknown words. Frequent
words are classes of their own; the others go by their last two letters.

Counts are taken over all training texts, in packed blocks dealt out by word. The
softmax is trained in rounds: every task updates its own copy by gradient steps over
its texts, and the copies are averaged row by row, weighted by use. Texts are scored
in numpy batches; words beyond a bounded list of frequent ones have their counts
looked up where the counts are, again in packed blocks.

Defined cases: null and empty texts are their end alone. A null id counts as training.
With no training text every token is unknown. Rows that repeat an id, or a whole row,
each get their score. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import lean_batches, stored
from maskflow.llm.words import mix, word_tails

CLASSES = 32
#: Frequent words that are a class of their own.
OWN = 15
#: Rows of hashed features.
ROWS = 1 << 15
#: Words with at least 1 / FREQUENT of all tokens are sent to all tasks: that many at most.
FREQUENT = 1 << 16
ROUNDS = 2
STEP = 2048
RATE = 0.4
#: Tokens of texts held by a task before it sends counts on; tokens per block of words.
FLUSH = 2_000_000
BLOCK = 2_000_000
END, START = np.uint64(0x1D8E4E27C47D124F), np.uint64(0xEB44ACCAB455D165)
_PART = 1024  # rows of weights in one packed part


def _tokens(texts: list[bytes]):
    """For groups of texts: hashes and tail classes, ends included, and where texts begin."""
    for group in word_tails(texts):
        sizes = np.array([len(h) + 1 for h, _ in group])
        starts = np.cumsum(sizes) - sizes
        words = np.full(sizes.sum(), END, np.uint64)
        tails = np.zeros(sizes.sum(), np.int64)
        inside = np.ones(len(words), bool)
        inside[starts + sizes - 1] = False
        words[inside] = np.concatenate([h for h, _ in group])
        tails[inside] = np.concatenate([t for _, t in group])
        kind = OWN + (mix(tails.view(np.uint64)) % np.uint64(CLASSES - OWN)).astype(np.int64)
        yield words, kind, starts


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _packed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


_COUNTS = "bucket int, words binary, counts binary, kinds binary, n bigint, v bigint"


def _send_counts(buckets: int):
    names = ["bucket", "words", "counts", "kinds"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def flush(held, kept):
        words, first, counts = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        kinds = np.concatenate(kept)[first]
        bucket = (mix(words) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for k in np.flatnonzero(np.diff(cut)):
            own = order[cut[k] : cut[k + 1]]
            rows.append((k, words[own].tobytes(), counts[own].astype(np.int64).tobytes(), kinds[own].astype(np.uint8).tobytes()))
        return _packed(rows, names, types)

    def run(batches):
        held, kept, size = [], [], 0
        for batch in batches:
            for words, kind, _ in _tokens(_texts(batch.column(0))):
                held.append(words)
                kept.append(kind)
                size += len(words)
                if size >= FLUSH:
                    yield flush(held, kept)
                    held, kept, size = [], [], 0
        if size:
            yield flush(held, kept)

    return run


def _by_bucket(batches):
    rows, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current:
                if rows:
                    yield current, rows
                rows, current = [], row["bucket"]
            rows.append(row)
    if rows:
        yield current, rows


def _add_counts(batches):
    names = ["bucket", "words", "counts", "kinds", "n", "v"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    for bucket, rows in _by_bucket(batches):
        words, first, where = np.unique(
            np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows]), return_index=True, return_inverse=True
        )
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, where, np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows]))
        kinds = np.concatenate([np.frombuffer(r["kinds"], np.uint8) for r in rows])[first]
        row = (bucket, words.tobytes(), counts.tobytes(), kinds.tobytes(), int(counts.sum()), len(words))
        yield _packed([row], names, types)


def _summary(limit: float):
    """Of each bucket: its frequent words, and counts and words of each class by tail."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.int64)
                kinds = np.frombuffer(row["kinds"], np.uint8)
                often = counts >= limit
                tokens = np.bincount(kinds, counts, CLASSES).astype(np.int64)
                types = np.bincount(kinds, minlength=CLASSES).astype(np.int64)
                yield _packed(
                    [(words[often].tobytes(), counts[often].tobytes(), kinds[often].tobytes(), tokens.tobytes(), types.tobytes())],
                    ["words", "counts", "kinds", "tokens", "types"], [pa.binary()] * 5,
                )

    return run


@dataclass
class Shares:
    """What all tasks know about words: the frequent ones, their classes, class totals."""

    n: int
    v: int
    words: np.ndarray
    counts: np.ndarray
    own: np.ndarray  # hashes of the words that are classes, sorted
    own_class: np.ndarray
    tokens: np.ndarray
    types: np.ndarray

    def classes(self, words: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        if not len(self.own):
            return kinds
        at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        return np.where(self.own[at] == words, self.own_class[at], kinds)

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is a frequent one, and its count if so."""
        if not len(self.words):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        found = self.words[at] == words
        return found, np.where(found, self.counts[at], 0)


def _shares(n: int, v: int, rows) -> Shares:
    def whole(column, kind):
        return np.concatenate([np.frombuffer(bytes(r[column]), kind) for r in rows] or [np.zeros(0, kind)])

    words, counts, kinds = whole("words", np.uint64), whole("counts", np.int64), whole("kinds", np.uint8)
    order = np.argsort(words)
    words, counts, kinds = words[order], counts[order], kinds[order]
    tokens, types = (sum((np.frombuffer(bytes(r[c]), np.int64) for r in rows), np.zeros(CLASSES, np.int64)) for c in ("tokens", "types"))
    top = np.lexsort((words, -counts))[:OWN]
    tokens, types = tokens.copy(), types.copy()
    for k, i in enumerate(top):
        tokens[kinds[i]] -= counts[i]
        types[kinds[i]] -= 1
        tokens[k], types[k] = counts[i], 1
    by_hash = np.argsort(words[top])
    return Shares(n, v, words, counts, words[top][by_hash], np.arange(len(top))[by_hash], tokens, types)


def _features(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Rows of the features of each token's context."""
    one = np.r_[START, words[:-1]]
    one[starts] = START
    two = np.r_[START, one[:-1]]
    two[starts] = START
    limit = np.uint64(ROWS)
    return [
        (mix(x) % limit).astype(np.int64)
        for x in (one ^ np.uint64(0x51), two * np.uint64(3) ^ np.uint64(0x52), one * np.uint64(5) + two * np.uint64(7))
    ]


def _log_shares(weights: np.ndarray, bias: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    logits = weights[features[0]] + bias
    for rows in features[1:]:
        logits += weights[rows]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _bias(shares: Shares) -> np.ndarray:
    return np.log((shares.tokens + 0.5) / (shares.tokens + 0.5).sum()).astype(np.float32)


def _learn(sent_shares, sent_weights):
    """Gradient steps over a task's texts; gives its weights and how much each row was used."""

    def run(batches):
        shares = sent_shares.value
        weights, bias = sent_weights.value.copy(), _bias(shares)
        used, energy = np.zeros(ROWS, np.float32), np.full(ROWS, 1e-3, np.float32)
        for batch in batches:
            for words, kinds, starts in _tokens(_texts(batch.column(0))):
                target = shares.classes(words, kinds)
                features = _features(words, starts)
                for a in range(0, len(words), STEP):
                    part = [rows[a : a + STEP] for rows in features]
                    error = np.exp(_log_shares(weights, bias, part))
                    error[np.arange(len(error)), target[a : a + STEP]] -= 1
                    for rows in part:
                        order = np.argsort(rows)
                        ordered = rows[order]
                        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                        row, size = ordered[first], np.diff(np.r_[first, len(ordered)])
                        slope = np.add.reduceat(error[order], first, axis=0)
                        energy[row] += np.einsum("ij,ij->i", slope, slope)
                        weights[row] -= (RATE / np.sqrt(energy[row]))[:, None] * slope
                        used[row] += size
        if used.any():
            rows = [
                (k, weights[k * _PART : (k + 1) * _PART].tobytes(), used[k * _PART : (k + 1) * _PART].tobytes())
                for k in range(ROWS // _PART)
            ]
            yield _packed(rows, ["bucket", "weights", "used"], [pa.int32(), pa.binary(), pa.binary()])

    return run


def _average(batches):
    """The average of the tasks' weights, row by row; never more than two copies are held."""
    total, used, current = None, None, None

    def done():
        share = total / np.maximum(used, 1)[:, None]
        return _packed([(current, share.astype(np.float32).tobytes())], ["bucket", "weights"], [pa.int32(), pa.binary()])

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current:
                if current is not None:
                    yield done()
                total, used, current = np.zeros((_PART, CLASSES)), np.zeros(_PART), row["bucket"]
            weight = np.frombuffer(row["used"], np.float32)
            total += np.frombuffer(row["weights"], np.float32).reshape(_PART, CLASSES) * weight[:, None]
            used += weight
    if current is not None:
        yield done()


def _score(sent_shares, sent_weights):
    """Per text what needs no rare counts: sizes, class probabilities, frequent words."""
    names = ["doc_id", "held_out", "key", "n_tokens", "known", "plain", "factor"]

    def run(batches):
        shares, weights = sent_shares.value, sent_weights.value
        bias = _bias(shares)
        base = np.log10(shares.tokens + 0.5 * (shares.types + 1))
        for batch in batches:
            sizes, known, plain, factor = [], [], [], []
            for words, kinds, starts in _tokens(_texts(batch.column(3))):
                target = shares.classes(words, kinds)
                features = _features(words, starts)
                value = np.empty(len(words))
                for a in range(0, len(words), STEP):
                    own = target[a : a + STEP]
                    found = _log_shares(weights, bias, [rows[a : a + STEP] for rows in features])
                    value[a : a + STEP] = found[np.arange(len(own)), own]
                value = value / np.log(10) - base[target]
                often, counts = shares.lookup(words)
                sizes.append(np.diff(np.r_[starts, len(words)]))
                known.append(np.add.reduceat(often.astype(np.int64), starts))
                plain.append(np.add.reduceat(np.where(often, np.log10(counts + 0.5), 0), starts))
                factor.append(np.add.reduceat(value, starts))
            if sizes:
                columns = [pa.array(np.concatenate(c)) for c in (sizes, known, plain, factor)]
                yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), *columns], names)

    return run


_ASKED = "bucket int, kind int, words binary, counts binary, keys binary, at binary"


def _ask(sent_shares, buckets: int):
    """The words of texts that are not frequent, dealt by word."""
    names = ["bucket", "kind", "words", "counts", "keys", "at"]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 4

    def flush(keys, words, owners):
        words, owners, keys = np.concatenate(words), np.concatenate(owners), np.concatenate(keys)
        bucket = (mix(words) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for k in np.flatnonzero(np.diff(cut)):
            own = order[cut[k] : cut[k + 1]]
            used, at = np.unique(owners[own], return_inverse=True)
            kind = np.uint32 if len(used) > 65535 else np.uint16
            rows.append((k, 1, words[own].tobytes(), b"", keys[used].tobytes(), at.astype(kind).tobytes()))
        return _packed(rows, names, types)

    def run(batches):
        shares = sent_shares.value
        keys, words, owners, size, texts = [], [], [], 0, 0
        for batch in batches:
            done = 0
            column = batch.column(0).to_numpy()
            for found, _, starts in _tokens(_texts(batch.column(1))):
                rare = np.flatnonzero(~shares.lookup(found)[0])
                owners.append(np.searchsorted(starts, rare, "right") - 1 + texts)
                words.append(found[rare])
                keys.append(column[done : done + len(starts)])
                done += len(starts)
                texts += len(starts)
                size += len(rare)
                if size >= FLUSH // 2:
                    yield flush(keys, words, owners)
                    keys, words, owners, size, texts = [], [], [], 0, 0
        if size:
            yield flush(keys, words, owners)

    return run


_ANSWERS = "bucket int, keys binary, plain binary, known binary"


def _answer(buckets: int):
    """Sums of log counts by text, dealt by text. A bucket's counts come before its questions."""
    names = ["bucket", "keys", "plain", "known"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        words = counts = current = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    words, counts, current = np.zeros(0, np.uint64), np.zeros(0, np.int64), row["bucket"]
                if row["kind"] == 0:
                    words, counts = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.int64)
                    continue
                asked, keys = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["keys"], np.int64)
                at = np.frombuffer(row["at"], np.uint32 if len(row["at"]) == 4 * len(asked) else np.uint16)
                count = np.zeros(len(asked), np.int64)
                if len(words):
                    where = np.minimum(np.searchsorted(words, asked), len(words) - 1)
                    count = np.where(words[where] == asked, counts[where], 0)
                plain = np.bincount(at, np.log10(count + 0.5), len(keys))
                known = np.bincount(at, count > 0, len(keys)).astype(np.int32)
                bucket = (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for k in np.flatnonzero(np.diff(cut)):
                    own = order[cut[k] : cut[k + 1]]
                    rows.append((k, keys[own].tobytes(), plain[own].tobytes(), known[own].tobytes()))
                yield _packed(rows, names, types)

    return run


def _add_answers(batches):
    for _, rows in _by_bucket(batches):
        keys, where = np.unique(np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows]), return_inverse=True)
        plain = np.bincount(where, np.concatenate([np.frombuffer(r["plain"], np.float64) for r in rows]))
        known = np.bincount(where, np.concatenate([np.frombuffer(r["known"], np.int32) for r in rows])).astype(np.int64)
        yield pa.record_batch([pa.array(keys), pa.array(plain), pa.array(known)], ["key", "rare_plain", "rare_known"])


def score(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: str | None = None
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``held_out`` is a condition on ``doc_id``; by default the remainder of its CRC by 5
    is 1. The model learns from the other rows only.
    """
    lean_batches(spark)
    held = held_out or "coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 1, false)"
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", F.expr(held).alias("held"), F.xxhash64("doc_id", "text").alias("key"), "text")
    train = rows.filter("not held")
    bytes_in = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, bytes_in // (6 * BLOCK) + 1)
    counts = stored(
        spark,
        train.select("text").mapInArrow(_send_counts(buckets), "bucket int, words binary, counts binary, kinds binary")
        .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_add_counts, _COUNTS),
        "word-counts",
    )
    n, v = (x or 0 for x in counts.agg(F.sum("n"), F.sum("v")).first())
    found = counts.mapInArrow(
        _summary(max(1.0, n / FREQUENT)), "words binary, counts binary, kinds binary, tokens binary, types binary"
    ).collect()
    shares = spark.sparkContext.broadcast(_shares(n, v, found))

    # Every training text is used in one round; each round starts from the average.
    weights = np.zeros((ROWS, CLASSES), np.float32)
    for turn in range(ROUNDS):
        own = train.filter(f"pmod(key, {ROUNDS}) = {turn}").select("text")
        copies = own.mapInArrow(_learn(shares, spark.sparkContext.broadcast(weights)), "bucket int, weights binary, used binary")
        parts = copies.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_average, "bucket int, weights binary")
        for part in parts.collect():
            at = part.bucket * _PART
            weights[at : at + _PART] = np.frombuffer(bytes(part.weights), np.float32).reshape(_PART, CLASSES)

    scored = stored(
        spark,
        rows.mapInArrow(
            _score(shares, spark.sparkContext.broadcast(weights)),
            "doc_id bigint, held_out boolean, key bigint, n_tokens bigint, known bigint, plain double, factor double",
        ),
        "scored",
    )
    asked = rows.select("key", "text").mapInArrow(_ask(shares, buckets), _ASKED)
    empty = F.lit(b"").alias
    held_counts = counts.select("bucket", F.lit(0).alias("kind"), "words", "counts", empty("keys"), empty("at"))
    answers = (
        held_counts.unionByName(asked).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
        .mapInArrow(_answer(buckets), _ANSWERS)
        .repartition(buckets, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_add_answers, "key bigint, rare_plain double, rare_known bigint")
    )
    # Rows that are repeated whole have asked more than once under one key.
    copies = scored.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    per_text = answers.join(copies, "key").select(
        F.col("key").alias("_key"), (F.col("rare_plain") / F.col("copies")).alias("rare_plain"),
        (F.col("rare_known") / F.col("copies")).cast("bigint").alias("rare_known"),
    )
    sums = F.col("plain") + F.coalesce("rare_plain", F.lit(0.0))
    size = float(np.log10(n + 0.5 * (v + 1)))
    return scored.join(per_text, F.col("key") == F.col("_key"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (sums - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (sums + F.col("factor")).alias("score"),
    )
