"""Secret scans: fixed rules, and a character convolutional network over candidates.

The rules find assignments to secret names, access keys and long hexadecimal runs. The
network reads every candidate with the characters around it, whole, and adds what it takes for
secrets and no rule has found. A candidate is a run of at least ``LONG`` key characters, or
of at least ``SHORT`` with a digit beside letters or a capital behind a small letter; shorter
words without either, such as a password of small letters alone, are not. Of a run longer
than ``INSIDE`` every stretch of that length is read, ``STEP`` apart; neighbouring stretches
that are taken for secrets give one span.

It is trained on labelled findings: candidates inside a finding of the rules are
secrets, others are not. In training the surroundings of half the secrets are swapped
with those of ordinary text, so that the form of the secret itself is learnt, and some are
put into the middle of a long ordinary run, as keys in paths are. Scores are
calibrated by a logistic fit on findings held back, and the threshold is the highest
that still finds ``RECALL`` of them, or the level of the few false alarms allowed;
``Network.alarms`` is the share of ordinary findings held back that it takes for secrets.

All different findings are learnt from, but for a quarter, by hash, that is held back and
judged whole. They are dealt by hash into blocks of about ``BLOCK``; in a round a task
learns from each block, beginning with the same weights, and the next round begins with
the average. One block takes all ``EPOCHS`` at once. Of a kind so rare that a block would
have fewer than ``LEAST``, each finding goes to several blocks.

Defined cases: null text is empty. With fewer than eight findings of either kind to learn
from, or none held back, nothing is learnt and nothing added. Positions are code points, ends are exclusive.
Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import lean_batches, stored
from maskflow.llm.words import BYTES, PIECE, hashes

KINDS = ("assign", "access", "hex", "model")
SHORT, LONG = 8, 16
RECALL = 0.98
FALSE_ALARMS = 1e-3
#: Findings that a task learns from at a time, and how many of either kind it has at least.
BLOCK, LEAST = 7_500, 100
#: How often each finding is learnt from, and in how many rounds if there are several blocks.
EPOCHS, ROUNDS = 6, 3
#: Scores of findings held back are counted in steps of 1 / STEPS, up to FAR on either side.
STEPS, FAR = 256, 60
AROUND, INSIDE, STEP = 16, 48, 24
_ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_HEX = _table(b"0123456789abcdef")
_KEY = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


_DIGIT = _table(b"0123456789")
_CAPITAL = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SMALL = _table(b"abcdefghijklmnopqrstuvwxyz")


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.zeros(len(inside) + 2, np.int8)
    edge[1:-1] = inside
    at = np.flatnonzero(np.diff(edge))
    start, end = at[0::2], at[1::2]
    long = end - start >= least
    return start[long], end[long]


def _rule_spans(text: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of assignments and access keys of one text."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found


class Scan:
    """Spans of the rules and candidates of some consecutive texts."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts])
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.rules: list[list[tuple[int, int, str]]] = [_rule_spans(t) for t in texts]
        for a, b in zip(*_runs(_HEX[self.buffer], 32)):
            k = self.text_of(a)
            self.rules[k].append((int(a - self.starts[k]), int(b - self.starts[k]), "hex"))
        a, b = self._candidates()
        # A view is what the network sees at once: a candidate, or a stretch of a longer one.
        count = 1 + np.maximum(0, -(-(b - a - INSIDE) // STEP))
        self.run = np.repeat(np.arange(len(a)), count)
        place = np.arange(len(self.run)) - np.repeat(np.cumsum(count) - count, count)
        self.a = a[self.run] + np.minimum(place * STEP, np.maximum(b - a - INSIDE, 0)[self.run])
        self.b = np.minimum(self.a + INSIDE, b[self.run])
        self.owner = np.searchsorted(self.starts, self.a, "right") - 1
        taken = np.zeros(len(self.buffer) + 1, np.int32)
        for k, spans in enumerate(self.rules):
            for a, b, _ in spans:
                taken[self.starts[k] + a] += 1
                taken[self.starts[k] + b] -= 1
        covered = np.r_[0, np.cumsum(np.cumsum(taken[:-1]) > 0)]
        self.label = (covered[self.b] - covered[self.a]) > 0
        self.point = np.cumsum((self.buffer & 0xC0) != 0x80) - 1

    def _candidates(self) -> tuple[np.ndarray, np.ndarray]:
        a, b = _runs(_KEY[self.buffer], SHORT)
        code = self.buffer

        def some(mask: np.ndarray) -> np.ndarray:
            upto = np.r_[0, np.cumsum(mask, dtype=np.int32)]
            return upto[b] > upto[a]

        letter = _CAPITAL[code] | _SMALL[code]
        inner = np.zeros(len(code), bool)
        inner[1:] = _CAPITAL[code[1:]] & _SMALL[code[:-1]]
        mixed = (some(_DIGIT[code]) & some(letter)) | some(inner)
        own = mixed | (b - a >= LONG)
        return a[own], b[own]

    def spans(self, hit: np.ndarray) -> list[tuple[int, int, int]]:
        """``(text, start, end)`` in code points of the views ``hit``, in order; those that meet are one."""
        found: list[list[int]] = []
        for i in hit:
            if found and found[-1][0] == self.run[i] and self.a[i] <= found[-1][2]:
                found[-1][2] = int(self.b[i])
            else:
                found.append([int(self.run[i]), int(self.a[i]), int(self.b[i])])
        out = []
        for _, a, b in found:
            own = self.text_of(a)
            at = int(self.starts[own])
            out.append((own, *self.points(own, a - at, b - at)))
        return out

    def text_of(self, place: int) -> int:
        return int(np.searchsorted(self.starts, place, "right") - 1)

    def points(self, k: int, a: int, b: int) -> tuple[int, int]:
        """Code points of a byte span of text ``k``."""
        at = self.starts[k]
        zero = self.point[at] if self.sizes[k] else 0
        return int(self.point[at + a] - zero), int(self.point[at + b - 1] - zero) + 1

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Views with what is around them: fixed places for left, inside and right."""
        first, last = self.starts[self.owner[which]], self.starts[self.owner[which]] + self.sizes[self.owner[which]]
        a, b = self.a[which], self.b[which]
        inner = a[:, None] + np.arange(INSIDE)
        left, right = a[:, None] - AROUND + np.arange(AROUND), b[:, None] + np.arange(AROUND)
        place = np.hstack([left, inner, right])
        valid = np.hstack([left >= first[:, None], inner < b[:, None], right < last[:, None]])
        code = self.buffer[np.clip(place, 0, len(self.buffer) - 1)]
        # Letters of other scripts and control characters are one symbol each; 0 is nothing.
        code = np.where(code >= 127, 97, np.where(code < 32, 96, code - 31))
        return np.where(valid, code, 0).astype(np.uint8)


def _groups(texts: list[bytes]):
    group, size, at = [], 0, 0
    for text in texts:
        if group and size + len(text) > PIECE:
            yield at, Scan(group)
            at += len(group)
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield at, Scan(group)


SYMBOLS, DEPTH, WIDTH, FILTERS = 98, 10, 5, 24
_REGIONS = ((0, AROUND), (AROUND, AROUND + INSIDE - WIDTH + 1), (AROUND + INSIDE, 2 * AROUND + INSIDE - WIDTH + 1))


@dataclass
class Network:
    """Embedding, one convolution, the largest answer by region, and a logistic unit."""

    embed: np.ndarray
    filters: np.ndarray
    offset: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    scale: tuple[float, float] = (0.0, 1.0)
    threshold: float = 2.0  # above 1: nothing is added
    alarms: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        g = np.random.default_rng(seed)
        draw = lambda *shape: g.normal(0, (1 / shape[0]) ** 0.5, shape).astype(np.float32)
        embed = g.normal(0, 0.5, (SYMBOLS, DEPTH)).astype(np.float32)
        embed[0] = 0
        regions = FILTERS * (len(_REGIONS) + 1)
        return cls(embed, draw(WIDTH * DEPTH, FILTERS), np.zeros(FILTERS, np.float32), draw(regions), np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.offset, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        """The network with the weights ``flat``, end to end."""
        shapes = [w.shape for w in cls.fresh().weights()]
        ends = np.cumsum([int(np.prod(shape)) for shape in shapes])
        parts = np.split(np.asarray(flat, np.float32), ends[:-1])
        return cls(*(part.reshape(shape).copy() for part, shape in zip(parts, shapes)))

    def forward(self, codes: np.ndarray):
        x = self.embed[codes]
        n, length, _ = x.shape
        columns = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2)
        columns = np.ascontiguousarray(columns).reshape(n * (length - WIDTH + 1), WIDTH * DEPTH)
        answer = np.maximum(columns @ self.filters + self.offset, 0).reshape(n, length - WIDTH + 1, FILTERS)
        best = [a + answer[:, a:b].argmax(axis=1) for a, b in _REGIONS]
        parts = [np.take_along_axis(answer, at[:, None], axis=1)[:, 0] for at in best]
        a, b = _REGIONS[1]
        parts.append(answer[:, a:b].mean(axis=1))
        pooled = np.hstack(parts)
        return pooled @ self.out + self.bias[0], (codes, columns, answer, best, pooled)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.forward(codes[k : k + 512])[0] for k in range(0, len(codes), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * self.logits(codes), -60, 60)))

    def slopes(self, kept, error: np.ndarray) -> list[np.ndarray]:
        codes, columns, answer, best, pooled = kept
        n, places, _ = answer.shape
        back = error[:, None] * self.out
        grad = np.zeros_like(answer)
        for k, at in enumerate(best):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            spot = np.take_along_axis(grad, at[:, None], axis=1)[:, 0] + own
            np.put_along_axis(grad, at[:, None], spot[:, None], axis=1)
        a, b = _REGIONS[1]
        grad[:, a:b] += back[:, None, -FILTERS:] / (b - a)
        grad *= answer > 0
        flat = grad.reshape(n * places, FILTERS)
        into = (flat @ self.filters.T).reshape(n, places, WIDTH, DEPTH)
        embed = np.zeros_like(self.embed)
        for w in range(WIDTH):
            np.add.at(embed, codes[:, w : w + places].ravel(), into[:, :, w].reshape(-1, DEPTH))
        embed[0] = 0
        return [embed, columns.T @ flat, flat.sum(axis=0), pooled.T @ error, np.array([error.sum()], np.float32)]


def _fit_line(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic calibration, kept from growing without bound; ``n`` rows each."""
    a, b = 0.0, 1.0
    mean = lambda x: float(np.average(x, weights=n))
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -60, 60)))
        a -= 0.2 * mean(p - y)
        b -= 0.2 * (mean((p - y) * z) / (1 + mean(z * z)) + 1e-3 * (b - 1))
    return a, b


def teach(model: Network, codes: np.ndarray, secret: np.ndarray, epochs: int, seed: int = 11) -> Network:
    """The network after some epochs over labelled windows, each of them read in every epoch."""
    model = Network.of(model.flat())
    g = np.random.default_rng(seed)
    plain, good = np.flatnonzero(~secret), np.flatnonzero(secret)
    if not len(plain) or not len(good):
        return model
    moments = None
    turn = 0
    for _ in range(epochs):
        # Rare secrets come again, up to half as many as there are others.
        order = np.concatenate([plain, np.resize(g.permutation(good), max(len(good), len(plain) // 2))])
        order = g.permutation(order)
        for k in range(0, len(order), 128):
            at = order[k : k + 128]
            x, y = codes[at].copy(), secret[at].astype(np.float32)
            swap = np.flatnonzero(secret[at] & (g.random(len(at)) < 0.5))
            other = codes[g.choice(plain, len(swap))]
            x[swap, :AROUND], x[swap, -AROUND:] = other[:, :AROUND], other[:, -AROUND:]
            for i in np.flatnonzero(g.random(len(at)) < 0.2):
                _stretch(x[i], codes[g.choice(plain)], bool(y[i]), g)
            z, kept = model.forward(x)
            error = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(at)).astype(np.float32)
            slopes = model.slopes(kept, error)
            moments = moments or [(np.zeros_like(s), np.zeros_like(s)) for s in slopes]
            turn += 1
            for weight, slope, (m, v) in zip(model.weights(), slopes, moments):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                weight -= 0.01 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return model


def _calibrate(model: Network, step: np.ndarray, secret: np.ndarray, n: np.ndarray) -> None:
    """Scale and threshold from the findings held back: ``n`` of each step of the score and label."""
    if not secret.any() or secret.all():
        return
    z = step / STEPS
    model.scale = _fit_line(z, secret.astype(float), n)
    of = lambda x: 1 / (1 + np.exp(-np.clip(model.scale[0] + model.scale[1] * x, -60, 60)))
    low, high = np.minimum(of(z), of(z + 1 / STEPS)), np.maximum(of(z), of(z + 1 / STEPS))

    def at(p: np.ndarray, n: np.ndarray, share: float, up: bool) -> float:
        """The quantile of values that come ``n`` times each."""
        order = np.argsort(p, kind="stable")
        place = (n.sum() - 1) * share
        place = np.ceil(place - 1e-9) if up else np.floor(place + 1e-9)
        return float(p[order][np.searchsorted(np.cumsum(n[order]), place, "right")])

    # A step counts from its lower edge for secrets, to its upper edge for others.
    least = at(low[secret], n[secret], 1 - RECALL, False)
    quiet = at(high[~secret], n[~secret], 1 - FALSE_ALARMS, True)
    # Recall bounds it from above; where the classes are apart it lies between them.
    model.threshold = (least + quiet) / 2 if quiet < least else least
    model.alarms = float(n[~secret & (low >= model.threshold)].sum() / n[~secret].sum())


def _stretch(x: np.ndarray, ordinary: np.ndarray, secret: bool, g: np.random.Generator) -> None:
    """Fill the inside with a run of ordinary characters, a secret somewhere in it."""
    inside = slice(AROUND, AROUND + INSIDE)
    own, other = x[inside][x[inside] > 0], ordinary[inside][ordinary[inside] > 0]
    if not secret:
        x[inside] = np.resize(own, INSIDE)
    elif len(own) < INSIDE - 8:
        at = g.integers(0, INSIDE - len(own) + 1)
        x[inside] = np.resize(other, INSIDE)
        x[AROUND + at : AROUND + at + len(own)] = own


def _findings(batches):
    for batch in batches:
        texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
        for _, scan in _groups(texts):
            for k in range(0, len(scan.a), 4096):
                codes = scan.windows(np.arange(k, min(k + 4096, len(scan.a))))
                flat = codes.ravel()
                ends = np.arange(1, len(codes) + 1) * codes.shape[1]
                key = hashes(flat, ends - codes.shape[1], ends, BYTES).view(np.int64)
                yield pa.record_batch(
                    [pa.array(key), pa.array(scan.label[k : k + 4096]), pa.array([c.tobytes() for c in codes], pa.binary())],
                    ["key", "secret", "codes"],
                )


def _codes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 2 * AROUND + INSIDE)


def _taught(sent, epochs: int, turn: int):
    """A block's findings to the weights that they teach."""

    def run(block: pa.Table) -> pa.Table:
        # Keys are hashes: their order is a fixed shuffle.
        block = block.sort_by([("key", "ascending"), ("secret", "ascending")])
        secret = block["secret"].to_numpy().astype(bool)
        model = teach(sent.value, _codes(block["codes"]), secret, epochs, 11 + turn)
        return pa.table({"weights": pa.array([model.flat().tolist()], pa.list_(pa.float32()))})

    return run


def _judged(sent):
    """Findings to steps of their scores."""

    def run(batches):
        for batch in batches:
            z = sent.value.logits(_codes(batch.column(1))) if len(batch) else np.zeros(0)
            step = np.floor(np.clip(z, -FAR, FAR) * STEPS).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.array(step)], ["secret", "step"])

    return run


def _dealt(own: DataFrame, sizes: dict[bool, int]) -> tuple[DataFrame, int]:
    """Findings with the number of their ``block``, and how many blocks there are."""
    blocks = -(-sum(sizes.values()) // BLOCK)
    # Of a rare kind each finding is in several blocks, in all of them at most.
    copies = {kind: min(blocks, -(-LEAST * blocks // n)) for kind, n in sizes.items()}
    number = F.pmod(F.xxhash64("key", "secret"), F.lit(blocks))
    places = F.sequence(F.lit(0), F.when(F.col("secret"), copies[True]).otherwise(copies[False]) - 1)
    block = F.explode(F.transform(places, lambda i: F.pmod(number + i, F.lit(blocks)).cast("int"))).alias("block")
    return own.select("key", "secret", "codes", block), blocks


def learn(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> Network:
    """The network, from all findings in ``docs``; equal findings count once."""
    lean_batches(spark)
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _findings, "key bigint, secret boolean, codes binary"
    )
    findings = stored(spark, found.dropDuplicates(["key", "secret"]), "findings")
    held = F.pmod(F.xxhash64(F.lit("held"), "key"), F.lit(4)) == 0
    own = findings.filter(~held)
    sizes = {True: 0, False: 0} | {r.secret: r["count"] for r in own.groupBy("secret").count().collect()}
    model = Network.fresh()
    if min(sizes.values()) < 8:
        return model
    dealt, blocks = _dealt(own, sizes)
    rounds = 1 if blocks == 1 else ROUNDS
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        # Few bytes and much work: a number of tasks that is not lowered.
        spread = dealt.repartition(blocks, "block").groupBy("block")
        copies = spread.applyInArrow(_taught(sent, EPOCHS // rounds, turn), "weights array<float>")
        # One row for each weight of the network.
        average = copies.select(F.posexplode("weights").alias("at", "w")).groupBy("at").agg(F.avg("w").alias("w"))
        model = Network.of([r.w for r in sorted(average.collect())])
        sent.destroy()
    sent = spark.sparkContext.broadcast(model)
    steps = findings.filter(held).select("secret", "codes").mapInArrow(_judged(sent), "secret boolean, step int")
    # At most 4 * STEPS * FAR counts.
    rows = sorted(steps.groupBy("secret", "step").count().collect())
    sent.destroy()
    _calibrate(model, *(np.array([r[k] for r in rows], kind) for k, kind in ((1, float), (0, bool), (2, float))))
    return model


_SCAN = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_model bigint"
)


def _joined(spans: list[tuple[int, int, str]]) -> str:
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in order)


def _scan(sent):
    names = [f.split()[0] for f in _SCAN.split(", ")]

    def run(batches):
        model = sent.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            rows = []
            for _, scan in _groups(texts):
                spans = [[(*scan.points(k, a, b), kind) for a, b, kind in own] for k, own in enumerate(scan.rules)]
                base = [_joined(own) for own in spans]
                counts = [[sum(s[2] == kind for s in own) for kind in KINDS[:3]] for own in spans]
                added = np.zeros(len(spans), np.int64)
                if model.threshold <= 1:
                    hit = []
                    for k in range(0, len(scan.a), 4096):
                        free = np.flatnonzero(~scan.label[k : k + 4096]) + k
                        if len(free):
                            hit.append(free[model.probability(scan.windows(free)) >= model.threshold])
                    for own, start, end in scan.spans(np.concatenate(hit)) if hit else ():
                        spans[own].append((start, end, "model"))
                        added[own] += 1
                for own, plain, count, more in zip(spans, base, counts, added):
                    rows.append((*count, hashlib.sha256(plain.encode()).hexdigest(), _joined(own), int(more)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    return run


def scan(
    spark: SparkSession, docs: DataFrame, model: Network | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts and spans of secrets for every row; learns a network unless one is given.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model``; spans are
    ``kind:start:end`` joined by commas.
    """
    lean_batches(spark)
    sent = spark.sparkContext.broadcast(model or learn(spark, docs, text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(sent), _SCAN)
