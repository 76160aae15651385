"""Quality classifier by co-training two views of a document.

One logistic classifier sees the text only, the other the page's metadata only. Over
some rounds each names the unlabelled documents that it is most sure of, and the
other learns from them. Both are then calibrated on labelled documents that neither
has learnt from, their calibrated log odds are added up, and every document is scored.

In every round both views look at all unlabelled documents, in one pass over their
whole texts. Counts of the log odds in narrow steps give, for each view and class, the
place from which a document belongs to the most certain share; those documents are the
round's pseudo-labels. The classifiers are fitted on bounded samples (``LABELLED``
labelled rows, and of each kind of pseudo-label ``TAUGHT`` rows a round, chosen by
hash of id and text, so they are even and repeatable).
The threshold is one half, or lower where ``KEEP_GOOD`` of the good calibration rows
would not stay otherwise.

Defined cases: a null text is empty, null metadata is a value of its own. Documents
without words are scored like others. Labels that are null, or contradict one another
for one id, are left out. With labels of one kind only, or none, nothing can be
learnt: scores are the share of good labels (one half without any) and no row is
rejected. Repeated ids each get their score; rows that repeat id and text count once in
learning, and all texts under a labelled id have its label. Extra columns are kept out of the way
by numbering the ones that are used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.llm.tables import drop_stored, lean_batches, stored
from maskflow.llm.words import SPACE, mix, word_hashes

#: Rows that the classifiers may learn from; the bound of the sample that is collected.
LABELLED = 5_000
#: Of each view's and class's pseudo-labels of a round, the rows that the fit sees.
TAUGHT = 500
ROUNDS = 3
#: Of the unlabelled rows, the share that each view passes on in a round, by class.
SURE = 0.05
#: Log odds beyond which a view is sure: 0.95 against 0.05.
CERTAIN = float(np.log(0.95 / 0.05))
#: Log odds are counted in steps of 1 / STEPS, up to FAR on either side.
STEPS, FAR = 64, 60
KEEP_GOOD = 0.995
#: How strongly weights are drawn to zero.
PULL = 1e-4
WORD_BUCKETS = 1 << 12
META_BUCKETS = 1 << 10
_SHAPES = 16
#: Features that a sum over rows takes at once, for the memory of the driver and of tasks.
AT_ONCE = 1 << 16
#: Measures that are also given in steps, so that a middle value can count by itself.
_STEPPED, _STEPS = (2, 3, 5, 9, 11, 12, 15), 8
_FORM = _SHAPES + len(_STEPPED) * _STEPS
#: A single word says less than the form of a text, in a short text above all.
WORD_WEIGHT = 0.3
TEXT_SIZE = 256 + _FORM + WORD_BUCKETS


def _shape(raw: bytes, words: np.ndarray) -> np.ndarray:
    """Measures of form: length, repetition, line structure, kinds of characters; some in steps."""
    lines = raw.split(b"\n")
    n = max(1, len(words))
    buffer = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(buffer, minlength=256) if len(buffer) else np.zeros(256)
    size = max(1, len(buffer))
    upper, lower, digit = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    other = kinds[33:127].sum() - upper - lower - digit
    again = float((words[1:] == words[:-1]).sum()) / n
    found = np.array(
        [
            1.0,
            np.log1p(len(words)) / 8,
            len(np.unique(words)) / n,
            len(set(lines)) / len(lines),
            np.log1p(len(lines)) / 5,
            (size - kinds[SPACE].sum()) / n / 10,
            upper / size, lower / size, digit / size, other / size,
            kinds[128:].sum() / size,
            other / n, upper / n, digit / n,
            float(len(words) == 0),
            again,
        ]
    )
    steps = np.zeros((len(_STEPPED), _STEPS))
    at = np.clip(found[list(_STEPPED)] * _STEPS, 0, _STEPS - 1).astype(int)
    steps[np.arange(len(_STEPPED)), at] = 1
    return np.concatenate([found, steps.ravel()])


def text_rows(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse features of texts: characters, shape and hashed words."""
    out = []
    for group in word_hashes(texts):
        for words in group:
            raw = texts[len(out)]
            kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
            chars = np.flatnonzero(kinds)
            weight = np.sqrt(kinds[chars] / max(1, len(raw)))
            buckets, count = np.unique(words >> np.uint64(52), return_counts=True)
            part = WORD_WEIGHT * np.sqrt(count / max(1, len(words)))
            out.append(
                (
                    np.concatenate([chars, np.arange(256, 256 + _FORM), buckets.astype(np.int64) + 256 + _FORM]),
                    np.concatenate([weight, _shape(raw, words), part]).astype(np.float32),
                )
            )
    return out


def meta_rows(columns: list[list]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each metadata column's value, numbers by powers of about 1.4, hashed to a bucket."""
    keys = []
    for k, values in enumerate(columns):
        seen: dict = {}
        for v in values:
            if v not in seen:
                plain = v
                if isinstance(v, (int, float)) and not isinstance(v, bool):
                    plain = "nan" if v != v else round(2 * float(np.log2(1 + min(abs(v), 1e300)))) * (1 if v >= 0 else -1)
                code = int.from_bytes(f"{k}:{plain}".encode(), "little") % ((1 << 61) - 1)
                seen[v] = int(mix(np.array([code], np.uint64))[0] % np.uint64(META_BUCKETS - 1)) + 1
        keys.append([seen[v] for v in values])
    if not keys:
        return []
    return [(np.array([0, *own]), np.ones(len(own) + 1, np.float32)) for own in zip(*keys)]


class Sparse:
    """Rows of sparse features, end to end; sums take ``AT_ONCE`` of them, in their order."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], size: int):
        self.size = size
        self.at = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
        self.values = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.float32)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) for r in rows])
        self.n = len(rows)

    def _sum(self, factors: np.ndarray, of: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        total = np.zeros(size)
        for k in range(0, len(to), AT_ONCE):
            part = slice(k, k + AT_ONCE)
            np.add.at(total, to[part].astype(np.intp), factors[of[part]] * self.values[part])
        return total

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return self._sum(weights, self.at, self.row, self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return self._sum(errors, self.row, self.at, self.size)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(
    rows: Sparse, target: np.ndarray, weight: np.ndarray, steps: int = 150, even: bool = True
) -> np.ndarray:
    """Logistic weights by Adam on the whole sample; ``even`` gives classes equal weight."""
    w, m, v = np.zeros(rows.size), np.zeros(rows.size), np.zeros(rows.size)
    good = target > 0.5
    balance = np.where(good, 0.5 / max(weight[good].sum(), 1e-9), 0.5 / max(weight[~good].sum(), 1e-9))
    balance = balance if even else np.full(len(target), 1 / weight.sum())
    for t in range(1, steps + 1):
        g = rows.back(balance * weight * (sigmoid(rows.dot(w)) - target)) + PULL * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def _plane(z: np.ndarray) -> Sparse:
    """Dense columns as rows that ``fit`` takes, with a constant."""
    full = np.column_stack([np.ones(len(z)), z])
    return Sparse([(np.arange(full.shape[1]), row) for row in full], full.shape[1])


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    scale: np.ndarray  # of each view: offset and slope
    joint: np.ndarray
    threshold: float

    def views(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        z = np.column_stack([text, meta])
        return self.scale[:, 0] + self.scale[:, 1] * z

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return sigmoid(self.joint[0] + self.views(text, meta) @ self.joint[1:])


def train(text: list, meta: list, label: np.ndarray, exchange=None) -> Model:
    """Co-train on rows of both views; ``label`` is 1, 0, or -1 where unknown.

    ``exchange`` takes the weights of both views and gives ``(view, row, target)`` for
    each document that a view is sure of; it may append rows to ``text`` and ``meta``.
    Without it the documents are those of unknown label.
    """
    known = np.flatnonzero(label >= 0)
    share = float(label[known].mean()) if len(known) else 0.5
    if share in (0.0, 1.0) or len(known) < 10 or not len(known):
        bias = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model(np.zeros(TEXT_SIZE), np.zeros(META_BUCKETS), np.zeros((2, 2)), np.array([bias, 0, 0]), 0.0)
    held = known[::4]  # for calibration only
    own = np.setdiff1d(known, held)
    if len(set(label[own])) < 2 or len(set(label[held])) < 2:
        own = held = known
    views = [(text, TEXT_SIZE), (meta, META_BUCKETS)]
    exchange = exchange or _among(views, np.flatnonzero(label < 0))
    taught = [{i: float(label[i]) for i in own.tolist()} for _ in views]
    weights = [np.zeros(size) for _, size in views]
    for turn in range(ROUNDS + 1):
        for k, (rows, size) in enumerate(views):
            at = list(taught[k])
            trust = np.where(np.arange(len(at)) < len(own), 1.0, 0.5)
            target = np.array(list(taught[k].values()))
            weights[k] = fit(Sparse([rows[i] for i in at], size), target, trust)
        passed = [] if turn == ROUNDS else list(exchange(weights))
        if not passed:
            break
        for k, i, y in passed:
            taught[1 - k][i] = y
    seen = np.column_stack(
        [Sparse([rows[i] for i in held], size).dot(w) for (rows, size), w in zip(views, weights)]
    )
    target, ones = label[held].astype(float), np.ones(len(held))
    scale = np.array([fit(_plane(seen[:, [k]]), target, ones, 400, even=False) for k in range(2)])
    # The calibrated log odds of both views add up, the odds beforehand counted once; a
    # view that knows nothing changes nothing.
    before = np.log(target.sum() / (len(target) - target.sum()))
    model = Model(weights[0], weights[1], scale, np.array([-before, 1.0, 1.0]), 0.5)
    score = model.score(seen[:, 0], seen[:, 1])
    # Never above one half: what is good more likely than not stays.
    model.threshold = min(0.5, float(np.quantile(score[target > 0.5], 1 - KEEP_GOOD, method="lower")))
    return model


def _among(views: list, free: np.ndarray):
    """The exchange among rows at hand: of ``free``, those that a view is really sure of."""

    def pick(weights):
        n = max(1, int(SURE * len(free)))
        for k, (rows, size) in enumerate(views if len(free) else []):
            z = Sparse([rows[i] for i in free], size).dot(weights[k])
            order = np.argsort(z, kind="stable")
            # A view that knows little passes nothing on.
            yield from ((k, int(free[i]), 1.0) for i in order[-n:] if z[i] > CERTAIN)
            yield from ((k, int(free[i]), 0.0) for i in order[:n] if z[i] < -CERTAIN)

    return pick


def _features():
    """Features of rows ``key, label, text, metadata``; a key is sent once by a task."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            fresh = []
            for key in batch.column(0).to_pylist():
                fresh.append(key not in sent)
                sent.add(key)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            meta = meta_rows([c.to_pylist() for c in batch.columns[3:]])
            rows = text_rows(texts)
            meta = meta or [(np.zeros(1, np.int64), np.ones(1, np.float32))] * len(rows)
            packed = [
                [a.astype(np.int32).tobytes() for a, _ in rows], [b.tobytes() for _, b in rows],
                [a.astype(np.int32).tobytes() for a, _ in meta],
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *(pa.array(p, pa.binary()) for p in packed)],
                ["key", "label", "at", "value", "meta"],
            )

    return run


def _log_odds(sent):
    """``key, id, text, metadata`` to the log odds of both views."""

    def run(batches):
        weights = sent.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            meta = meta_rows([c.to_pylist() for c in batch.columns[3:]])
            meta = meta or [(np.zeros(1, np.int64), np.ones(1, np.float32))] * len(texts)
            z = [Sparse(text_rows(texts), TEXT_SIZE).dot(weights[0]), Sparse(meta, META_BUCKETS).dot(weights[1])]
            yield pa.record_batch([*batch.columns[:2], *map(pa.array, z)], ["_key", "_id", "_z0", "_z1"])

    return run


def _scores(sent):
    def run(batches):
        model = sent.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            meta = meta_rows([c.to_pylist() for c in batch.columns[3:]])
            meta = meta or [(np.zeros(1, np.int64), np.ones(1, np.float32))] * len(texts)
            a = Sparse(text_rows(texts), TEXT_SIZE).dot(model.text)
            b = Sparse(meta, META_BUCKETS).dot(model.meta)
            view = sigmoid(model.views(a, b))
            score = model.score(a, b)
            yield pa.record_batch(
                [
                    batch.column(0), pa.array(view[:, 0]), pa.array(view[:, 1]), pa.array(score),
                    pa.array(score >= model.threshold),
                ],
                ["doc_id", "p_text", "p_meta", "p_good", "kept"],
            )

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str, meta_cols: list[str], label) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("_id"),
        label.cast("int").alias("_label"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
        *(F.col(f"`{c}`").alias(f"_m{k}") for k, c in enumerate(meta_cols)),
    )


def _key(id_col: str, text_col: str):
    """Tells rows apart by id and text."""
    return F.xxhash64(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))


def _below(rows: int, limit: int) -> int:
    """A bound on even hashes that little more than ``limit`` of ``rows`` rows stay below."""
    share = min(1.0, (1.2 * limit + 200) / max(1, rows))
    return min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1)


def _lowest(keys: DataFrame, limit: int) -> DataFrame:
    """The keys with the lowest hashes, ``limit`` at most; keys are distinct."""
    hashed = keys.withColumn("_h", F.xxhash64("_key")).filter(F.col("_h") <= _below(keys.count(), limit))
    return hashed.orderBy("_h", "_key").limit(limit).drop("_h")


def _step(z):
    return F.floor(F.greatest(F.least(z, F.lit(float(FAR))), F.lit(-float(FAR))) * STEPS)


def _sure(free: DataFrame) -> DataFrame | None:
    """Of ``free`` (``_key, _z0, _z1``): the pseudo-labels of both views, ``_key, slot``.

    Slot ``2 * view + class``. All of the most certain share are found by counts of
    steps, whole steps at a time; ``TAUGHT`` of each slot stay.
    """
    steps = F.explode(F.array(*(F.struct(F.lit(k).alias("view"), _step(F.col(f"_z{k}")).alias("step")) for k in range(2))))
    counted = free.select(steps.alias("s")).groupBy("s.view", "s.step").count().collect()  # 2 * STEPS * 2 * FAR at most
    slots = []
    for k in range(2):
        own = sorted((r.step, r["count"]) for r in counted if r.view == k)
        wanted = max(1, int(SURE * sum(n for _, n in own)))
        for y, ordered in ((0, own), (1, own[::-1])):
            total = 0
            for step, n in ordered:
                total += n
                if total >= wanted:
                    break
            else:
                return None  # no unlabelled document
            z = F.col(f"_z{k}")
            sure = z > CERTAIN if y else z < -CERTAIN
            slots.append(sure & ((_step(z) >= step) if y else (_step(z) <= step)))
    sizes = free.agg(*(F.count_if(c).alias(f"s{n}") for n, c in enumerate(slots))).first()
    hashed = F.xxhash64("_key")
    named = [F.when(c & (hashed <= _below(sizes[n], TAUGHT)), F.lit(n)) for n, c in enumerate(slots)]
    rows = free.select("_key", F.explode(F.array(*named)).alias("slot")).filter("slot is not null")
    first = Window.partitionBy("slot").orderBy(F.xxhash64("_key"), "_key")
    return rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= TAUGHT).drop("_n")


def learn(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: list[str] | None = None,
    label_col: str = "quality",
) -> Model:
    """The model that both views learn from each other over all unlabelled documents."""
    lean_batches(spark)
    meta_cols = meta_cols or []
    key = _key(id_col, text_col)
    clear = (
        labels.select(F.col(id_col).cast("bigint").alias("_lid"), F.col(label_col).cast("int").alias("_y"))
        .filter("_y in (0, 1) and _lid is not null").groupBy("_lid")
        .agg(F.min("_y").alias("_y"), F.max("_y").alias("_top")).filter("_y = _top").select("_lid", "_y")
    )
    clear = stored(spark, clear, "quality-labels")
    # Keys first, texts of the chosen rows only after: no text is moved for the choice.
    ids = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_did"), key.alias("_key"))
    ids = ids.filter("_did is not null").distinct()
    known = stored(spark, ids.join(clear, F.col("_did") == F.col("_lid")).select("_key", "_y"), "quality-known")
    text, meta, row_of = [], [], {}

    def fetch(chosen: DataFrame) -> list[int]:
        """Append the features of chosen keys (``_key, _y``, bounded); their labels."""
        picked = docs.withColumn("_own", key).join(F.broadcast(chosen), F.col("_own") == F.col("_key"))
        plain = picked.select(
            "_own", F.col("_y").cast("int"), F.col(f"`{text_col}`").cast("string"),
            *(F.col(f"`{c}`").alias(f"_m{k}") for k, c in enumerate(meta_cols)),
        )
        rows = plain.mapInArrow(_features(), "key bigint, label int, at binary, value binary, meta binary")
        found = {r.key: r for r in rows.dropDuplicates(["key"]).collect()}
        # Keys are hashes: their order is a fixed shuffle.
        for k in sorted(found.keys() - row_of.keys()):
            row_of[k] = len(text)
            text.append((np.frombuffer(found[k].at, np.int32), np.frombuffer(found[k].value, np.float32)))
            own = np.frombuffer(found[k].meta, np.int32)
            meta.append((own, np.ones(len(own), np.float32)))
        return [found[k].label for k in sorted(found)]

    label = fetch(stored(spark, _lowest(known, LABELLED), "quality-sample"))

    def exchange(weights):
        sent = spark.sparkContext.broadcast(weights)
        plain = docs.select(
            key.alias("_key"), F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").cast("string"),
            *(F.col(f"`{c}`").alias(f"_m{k}") for k, c in enumerate(meta_cols)),
        )
        seen = plain.mapInArrow(_log_odds(sent), "_key bigint, _id bigint, _z0 double, _z1 double")
        each = seen.groupBy("_key").agg(*(F.min(c).alias(c) for c in ("_id", "_z0", "_z1")))
        free = stored(spark, each.join(clear, F.col("_id") == F.col("_lid"), "left_anti"), "quality-free")
        chosen = _sure(free)
        taught = [] if chosen is None else sorted(chosen.collect())  # 4 * TAUGHT rows at most
        if taught:
            keys = spark.createDataFrame(sorted({(r[0], -1) for r in taught}), "_key bigint, _y int")
            fetch(keys)
        drop_stored(spark, free)
        sent.unpersist()
        return [(slot // 2, row_of[k], float(slot % 2)) for k, slot in taught]

    return train(text, meta, np.array(label, int), exchange)


def score(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: list[str] | None = None,
    label_col: str = "quality",
) -> DataFrame:
    """``doc_id, p_text, p_meta, p_good, kept`` for every row of ``docs``."""
    model = learn(spark, docs, labels, id_col, text_col, meta_cols, label_col)
    lean_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = _numbered(docs, id_col, text_col, meta_cols or [], F.lit(None))
    return rows.mapInArrow(
        _scores(sent), "doc_id bigint, p_text double, p_meta double, p_good double, kept boolean"
    )


def keep_good(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: list[str] | None = None,
    label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their columns."""
    model = learn(spark, docs, labels, id_col, text_col, meta_cols, label_col)
    lean_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    used = [text_col, *(meta_cols or [])]

    def run(batches):
        value = sent.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(used[0]).cast(pa.binary()).to_pylist()]
            meta = meta_rows([batch.column(c).to_pylist() for c in used[1:]])
            meta = meta or [(np.zeros(1, np.int64), np.ones(1, np.float32))] * len(texts)
            a = Sparse(text_rows(texts), TEXT_SIZE).dot(value.text)
            b = Sparse(meta, META_BUCKETS).dot(value.meta)
            yield batch.filter(pa.array(value.score(a, b) >= value.threshold))

    return docs.mapInArrow(run, docs.schema)
