"""Personal data by candidate gradient boosting: wide generators, boosted trees, thresholds.

Four base rules find mail addresses, network addresses, card and phone numbers; what they
find stays. Beside them generators that ask for less propose spans, which may overlap each
other and the rules' own. Boosted trees judge each by its format (digits, groups, check
digit, leading figure ...) and context (the characters beside it, a naming word before it).
Those above the threshold of their generator that touch nothing already chosen are added,
best first. So a card number is found that the rules lose because another number stands one
space before it, and an address written as ``name (at) host``.

The trees learn from the rules: a candidate that is exactly a finding is private, any other
is not. Candidates of all documents are counted by their measures first, so rows of equal
measures are one, and all such rows are fitted: up to ``VECTORS`` on the driver, more where
they lie, by sums of slopes over every measure's values, a pass for each level of a tree.
A quarter of the documents, by hash, is held back. On it the scores are
calibrated, and a generator's threshold is the lowest at which ``PRECISION`` of what lies
above is private; a generator that cannot reach this adds nothing. Nothing that tells
how a rule's own span was cut off is a measure, so what a rule loses by its
neighbours looks to the trees like what it finds.

Built-in functions only: matches and the text between them give all positions, trees are
nested conditions. The patterns are linear in a text's length: they begin only where a run
begins, and repeat without going back.

Defined cases: null text is empty. Without findings nothing is learnt and nothing added.
Positions are code points, ends are exclusive. Repeated rows each give a row; other columns
are ignored, ``redact`` keeps them as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import drop_stored, stored

KINDS = ("email", "ip", "card", "phone", "model")
#: Distinct rows of measures that the driver fits by itself. Of more, Spark adds up what the
#: trees need and the driver sees the sums only; the trees learn from all rows either way.
VECTORS = 20_000
#: What rounding may make of equal gains.
NEAR = 1e-9
#: A measure is a whole number below this.
VALUES = 41
#: Log odds of a table's rows are counted in steps of 1 / STEPS, up to FAR on either side.
STEPS, FAR = 256, 40.0
#: Share of private ones that a threshold asks for among held-back candidates above it.
PRECISION = 0.9
TREES, DEPTH, RATE, LEAST_LEAF, PULL = 40, 3, 0.3, 5.0, 1.0
#: Characters of context that are looked at on either side.
AROUND = 24
#: A matches only where the word before it could not have begun earlier: a run's first
#: character, or the end of the match before.
_MAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
_BASE = {
    "email": _MAIL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    # The whole chain of digits, if it has 12 to 19 of them.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9])",
}
_GENERATORS = {
    "address": _MAIL
    + r"(?:\x20?@\x20?|\x20?[\[(](?i:at)[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[A-Za-z0-9-]++)++",
    "quad": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?!\.?[0-9])",
    "digits": r"(?<![0-9])[0-9]{9,19}+(?![0-9])",
    "fours": r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}(?![0-9])",
    "dialled": r"(?<![0-9])\+?(?:[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
}
#: Words that announce personal data.
_CUES = (
    r"(?i)(?:e-?mail|contact|phone|tel|fax|mobile|cell|call|card|visa|account|iban|address|host|server|\bip\b)"
    r"[^A-Za-z0-9]{0,3}(?:[a-z]{1,6}[^A-Za-z0-9]{0,3})?$"
)


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def add(total: Column, k: Column) -> Column:
        twice = F.substr(digits, F.length(digits) - k + 1, F.lit(1)).cast("int") * (F.lit(2) - k % 2)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    return _luhn(_digits(found)) if kind == "card" else F.lit(True)


def _sign(char: Column) -> Column:
    """The kind of a character: none, space, letter, digit, point, mark of a value, other."""
    return (
        F.when(F.coalesce(char, F.lit("")) == "", 0)
        .when(char.rlike(r"\s"), 1)
        .when(char.rlike(r"[0-9]"), 3)
        .when(char.rlike(r"[\p{L}_]"), 2)
        .when(char.isin(".", ",", ";", "!", "?"), 4)
        .when(char.isin('"', "'", "=", ":", "/", "#", "&"), 5)
        .otherwise(6)
    )


def _measures(generator: int, found: Column, before: Column, after: Column) -> Column:
    """What the trees look at, as small whole numbers."""
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    size = lambda group: F.coalesce(F.length(group), F.lit(0))
    capped = lambda value, top: F.least(value, F.lit(top))
    last = F.regexp_extract(found, "([A-Za-z]+)$", 1)
    checked = F.length(digits).between(12, 19) & _luhn(digits)
    parts = [
        F.lit(generator),
        capped(F.length(digits), 24),
        capped(F.length(found) - F.length(digits), 40),
        F.when(checked, 1).otherwise(0),
        capped(F.size(groups), 8),
        capped(size(F.get(groups, F.lit(0))), 19),
        capped(size(F.get(groups, F.size(groups) - 1)), 19),
        # Of quads, whether a part is above 255.
        F.when(F.exists(groups, lambda g: (F.length(g) < 10) & (F.left(g, F.lit(9)).try_cast("int") > 255)), 1).otherwise(0),
        F.coalesce(F.left(digits, F.lit(1)).try_cast("int"), F.lit(10)),
        capped(F.length(last), 12),
        capped(F.size(F.split(found, r"\.")) - 1, 6),
        _sign(F.right(before, F.lit(1))),
        _sign(F.left(after, F.lit(1))),
        F.when(F.right(before, F.lit(AROUND)).rlike(_CUES), 1).otherwise(0),
    ]
    return F.array(*(p.cast("int") for p in parts))


def _spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``base`` (start, end, kind) and ``wide`` (start, end, measures).

    A pattern's matches and the parts between them alternate, so a match starts behind all
    that came before. Their lengths are added up by blocks of about the square root of
    their number: a text may have a great many.
    """
    kept = rows.columns
    patterns = _BASE | _GENERATORS
    any_digits = F.col(text).rlike("[0-9][0-9 ().+-]*[0-9]")
    gates = {k: any_digits for k in patterns} | {
        "email": F.col(text).contains("@"),
        "address": F.col(text).rlike(r"@|[\[(][aA][tT][\])]"),
        "phone": F.col(text).contains("+"),
    }
    cut = rows.select(
        *kept,
        *(F.when(gates[k], F.split(text, p, -1)).otherwise(F.array(F.lit(""))).alias(f"_p_{k}") for k, p in patterns.items()),
        *(F.when(gates[k], F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"_m_{k}") for k, p in patterns.items()),
    )
    long = cut.withColumns(
        {f"_l_{k}": F.zip_with(f"_p_{k}", f"_m_{k}", lambda a, b: F.length(a) + F.coalesce(F.length(b), F.lit(0))) for k in patterns}
    ).withColumns({f"_b_{k}": F.ceil(F.sqrt(F.size(f"_p_{k}"))).cast("int") for k in patterns})
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def within(k: str) -> Column:
        size = F.col(f"_b_{k}")
        return F.transform(F.sequence(F.lit(0), size), lambda i: total(F.slice(f"_l_{k}", i * size + 1, size)))

    def before(k: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(f"_b_{k}")), lambda i: total(F.slice(f"_s_{k}", F.lit(1), i)))

    blocks = long.withColumns({f"_s_{k}": within(k) for k in patterns})
    sums = blocks.withColumns({f"_t_{k}": before(k) for k in patterns})

    def start(k: str, i: Column) -> Column:
        block = F.floor(i / F.col(f"_b_{k}")).cast("int")
        own = total(F.slice(f"_l_{k}", block * F.col(f"_b_{k}") + 1, i - block * F.col(f"_b_{k}")))
        return F.get(f"_t_{k}", block) + own + F.length(F.get(f"_p_{k}", i))

    def placed(k: str, *more: Callable[[Column, Column], Column]) -> Column:
        def one(found: Column, i: Column) -> Column:
            at = start(k, i)
            return F.struct(at.alias("start"), (at + F.length(found)).alias("end"), *(m(found, i) for m in more))

        return F.transform(f"_m_{k}", one)

    def base(k: str, number: int) -> Column:
        tried = placed(k, lambda found, i: F.lit(number).alias("kind"), lambda found, i: _valid(k, found).alias("ok"))
        return F.transform(F.filter(tried, lambda s: s["ok"]), lambda s: s.dropFields("ok"))

    def wide(k: str, number: int) -> Column:
        def measures(found: Column, i: Column) -> Column:
            return _measures(number, found, F.get(f"_p_{k}", i), F.get(f"_p_{k}", i + 1)).alias("f")

        return placed(k, measures)

    return sums.select(
        *kept,
        F.array_sort(F.concat(*(base(k, n) for n, k in enumerate(_BASE))), _by_start).alias("base"),
        F.concat(*(wide(k, n) for n, k in enumerate(_GENERATORS))).alias("wide"),
    )


def _by_start(a: Column, b: Column) -> Column:
    less = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"]))
    more = (a["start"] > b["start"]) | ((a["start"] == b["start"]) & (a["kind"] > b["kind"]))
    return F.when(less, -1).when(more, 1).otherwise(0)


@dataclass
class Trees:
    """Boosted trees over small whole numbers, calibrated, with a threshold for each generator."""

    start: float = 0.0
    trees: list = field(default_factory=list)  # (measure, bound, left, right), or a leaf's value
    scale: tuple[float, float] = (0.0, 1.0)
    thresholds: dict[int, float] = field(default_factory=dict)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        def walk(tree, at: np.ndarray, out: np.ndarray) -> None:
            if not isinstance(tree, tuple):
                out[at] += tree
                return
            measure, bound, left, right = tree
            low = rows[at, measure] <= bound
            walk(left, at[low], out)
            walk(right, at[~low], out)

        out = np.full(len(rows), self.start)
        for tree in self.trees:
            walk(tree, np.arange(len(rows)), out)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale[0] + self.scale[1] * self.raw(rows))

    def raw_column(self, f: Column) -> Column:
        """:meth:`raw` as conditions on the measures ``f``."""

        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            measure, bound, left, right = tree
            return F.when(F.get(f, F.lit(measure)) <= bound, walk(left)).otherwise(walk(right))

        return reduce(lambda a, b: a + b, map(walk, self.trees), F.lit(float(self.start)))

    def column(self, f: Column) -> Column:
        """The calibrated probability of candidates with the measures ``f``."""
        raw = self.raw_column(f)
        return 1 / (1 + F.exp(-(F.lit(self.scale[0]) + F.lit(self.scale[1]) * raw)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _best(table: np.ndarray) -> tuple[int, int] | None:
    """The measure and bound that divide a node best, from its sums by measure and value."""
    g, h = table[0].sum(axis=0)
    best, cut = 1e-6, None
    for measure, own in enumerate(table):
        left_g, left_h = np.cumsum(own, axis=0).T
        right_g, right_h = g - left_g, h - left_h
        gain = left_g**2 / (left_h + PULL) + right_g**2 / (right_h + PULL) - g**2 / (h + PULL)
        gain[(left_h < 0.25 * LEAST_LEAF) | (right_h < 0.25 * LEAST_LEAF)] = 0
        # Of cuts that are equal but for rounding the first is taken, in whatever order was added.
        if gain.max() > best * (1 + NEAR):
            best, cut = float(gain.max()), (measure, int(np.argmax(gain >= gain.max() * (1 - NEAR))))
    return cut


def _grow(sums: Callable[[list[tuple]], list[np.ndarray]]):
    """One tree, level by level; ``sums`` gives the slopes and curves of nodes by measure and value.

    A node is the list of conditions that lead to it: measure, bound, whether below.
    """
    cuts, total, nodes = {}, {}, [()]
    for _ in range(DEPTH):
        deeper = []
        for node, table in zip(nodes, sums(nodes)):
            total.setdefault(node, table[0].sum(axis=0))
            if cut := _best(table):
                cuts[node] = cut
                left = table[cut[0], : cut[1] + 1].sum(axis=0)
                low, high = ((*node, (*cut, below)) for below in (True, False))
                total[low], total[high] = left, table[cut[0]].sum(axis=0) - left
                deeper += [low, high]
        if not deeper:
            break
        nodes = deeper

    def build(node: tuple):
        if node not in cuts:
            return -RATE * float(total[node][0] / (total[node][1] + PULL))
        cut = cuts[node]
        return (*cut, build((*node, (*cut, True))), build((*node, (*cut, False))))

    return build(())


class _Few:
    """Rows of measures at hand, with the number of private and other candidates of each."""

    def __init__(self, rows: np.ndarray, good: np.ndarray, bad: np.ndarray, held: np.ndarray):
        own = ~held
        self.held = rows[held], good[held].astype(float), bad[held].astype(float)
        self.x, self.yes, self.all = rows[own], good[own].astype(float), (good[own] + bad[own]).astype(float)

    def totals(self) -> list[float]:
        return [self.yes.sum(), (self.all - self.yes).sum(), self.held[1].sum(), self.held[2].sum()]

    def begin(self, start: float) -> None:
        self.z = np.full(len(self.x), start)

    def sums(self, nodes: list[tuple]) -> list[np.ndarray]:
        p = _sigmoid(self.z)
        slope, curve = self.all * p - self.yes, self.all * p * (1 - p) + 1e-9
        out = []
        for node in nodes:
            at = np.ones(len(self.x), bool)
            for measure, bound, below in node:
                at &= (self.x[:, measure] <= bound) == below
            of = lambda k: [np.bincount(self.x[at, k], part[at], VALUES) for part in (slope, curve)]
            out.append(np.array([np.transpose(of(k)) for k in range(self.x.shape[1])]))
        return out

    def add(self, tree) -> None:
        self.z += Trees(trees=[tree]).raw(self.x)

    def judged(self, model: Trees) -> tuple[np.ndarray, ...]:
        return self.held[0][:, 0], model.raw(self.held[0]), *self.held[1:]


class _Many:
    """The same of a table (``f, held, good, bad``): Spark adds up what the trees need."""

    def __init__(self, spark: SparkSession, vectors: DataFrame):
        self.spark, self.vectors, self.rows = spark, vectors, None

    def totals(self) -> list[float]:
        names = [F.sum(F.when(F.col("held") == held, F.col(c))) for held in (False, True) for c in ("good", "bad")]
        return [float(x or 0) for x in self.vectors.agg(*names).first()]

    def begin(self, start: float) -> None:
        self._keep(self.vectors.withColumn("z", F.lit(start)))

    def _keep(self, rows: DataFrame) -> None:
        before, self.rows = self.rows, stored(self.spark, rows, "candidate-scores")
        if before is not None:
            drop_stored(self.spark, before)

    def sums(self, nodes: list[tuple]) -> list[np.ndarray]:
        number = F.lit(None).cast("int")
        for k, node in enumerate(nodes):
            tests = [(F.get("f", F.lit(m)) <= bound) == F.lit(below) for m, bound, below in node]
            number = F.when(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(k)).otherwise(number)
        p, n = 1 / (1 + F.exp(-F.col("z"))), F.col("good") + F.col("bad")
        sloped = self.rows.filter(~F.col("held")).select(
            number.alias("node"), (n * p - F.col("good")).alias("g"), (n * p * (1 - p) + 1e-9).alias("h"),
            F.posexplode("f").alias("measure", "value"),
        )
        # At most nodes * measures * VALUES sums.
        found = sloped.groupBy("node", "measure", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found = found.filter("node is not null").collect()
        out = [np.zeros((1 + max((r.measure for r in found), default=0), VALUES, 2)) for _ in nodes]
        for r in found:
            out[r.node][r.measure, r.value] = r.g, r.h
        return out

    def add(self, tree) -> None:
        self._keep(self.rows.withColumn("z", F.col("z") + Trees(trees=[tree]).raw_column(F.col("f"))))

    def judged(self, model: Trees) -> tuple[np.ndarray, ...]:
        # Log odds in narrow steps, each by its lower edge, so no row of a step is below its edge.
        step = F.floor(F.greatest(F.least("z", F.lit(FAR)), F.lit(-FAR)) * STEPS) / STEPS
        held = self.rows.filter("held").groupBy(F.get("f", F.lit(0)).alias("g"), step.alias("s"))
        found = held.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("g", "s").collect()
        drop_stored(self.spark, self.rows)
        return tuple(np.array([r[k] for r in found], float) for k in ("g", "s", "good", "bad"))


def train(rows: np.ndarray, good: np.ndarray, bad: np.ndarray, held: np.ndarray) -> Trees:
    """Trees from rows of measures with the number of private and other candidates of each."""
    return _fit(_Few(rows, good, bad, held))


def _fit(side: _Few | _Many) -> Trees:
    model = Trees()
    good, bad, held_good, held_bad = side.totals()
    if min(good, bad, held_good, held_bad) < 10:
        return model
    model.start = float(np.log(good / bad))
    side.begin(model.start)
    for _ in range(TREES):
        model.trees.append(_grow(side.sums))
        side.add(model.trees[-1])
    generators, z, yes, no = side.judged(model)
    a, b = 0.0, 1.0
    for _ in range(400):
        error = (yes + no) * _sigmoid(a + b * z) - yes
        a -= 0.5 * float(error.sum() / (yes + no).sum())
        b -= 0.5 * float((error * z).sum() / ((yes + no) * (1 + z * z)).sum() + 1e-3 * (b - 1))
    model.scale = (a, b)
    p = _sigmoid(a + b * z)
    for generator in np.unique(generators).tolist():
        at = np.flatnonzero(generators == generator)
        at = at[np.argsort(-p[at], kind="stable")]
        share = np.cumsum(yes[at]) / np.cumsum(yes[at] + no[at])
        # Rows of equal probability lie on one side of a threshold.
        last = np.append(p[at][1:] != p[at][:-1], True)
        enough = np.flatnonzero((share >= PRECISION) & last)
        if len(enough):
            model.thresholds[int(generator)] = max(0.5, float(p[at][enough[-1]]) - 1e-9)
    return model


def learn(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> Trees:
    """The trees, from the candidates of all ``docs``."""
    found = _spans(docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")), "text")
    private = lambda c: F.exists("base", lambda s: (s["start"] == c["start"]) & (s["end"] == c["end"]))
    rows = found.select(
        (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held"),
        F.explode(F.transform("wide", lambda c: F.struct(c["f"].alias("f"), private(c).cast("int").alias("y")))).alias("c"),
    )
    counted = rows.groupBy("c.f", "held").agg(F.sum("c.y").alias("good"), F.sum(1 - F.col("c.y")).alias("bad"))
    vectors = stored(spark, counted, "candidate-vectors")
    count = vectors.count()
    if count > VECTORS:
        return _fit(_Many(spark, vectors))
    rows = vectors.orderBy("f", "held").collect()
    if not rows:
        return Trees()
    return train(
        np.array([r.f for r in rows]), np.array([r.good for r in rows]), np.array([r.bad for r in rows]),
        np.array([r.held for r in rows]),
    )


def _chosen(model: Trees) -> Column:
    """The candidates to add: above their threshold, free of the rules' spans and of better ones."""
    if not model.thresholds:
        return F.array().cast("array<struct<start:int,end:int,kind:int,p:double>>")
    touches = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    free = F.filter("wide", lambda c: ~F.exists("base", lambda s: touches(s, c)))

    def judged(c: Column) -> Column:
        bound = F.lit(2.0)
        for generator, least in model.thresholds.items():
            bound = F.when(F.get(c["f"], F.lit(0)) == generator, F.lit(least)).otherwise(bound)
        p = model.column(c["f"])
        number = F.lit(len(KINDS) - 1).alias("kind")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), number, F.when(p >= bound, p).alias("p"))

    good = F.filter(F.transform(free, judged), lambda c: c["p"].isNotNull())
    # Best first; then the longer, then the earlier one.
    rank = lambda c: F.struct(-c["p"], c["start"] - c["end"], c["start"])
    ordered = F.array_sort(good, lambda a, b: F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0))
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,p:double>>")
    return F.aggregate(
        ordered, empty, lambda kept, c: F.when(F.exists(kept, lambda k: touches(k, c)), kept).otherwise(F.concat(kept, F.array(c)))
    )


def find(spark: SparkSession, docs: DataFrame, model: Trees | None = None, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` as one struct ``row``, its ``text``, and the spans found.

    ``base`` has those of the rules, ``found`` all, both as ``start, end, kind`` (a number
    into ``KINDS``) by start, then kind; ``found`` also the probability of those added.
    """
    model = model or learn(spark, docs, text_col)
    named = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    spans = _spans(named, "text").withColumn("added", _chosen(model))
    sure = F.transform("base", lambda s: s.withField("p", F.lit(1.0).cast("double")))
    return spans.select("row", "text", "base", F.array_sort(F.concat(sure, F.col("added")), _by_start).alias("found"))


def _listed(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def scan(spark: SparkSession, docs: DataFrame, model: Trees | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of personal data for every row; learns trees unless some are given.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_model``; spans are
    ``kind:start:end`` joined by commas.
    """
    found = find(spark, docs, model, text_col)
    count = lambda spans, n: F.size(F.filter(spans, lambda s: s["kind"] == n)).cast("bigint")
    return found.select(
        F.col("row").getField(id_col).cast("bigint").alias("doc_id"),
        *(count("base", n).alias(f"n_{k}") for n, k in enumerate(KINDS[:4])),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("found").alias("spans"),
        count("found", len(KINDS) - 1).alias("n_model"),
    )


def redact(spark: SparkSession, docs: DataFrame, model: Trees | None = None, text_col: str = "text", mark: str = "[{}]") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind; null texts stay null.

    Of spans that overlap the first one names the kind, and all their characters go.
    """
    found = find(spark, docs, model, text_col)
    marks = F.array(*(F.lit(mark.format(k.upper())) for k in KINDS))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))

    def take(done: Column, s: Column) -> Column:
        piece = F.concat(F.substr("text", done["end"] + 1, s["start"] - done["end"]), F.get(marks, s["kind"]))
        parts = F.when(s["start"] >= done["end"], F.concat(done["parts"], F.array(piece))).otherwise(done["parts"])
        return F.struct(F.greatest(done["end"], s["end"]).alias("end"), parts.alias("parts"))

    rest = lambda done: F.concat(F.array_join(done["parts"], ""), F.substr("text", done["end"] + 1, F.length("text")))
    plain = F.aggregate("found", start, take, rest)
    text = F.when(F.col("row").getField(text_col).isNull(), None).otherwise(plain)
    return found.select(*((text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns))
