"""Personal data: the rules against plain patterns, positions, learning, redaction."""

import hashlib
import random
import re
import time

import numpy as np

from maskflow.llm import private_data
from tests.llm.conftest import TEXTS, clashing


def plain(text):
    """The rules by Python's own patterns."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or ""):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text or ""):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text or ""):
        digits = [int(c) for c in m.group() if c.isdigit()]
        twice = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text or ""):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return ",".join(f"{private_data.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def scanned(spark, texts, model=None):
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS)
    return {r.doc_id: r for r in private_data.scan(spark, docs, model or private_data.Trees()).collect()}


def test_rules_on_random_text(spark):
    random.seed(4)
    letters = "0123456789" * 3 + " ..--++()@aZ_%éx😀\n"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 80))) for _ in range(3000)]
    texts += [
        None, "", "12" * 9, "4111 1111 1111 1111 1.2.3.4.5.6.7.8 000255.1.1.1 256.1.1.1.1.1", "a@b.c.d_e@f.g h@i.j@k.l",
        "+1234567890123456", "+12 (((34)))567-89", "é😀 x@y.zz 4111-1111-1111-1111",
    ]
    found = scanned(spark, texts)
    for k, text in enumerate(texts):
        assert found[k].spans == plain(text), text
        assert found[k].base_sha256 == hashlib.sha256(plain(text).encode()).hexdigest()


def test_long_texts_take_linear_time(spark):
    texts = ["1.2.3.4 " * 50_000, "a" * 1_000_000, "1" * 1_000_000, "+1 " * 200_000, "1 " * 300_000, "a@b.c " * 20_000]
    begun = time.monotonic()
    found = scanned(spark, texts)
    assert [found[k].n_ip for k in range(6)] == [50_000, 0, 0, 0, 0, 0] and found[5].n_email == 20_000
    assert time.monotonic() - begun < 120


def numbers(spark):
    """Texts with cards and phones by the rule, some of them side by side, and other numbers."""
    rng = np.random.default_rng(2)

    def card():
        digits = [4, *rng.integers(0, 10, 14)]
        odd = sum(d * 2 - 9 * (d > 4) if k % 2 == 0 else d for k, d in enumerate(digits))
        return "".join(map(str, [*digits, -odd % 10]))

    phone = lambda: f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
    texts = []
    for k in range(900):
        texts.append((f"ring {phone()} now", f"pay with {card()} please", f"order {rng.integers(10**8, 10**9)} came", f"host {k % 250}.7.8.9 up")[k % 4])
    texts += [f"take {phone()} {card()} today" for _ in range(5)]
    return texts


def test_trees_find_what_neighbours_hide(spark):
    texts = numbers(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(4)
    model = private_data.learn(spark, docs)
    assert model.thresholds
    rows = scanned(spark, texts, model)
    for k in range(900, 905):
        assert rows[k].n_card == rows[k].n_phone == 0
        assert rows[k].n_model == 2
        spans = [tuple(map(int, s.split(":")[1:])) for s in rows[k].spans.split(",")]
        assert {len(re.sub("[^0-9]", "", texts[k][a:b])) for a, b in spans} == {11, 16}
    # Ordinary numbers are left alone, base spans stay.
    assert sum(rows[k].n_model for k in range(900)) == 0
    assert all(rows[k].spans == plain(texts[k]) for k in range(900))


def test_all_rows_of_measures_are_learnt_from(spark, monkeypatch):
    """Whatever the driver may hold: with more rows Spark adds up the same sums."""
    docs = spark.createDataFrame(list(enumerate(numbers(spark))), TEXTS).repartition(4)
    monkeypatch.setattr(private_data, "TREES", 3)
    whole = private_data.learn(spark, docs)
    monkeypatch.setattr(private_data, "VECTORS", 3)
    spread = private_data.learn(spark, docs)

    def cuts(tree):
        return (*tree[:2], cuts(tree[2]), cuts(tree[3])) if isinstance(tree, tuple) else round(tree, 9)

    assert len(whole.trees) == 3 and [cuts(t) for t in whole.trees] == [cuts(t) for t in spread.trees]
    assert whole.thresholds.keys() == spread.thresholds.keys() and np.allclose(whole.scale, spread.scale, atol=0.02)
    assert np.allclose(list(whole.thresholds.values()), list(spread.thresholds.values()), atol=0.02)


def test_conditions_are_the_trees(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    rows = rng.integers(0, 6, (400, 14))
    good = ((rows[:, 1] > 2) & (rows[:, 5] < 4)).astype(int) * 3
    model = private_data.train(rows, good, 3 - good, np.arange(400) % 4 == 0)
    frame = spark.createDataFrame([(r.tolist(),) for r in rows], "f array<int>")
    assert np.allclose([r[0] for r in frame.select(model.column(F.col("f"))).collect()], model.probability(rows))
    held = np.arange(400) % 4 == 0
    assert ((model.probability(rows[held]) > 0.5) == (good[held] > 0)).mean() > 0.97


def test_redaction_keeps_other_columns(spark):
    docs = clashing(spark.createDataFrame([(1, "ä a@b.cd, 1.2.3.4!"), (2, None), (3, "")], TEXTS))
    out = private_data.redact(spark, docs, private_data.Trees())
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "ä [EMAIL], [IP]!" and rows[2].text is None and rows[3].text == "" and rows[1]["a b"] == 7


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], TEXTS)
    assert private_data.scan(spark, empty).collect() == []
    assert not private_data.learn(spark, spark.createDataFrame([(1, "no numbers"), (1, "no numbers")], TEXTS)).thresholds


def test_no_python_in_the_plan(spark, documents):
    model = private_data.Trees(0.1, [(1, 3, 0.5, -0.5)], (0.0, 1.0), {0: 0.5})
    plan = private_data.scan(spark, documents, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
