import random
from collections import Counter, defaultdict

import pytest

from maskflow.llm import components as components_module
from maskflow.llm import jaccard_join
from maskflow.llm.components import components
from maskflow.llm.jaccard_join import keep_one, near_classes
from tests.llm.conftest import TEXTS, clashing, words


def brute(rows, width, num, den):
    """Sizes and components by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for token in s:
            places[token].append(i)
    shared = Counter((a, b) for at in places.values() for k, b in enumerate(at) for a in at[:k])
    for (a, b), both in shared.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return Counter((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def check(spark, rows, width=4, num=85, den=100):
    df = clashing(spark.createDataFrame(rows, TEXTS))
    found = Counter(map(tuple, near_classes(spark, df, width, num, den).collect()))
    assert found == brute(rows, width, num, den)


def variants(seed, base, copies, edits):
    g = random.Random(seed)
    out = []
    for _ in range(copies):
        w = base.split()
        for _ in range(g.randint(0, edits)):
            w[g.randrange(len(w))] = f"x{g.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_links_lead_through_rows_without_an_id(spark):
    base = [f"w{i}" for i in range(200)]
    one, two, three = (" ".join(base[k : k + 180]) for k in (0, 8, 16))
    rows = [(3, one), (None, two), (None, two), (1, three), (None, "a b c d e f"), (None, "a b c d e f g h"), (None, None)]
    rows += [(None, f"{two} {k}") for k in range(3)]
    found = near_classes(spark, clashing(spark.createDataFrame(rows, TEXTS)), 4, 85, 100).collect()
    by_id = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert by_id == {1: 1, 3: 1} and len(found) == len(rows)
    assert sorted(str(r.component_id) for r in found if r.doc_id is None) == ["1"] * 5 + ["None"] * 3
    kept = keep_one(spark, spark.createDataFrame(rows, TEXTS), 4, 85, 100)
    assert kept.count() == len(rows) - 1 and kept.filter("doc_id = 1").count() == 1


def test_documents_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check(spark, rows)
    check(spark, rows, 5, 80, 100)


def test_near_the_threshold(spark):
    """Groups whose members pass or fail by one shingle, where hubs settle little."""
    g = random.Random(4)
    texts = []
    for seed in range(4):
        base = " ".join(f"w{g.randrange(400)}" for _ in range(g.choice([20, 60, 120])))
        texts += variants(seed, base, 25, 5)
    check(spark, list(enumerate(texts)))


def test_blocks_of_one_member(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(jaccard_join, "HUB_MEMBERS", 4)
    base = " ".join(f"w{i}" for i in range(60))
    check(spark, list(enumerate(variants(9, base, 40, 4))))


def test_one_passage_in_all_documents(spark):
    g = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"u{g.randrange(10**6)}" for _ in range(g.randint(0, 80))) for _ in range(120)]
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, ""), (3, " \t"), (4, "a"), (5, "A"), (6, "a b c"), (7, "a b c d"), (8, "a b c d")],
        [(1, "a b c d e f g h " * 30_000), (2, "a b c d e f g h " * 30_000 + "z"), (3, "b c")],
        [(5, "same text here now"), (5, "same text here now"), (5, "other words are these"), (2, "Same TEXT here now")],
    ],
)
def test_odd_rows(spark, rows):
    check(spark, rows)


def test_keep_one(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(3, base), (2, base + " end"), (9, "alone"), (None, base), (None, None)]
    df = clashing(spark.createDataFrame(rows, TEXTS))
    kept = keep_one(spark, df, 5, 80, 100)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 9, None, None])


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (50, 52), (52, 51)]
    found = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 50: 50, 51: 50, 52: 50}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_plans_stay_small(spark, monkeypatch):
    """The driver plans one group-and-join step at a time, over one table read twice."""
    plans, kept = [], components_module.stored

    def counted(session, frame, name):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        plans.append((plan.count("Join "), plan.count("Relation ")))
        return kept(session, frame, name)

    monkeypatch.setattr(components_module, "stored", counted)
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8)], "a long, b long")
    assert {tuple(r) for r in components(spark, edges).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
    assert max(joins for joins, _ in plans) == 1
    assert max(reads for _, reads in plans) == 2


def test_several_texts_under_one_id(spark):
    g = random.Random(17)
    bases = [" ".join(f"w{g.randrange(4000)}" for _ in range(60)) for _ in range(8)]
    texts = [t for k, b in enumerate(bases) for t in variants(k, b, 9, 2)]
    g.shuffle(texts)
    check(spark, [(i % 12, t) for i, t in enumerate(texts)])


def test_keep_one_leaves_clean_text_under_a_repeated_id(spark):
    copied, clean = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, copied), (5, copied + " more"), (5, clean), (6, None), (7, clean + " more")]
    found = keep_one(spark, spark.createDataFrame(rows, TEXTS), 5, 80, 100)
    assert Counter(map(tuple, found.collect())) == Counter([rows[0], rows[2], rows[3]])
