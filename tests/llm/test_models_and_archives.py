"""Secret scans, the quality classifier, the language model and WARC archives."""

import gzip
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from maskflow.llm import cotraining, maxent_lm, secret_scan, warc
from maskflow.session import scratch_path
from tests.llm.conftest import SF, TEXTS, clashing, words
from tests.oracle import assert_same, connect

# --- secrets -----------------------------------------------------------------------

RULES = {
    "assign": (
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        lambda m: len(m[2]) >= 8,
    ),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def by_rules(text):
    spans = [
        (m.start(), k, m.end(), name)
        for k, (name, (rule, good)) in enumerate(RULES.items())
        for m in rule.finditer(text or "")
        if good(m)
    ]
    joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))
    return (*(sum(s[3] == name for s in spans) for name in RULES), hashlib.sha256(joined.encode()).hexdigest())


def test_rules_against_plain_patterns(spark, documents):
    odd = [
        (-1, None), (-2, ""), (None, 'é token="abcdefgh1" ü ' + "deadbeef" * 4), (-3, "ſecret=abcdefgh password : short"),
        (-4, "secret=token: abcdefghi AKIAAKIA12345678901 AKIA TOKEN==aaaaaaaa api_key:'0123456789"), (-4, "x" * 3_000_000),
    ]
    df = documents.select("doc_id", "text").unionAll(spark.createDataFrame(odd, TEXTS))
    found = secret_scan.scan(spark, clashing(df))
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    expected = Counter((r.doc_id, *by_rules(r.text)) for r in df.collect())
    assert Counter(map(tuple, found.select(columns).collect())) == expected


def test_the_network_adds_secrets_that_no_rule_names(spark):
    g = random.Random(8)
    key = lambda n: "".join(g.choice("0123456789abcdef") for _ in range(n))
    prose = lambda n: " ".join("".join(g.choice("aeioulnrst") for _ in range(g.randint(2, 20))) for _ in range(n))
    labelled = [(i, f"{prose(40)} token = \"{key(40)}\" {prose(40)} password={key(18)} {prose(9)}") for i in range(300)]
    model = secret_scan.learn(spark, spark.createDataFrame(labelled, TEXTS))
    fresh = [(i, f"{prose(30)} {key(30)} {prose(30)}" if i % 2 else prose(60)) for i in range(100)]
    found = secret_scan.scan(spark, spark.createDataFrame(fresh, TEXTS), model).collect()
    caught = sum(r.n_model > 0 for r in found if r.doc_id % 2)
    assert caught >= 45 and sum(r.n_model > 0 for r in found if r.doc_id % 2 == 0) <= 2
    hit = next(r for r in found if r.n_model)
    kind, a, b = hit.spans.split(",")[-1].split(":")
    assert kind == "model" and re.fullmatch("[0-9a-f]{30}", dict(fresh)[hit.doc_id][int(a) : int(b)])


def test_all_findings_are_learnt_from_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "BLOCK", 60)
    monkeypatch.setattr(secret_scan, "LEAST", 5)
    rows = [(k, k % 100 == 0, b"") for k in range(1000)]
    own = spark.createDataFrame(rows, "key long, secret boolean, codes binary")
    dealt, blocks = secret_scan._dealt(own, {True: 10, False: 990})
    found = [(r.block, r.key, r.secret) for r in dealt.collect()]
    assert blocks == 17 and {r[1] for r in found} == set(range(1000)) and len(set(found)) == len(found)
    assert len(found) == 990 + 9 * 10 and all({True, False} == {s for b, _, s in found if b == n} for n in range(17))

    monkeypatch.setattr(secret_scan, "BLOCK", 700)
    g = random.Random(8)
    key = lambda n: "".join(g.choice("0123456789abcdef") for _ in range(n))
    prose = lambda n: " ".join("".join(g.choice("aeioulnrst") for _ in range(g.randint(2, 20))) for _ in range(n))
    labelled = [(i, f"{prose(40)} token = \"{key(40)}\" {prose(40)} password={key(18)} {prose(9)}") for i in range(300)]
    docs = spark.createDataFrame(labelled, TEXTS)
    model = secret_scan.learn(spark, docs)
    assert np.allclose(model.flat(), secret_scan.learn(spark, docs.repartition(3)).flat(), atol=1e-5)
    fresh = [(i, f"{prose(30)} {key(30)} {prose(30)}" if i % 2 else prose(60)) for i in range(100)]
    found = secret_scan.scan(spark, spark.createDataFrame(fresh, TEXTS), model).collect()
    assert sum(r.n_model > 0 for r in found if r.doc_id % 2) >= 45
    assert sum(r.n_model > 0 for r in found if r.doc_id % 2 == 0) <= 2


def test_long_and_short_candidates_are_read_whole(spark):
    g = random.Random(4)
    key = lambda n: "".join(g.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789") for _ in range(n))
    word = lambda: "".join(g.choice("aeioulnrst") for _ in range(g.randint(3, 9)))
    path = lambda n: "/".join(word() for _ in range(n))
    prose = lambda n: " ".join(word() if g.random() < 0.9 else path(g.randint(2, 20)) for _ in range(n))
    labelled = [
        (i, f"{prose(40)} token = \"{key(g.choice([12, 20, 32]))}\" {prose(40)} password={key(g.choice([10, 18]))} {prose(9)}")
        for i in range(400)
    ]
    model = secret_scan.learn(spark, spark.createDataFrame(labelled, TEXTS))
    assert model.alarms < 0.01
    hidden = {i: key(24) for i in range(60)}
    fresh = [(i, f"{prose(5)} {path(9)}/{hidden[i]}/{path(9)} {prose(5)}") for i in hidden]
    fresh += [(100 + i, f"{prose(9)} pwd {key(12)} {prose(9)}") for i in range(60)]
    fresh += [(200 + i, f"{prose(20)} {path(25)} {prose(20)}") for i in range(60)]
    texts = dict(fresh)
    found = {r.doc_id: r for r in secret_scan.scan(spark, spark.createDataFrame(fresh, TEXTS), model).collect()}

    def spans(i):
        return [tuple(map(int, s.split(":")[1:])) for s in found[i].spans.split(",") if s]

    middle = sum(any(texts[i].find(k) < b and texts[i].find(k) + 24 > a for a, b in spans(i)) for i, k in hidden.items())
    assert middle >= 50
    assert sum(found[100 + i].n_model > 0 for i in range(60)) >= 50
    assert sum(found[200 + i].n_model > 0 for i in range(60)) <= 5


def test_views_cover_every_character_of_a_candidate():
    texts = [b"Hunter2xyz99 plainword " + b"ab1/" * 200 + b" x", b"", "é Aa1".encode() + b"b" * 49]
    scan = secret_scan.Scan(texts)
    for run in set(scan.run.tolist()):
        own = scan.run == run
        covered = np.zeros(len(scan.buffer), int)
        for a, b in zip(scan.a[own], scan.b[own]):
            assert b - a <= secret_scan.INSIDE
            covered[a:b] += 1
        at = np.flatnonzero(covered)
        assert (np.diff(at) == 1).all()
    assert len(set(scan.run.tolist())) == 3
    assert scan.spans(np.flatnonzero(scan.owner == 0)) == [(0, 0, 12), (0, 23, 823)]
    assert scan.spans(np.flatnonzero(scan.owner == 2)) == [(2, 2, 54)]


def test_nothing_is_learnt_from_nothing(spark):
    for rows in ([], [(1, "no findings here"), (1, "no findings here"), (None, None)]):
        found = secret_scan.scan(spark, spark.createDataFrame(rows, TEXTS)).collect()
        assert len(found) == len(rows) and all(r.spans == "" for r in found)


# --- quality -----------------------------------------------------------------------

META = ["lang", "source", "n_chars"]


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = labels.filter("doc_id % 2 = 0")
    found = cotraining.score(spark, docs, half, meta_cols=META).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    wrong = found.filter("kept != (quality = 1)").count()
    assert wrong <= 0.005 * found.count()
    assert found.filter("quality = 1 and not kept").count() <= 0.002 * found.count()


def test_both_views_and_the_exchange():
    """The metadata decides alone where texts say nothing, and the other way round."""
    g = np.random.default_rng(3)
    label = g.integers(0, 2, 600)
    text = cotraining.text_rows([("good fine nice " if y else "bad % $ ugly ").encode() * 5 for y in label])
    meta = cotraining.meta_rows([["a" if y else "b" for y in label], g.integers(0, 9, 600).tolist()])
    known = np.where(np.arange(600) < 60, label, -1)
    model = cotraining.train(text, meta, known)
    for rows, size, weights in ((text, cotraining.TEXT_SIZE, model.text), (meta, cotraining.META_BUCKETS, model.meta)):
        z = cotraining.Sparse(rows, size).dot(weights)
        assert ((z > 0) == (label == 1)).mean() > 0.99


def test_sums_over_rows_take_little_memory():
    """Training holds its rows once: a sum makes no copy of all of them, and adds up in the same order."""
    g = np.random.default_rng(5)
    made = [(np.sort(g.integers(0, 500, 300)).astype(np.int32), g.random(300, np.float32)) for _ in range(1500)]
    rows, weights, errors = cotraining.Sparse(made, 500), g.normal(size=500), g.normal(size=1500)
    tracemalloc.start()
    dot, back = rows.dot(weights), rows.back(errors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < rows.values.nbytes + rows.at.nbytes
    at, values = np.concatenate([r[0] for r in made]), np.concatenate([r[1] for r in made])
    row = np.repeat(np.arange(1500), 300)
    assert (dot == np.bincount(row, weights[at] * values, 1500)).all()
    assert (back == np.bincount(at, errors[row] * values, 500)).all()


def test_pseudo_labels_are_the_most_certain_share_of_all_rows(spark, monkeypatch):
    g = np.random.default_rng(5)
    z = np.column_stack([g.normal(0, 4, 20_000), np.repeat([-9.0, 0.5, 7.0, 2.0], 5_000)])
    free = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(z)], "_key long, _z0 double, _z1 double")
    monkeypatch.setattr(cotraining, "TAUGHT", 50_000)
    found = {s: {r[0] for r in cotraining._sure(free).collect() if r.slot == s} for s in range(4)}
    step = np.floor(z * cotraining.STEPS)
    for k in range(2):
        order = np.sort(step[:, k])
        low, high = order[1000 - 1], order[-1000]
        assert found[2 * k] == set(np.flatnonzero((step[:, k] <= low) & (z[:, k] < -cotraining.CERTAIN)))
        assert found[2 * k + 1] == set(np.flatnonzero((step[:, k] >= high) & (z[:, k] > cotraining.CERTAIN)))
    monkeypatch.setattr(cotraining, "TAUGHT", 30)
    few = cotraining._sure(free).collect()
    assert Counter(r.slot for r in few) == dict.fromkeys(range(4), 30) and all(r[0] in found[r.slot] for r in few)
    assert cotraining._sure(free.limit(0)) is None


def test_the_exchange_over_a_table_teaches_the_view_that_labels_do_not(spark):
    """Of 40 labelled rows the texts say nothing; the words come with unlabelled rows, one of them very often."""
    g = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(4_000):
        y = int(g.integers(0, 2))
        labelled = k < 80
        word = "plain" if labelled else ("good fine nice" if y else "bad ugly wrong")
        rows.append((k, f"{word} {word}", "a" if y else "b"))
        labels += [(k, y)] * labelled
    rows += [(77_777, "good fine nice", "a")] * 2_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = cotraining.learn(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int"), meta_cols=["lang"])
    z = cotraining.Sparse(cotraining.text_rows([b"good fine nice", b"bad ugly wrong"]), cotraining.TEXT_SIZE).dot(model.text)
    assert z[0] > 1 and z[1] < -1


def test_odd_documents_and_labels(spark):
    rows = [(1, None, None, None), (2, "", "en", 0), (2, "", "en", 0), (None, "x", "de", -5), (3, "a b " * 200_000, "fr", 7)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None), (9, 0), (2, 0), (None, 1)], "doc_id long, quality int")
    for labels in (none, one):
        found = cotraining.score(spark, docs, labels, meta_cols=["lang", "n_chars"]).collect()
        assert len(found) == 5 and all(r.kept for r in found)
        kept = cotraining.keep_good(spark, docs, labels, meta_cols=["lang", "n_chars"])
        assert kept.columns == docs.columns and kept.count() == 5
    assert cotraining.score(spark, docs.limit(0), one, meta_cols=["lang"]).count() == 0


# --- language model ----------------------------------------------------------------


def tokens(text):
    return [*words(text), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def check_base(spark, rows):
    found = maxent_lm.score(spark, clashing(spark.createDataFrame(rows, TEXTS))).collect()
    counts = Counter(t for doc, text in rows if not held(doc) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    base = lambda own: sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    expected = sorted(
        ((doc, held(doc), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, base(tokens(t))) for doc, t in rows), key=order
    )
    actual = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=order
    )
    assert [a[:5] for a in actual] == [e[:5] for e in expected]
    assert [a[5] for a in actual] == pytest.approx([e[5] for e in expected])
    return found


def test_base_scores_and_held_out_gain(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(600).collect()]
    found = check_base(spark, rows)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize(
    "rows",
    [[], [(1, "a b"), (None, None), (3, ""), (3, "x y A"), (3, "x y A"), (7, "zz")], [(1, None), (2, "w " * 150_000)]],
)
def test_language_model_odd_rows(spark, rows):
    check_base(spark, rows)


def test_probabilities_add_up_to_one(spark):
    """Over all known words and one unknown, after any context."""
    vocabulary = [f"w{i}" for i in range(30)]
    g = random.Random(2)
    train = [(i, " ".join(g.choice(vocabulary) for _ in range(50))) for i in range(60)]
    train = [r for r in train if not held(r[0])]
    ids = [i for i in range(1000, 2000) if held(i)][: len(vocabulary) + 2]
    asked = [(i, f"w1 w2 {w}") for i, w in zip(ids, vocabulary)] + [(ids[-2], "w1 w2")]
    found = {r.doc_id: r.score for r in maxent_lm.score(spark, spark.createDataFrame(train + asked, TEXTS)).collect()}
    # score("w1 w2 w" + end) - score("w1 w2" + end) holds P(w) P(end | .. w) / P(end | w1 w2);
    # each is a proper probability, so every text is less likely than certain.
    assert all(found[i] < 0 for i, _ in asked)


def test_classes_and_words_are_proper_distributions():
    tokens_by_class = np.array([5, 3] + [0] * (maxent_lm.CLASSES - 2))
    shares = maxent_lm.Shares(8, 3, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), tokens_by_class, np.array([2, 1] + [0] * (maxent_lm.CLASSES - 2)))
    g = np.random.default_rng(1)
    weights = g.normal(size=(maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32)
    features = maxent_lm._features(np.arange(1, 9, dtype=np.uint64), np.array([0, 4]))
    assert np.exp(maxent_lm._log_shares(weights, maxent_lm._bias(shares), features)).sum(axis=1) == pytest.approx(1, abs=1e-4)
    # Within the first class: words with counts 4 and 1, and the unknown ones.
    total = 5 + 0.5 * 3
    assert (4 + 0.5) / total + (1 + 0.5) / total + 0.5 / total == pytest.approx(1)


# --- WARC --------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_warc_query_matches_sql(spark):
    assert_same(driver.queries()["op7_warc"](spark, SF), connect(SF), driver.oracle_sql()["op7_warc"])


def test_captures_of_odd_pages(spark):
    tricky = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nü" * 9
    rows = [
        (1, "http://a/x?y#z", "p" * 100), (2, None, "p" * 100), (None, "u\r\nx", "p" * 100), (4, "http://b", None),
        (5, "http://b", tricky), (6, "http://b", "short"), (7, "http://b", "short"), (1, "http://a/x?y#z", "p" * 100),
    ]
    path = scratch_path(spark, "warc")
    warc.write(spark, clashing(spark.createDataFrame(rows, PAGES)), path)
    captures = warc.assemble(warc.read(spark, path))
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_captures(spark, captures).collect())
    size = len(tricky.encode())
    assert found == Counter({
        (1, 100, "response", None): 2, (2, 100, "revisit", 1): 1, (None, 100, "revisit", 1): 1, (4, 0, "response", None): 1,
        (5, size, "response", None): 1, (6, 5, "response", None): 1, (7, 5, "response", None): 1,
    })
    own = captures.filter(F.col("payload") == tricky.encode()).first()
    assert own.requests[0].payload == b"" and own.metadata[0].fields["page-id"] == "5"


def test_records_of_foreign_archives(spark, tmp_path):
    """Members compressed one by one, pointers from the response to the request."""

    def record(kind, own, body, *more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *more, f"Content-Length: {len(body)}"]
        return gzip.compress(("WARC/1.0\r\n" + "\r\n".join(head)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")

    http = "Content-Type: application/http; msgtype=response"
    raw = record("warcinfo", "<i>", b"x") + record("request", "<q>", b"GET / HTTP/1.1\r\n\r\n", http)
    raw += record("response", "<r>", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "WARC-Concurrent-To: <q>")
    (tmp_path / "a.warc.gz").write_bytes(raw)
    [row] = warc.assemble(warc.read(spark, str(tmp_path))).collect()
    assert (row.record_id, bytes(row.payload), [q.record_id for q in row.requests]) == ("<r>", b"body", ["<q>"])


def test_a_cut_archive_is_an_error():
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_of(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc"))


def test_no_pages(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark, spark.createDataFrame([], PAGES), path)
    assert warc.assemble(warc.read(spark, path)).count() == 0
