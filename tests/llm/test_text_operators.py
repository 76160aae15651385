"""HTML extraction, pieces, decontamination and words."""

import html
import random
import re
from collections import Counter

import numpy as np
import pytest

from maskflow.llm import words as word_tools
from maskflow.llm.decontaminate import contaminated, remove_contaminated
from maskflow.llm.html_text import extract, main_text
from maskflow.llm.pieces import Encoder, Vocabulary, decode, decode_ids, encode
from maskflow.llm.queries import PIECE_MODEL
from tests.llm.conftest import SF, TEXTS, clashing, words

# --- words -------------------------------------------------------------------------


def test_words_and_hashes(monkeypatch):
    texts = ["A b\x0bc", "", "a  B", " \t", "é É x1 X1", "a b c d " * 50]
    by_hash = {}
    monkeypatch.setattr(word_tools, "PIECE", 64)
    found = [h for group in word_tools.word_hashes([t.encode() for t in texts]) for h in group]
    for text, own in zip(texts, found):
        assert len(own) == len(words(text))
        for word, value in zip(words(text), own.tolist()):
            assert by_hash.setdefault(word, value) == value
    assert len(set(by_hash.values())) == len(by_hash)


def test_shingles_of_short_texts():
    w = np.arange(1, 4, dtype=np.uint64)
    assert len(word_tools.shingles(w, 5)) == 1 and len(word_tools.shingles(w, 2)) == 2
    assert len(word_tools.shingles(w[:0], 5)) == 0


# --- HTML --------------------------------------------------------------------------


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in extract(spark, pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = re.sub(r"</?b>", "", inner)
        assert found[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", plain)).split())


LONG = "A long story about things that happened one day. " * 6


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>a<p>b<br>c<i>d</i>e", "a b cde"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside><p>y</article><footer>f</footer>", "T x y"),
        ("<header>H</header><main><div class='cookieNotice'>We use</div><p>x &lt; y</p><form>f</form></main>", "x < y"),
        (f"<ul class=menu><li><a>Home</a></ul><div>{LONG}</div><div id=comments><p>{LONG}</div>", LONG.strip()),
        (f"<div><a>Home</a> <a>News page</a></div><p>{LONG}</p><p>Short.</p><p>© 2024</p>", LONG.strip() + " Short."),
        ("<article>a<script>if (a</b>) '</article>'</script><style>p{}</style><!-- c -->b</article>", "ab"),
        ("<article>x  y\n z<p>open", "x y z open"),
        ("<article><div hidden>h</div><div style='display: none'>n</div><p title='a > b'>t</p></article>", "t"),
        ("<article>cut <b", "cut"),
        ("<div class='layout with-sidebar'><article>x</article><article class='comment'>c</article></div>", "x"),
        (f"<div class=header>Site name</div><div class='page has-nav'><p>{LONG}</p></div>", LONG.strip()),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


TEASER = "<article class=card><h2>Next week</h2><p>Ten things to read.</p></article>"


@pytest.mark.parametrize("around", ["{} " + TEASER, TEASER + " {}", TEASER * 4 + "{}" + TEASER * 4])
def test_story_beside_a_teaser(around):
    story = f"<h1>The title</h1><p>Opening.</p><p>{LONG}</p><p>{LONG}</p><p>The end.</p>"
    page = f"<nav>Home</nav><div class=story>{around.format(story)}</div>"
    assert main_text(page) == " ".join(["The title Opening.", LONG.strip(), LONG.strip(), "The end."])


def test_story_goes_on_behind_a_teaser():
    page = f"<div><p>{LONG}</p><p>{LONG}</p>{TEASER}<p>The end.</p></div>"
    assert main_text(page) == " ".join([LONG.strip(), LONG.strip(), "The end."])


def test_article_beside_lesser_text():
    page = f"<div>Buy now, offers of the week</div><article><h1>T</h1><p>{LONG}</p><p>x</p></article><div><p>{LONG}</p></div>"
    assert main_text(page) == f"T {LONG.strip()} x"


def test_one_long_block_lifts_no_threshold():
    short = [f"Paragraph {i}: " + "something happened here. " * 12 for i in range(4)]
    long = "A very long report of a meeting. " * 600
    law = "Copyright law in the region was changed after the third session of the court."
    parts = [*short, law, long, *short, "Copyright law stays."]
    page = "<div><h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in parts) + "<p>(c) 2024 Example</p></div>"
    assert main_text(page) == " ".join(["A title", *(p.strip() for p in parts)])


def test_titles_lead_to_the_surge_and_menus_do_not():
    page = f"<div><a>Home</a> <a>News page</a></div><div>Site name</div><h1>T</h1><div>By A. B.</div><p>{LONG}</p><div>(c) 2024 E</div>"
    assert main_text(page) == f"T By A. B. {LONG.strip()}"


def test_extract_keeps_columns_and_repeated_rows(spark):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, None)]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = extract(spark, df)
    assert found.columns == [c for c in df.columns if c != "html"] + ["text"]
    assert Counter((r.page_id, r.text) for r in found.collect()) == Counter({(1, "x"): 2, (None, ""): 1})
    assert extract(spark, df.limit(0)).count() == 0


# --- pieces ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(PIECE_MODEL)


def test_ids_are_those_of_the_library(vocabulary, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    g = random.Random(1)
    texts = ["", " ", "  a  b\n\tc é 🦙 x", "▁▁x", "a" * 300, " " * 37, "<s>", "日本語のテキスト", "ab" * 90, "x▁y"]
    texts += ["".join(g.choice("abcdethinos  ▁éß\n.,0") for _ in range(g.randint(1, 60))) for _ in range(400)]
    texts += ["".join(g.choice(vocabulary.texts) for _ in range(g.randint(1, 12))) for _ in range(400)]
    texts += [r.text for r in documents.limit(100).collect()]
    found = [np.frombuffer(b, np.int32).tolist() for b in Encoder(vocabulary).encode(texts)]
    assert found == library.encode(texts)
    assert [decode_ids(vocabulary, x) for x in found] == library.decode(found)


def test_known_words_are_let_go(vocabulary, monkeypatch):
    from maskflow.llm import pieces

    monkeypatch.setattr(pieces, "KEPT_WORDS", 5)
    monkeypatch.setattr(pieces, "SLICE", 20)
    texts = [f"word{i} and the word{i + 1} again" for i in range(40)]
    few, all_known = Encoder(vocabulary), Encoder(vocabulary)
    first = few.encode(texts)
    monkeypatch.undo()
    assert first == all_known.encode(texts)


def test_encode_and_decode_tables(spark):
    rows = [(1, "a b\nc"), (2, None), (3, ""), (3, ""), (4, "long " * 40_000)]
    df = clashing(spark.createDataFrame(rows, TEXTS))
    ids = encode(spark, df, PIECE_MODEL)
    assert ids.columns == [c for c in df.columns if c != "text"] + ["ids"]
    found = Counter((r.doc_id, r.text) for r in decode(spark, ids, PIECE_MODEL).select("doc_id", "text").collect())
    assert found == Counter(rows)
    assert encode(spark, df.limit(0), PIECE_MODEL).count() == 0


# --- decontamination ---------------------------------------------------------------


def brute_containment(docs, items, width=5):
    def sets(text, w):
        own = words(text)
        return {tuple(own[i : i + w]) for i in range(len(own) - w + 1)}

    out = Counter()
    for doc, text in docs:
        for item, query in items:
            w = min(width, len(words(query)))
            if not w:
                continue
            q = sets(query, w)
            both = len(q & sets(text, w))
            if 10 * both >= 8 * len(q):
                out[doc, item, len(q), both] += 1
    return out


def pairs(df):
    return Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in df.collect())


def test_contamination_against_all_pairs(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = pairs(contaminated(spark, documents, items))
    docs, queries = ([tuple(r)[:2] for r in df.select(c, "text").collect()] for df, c in ((documents, "doc_id"), (items, "item_id")))
    assert found == brute_containment(docs, queries) and found


def test_contamination_of_changed_passages_and_odd_rows(spark):
    g = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    queries = [(i, " ".join(g.choice(vocabulary) for _ in range(g.choice([3, 14, 40, 130])))) for i in range(30)]
    docs = []
    for i, (_, text) in enumerate(queries):
        w = text.split()
        for _ in range(g.randint(0, 2)):
            w[g.randrange(len(w))] = "changed"
        around = [g.choice(vocabulary) for _ in range(4000)]
        docs.append((i, " ".join(around[: 40 * i] + w + around[40 * i :])))
    docs += [(100, None), (101, ""), (100, queries[1][1]), (100, queries[1][1])]
    queries += [(50, None), (51, ""), (52, queries[0][1]), (0, queries[0][1])]
    found = contaminated(
        spark, clashing(spark.createDataFrame(docs, TEXTS)), clashing(spark.createDataFrame(queries, "item_id long, text string"))
    )
    assert pairs(found) == brute_containment(docs, queries)


def test_contamination_by_short_items(spark):
    g = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    queries = [(i, " ".join(g.choice(vocabulary) for _ in range(1 + i % 11))) for i in range(440)]
    queries += [(None, "no id here"), (None, queries[5][1])]
    docs = []
    for i in range(25):
        parts = [q for _, q in g.sample(queries, 30)]
        docs.append((i, " ".join(p + " " + " ".join(g.choice(vocabulary) for _ in range(g.choice([0, 3, 60]))) for p in parts)))
    docs += [(30, queries[4][1]), (31, queries[0][1]), (32, "")]
    found = contaminated(spark, spark.createDataFrame(docs, TEXTS), spark.createDataFrame(queries, "item_id long, text string"))
    assert pairs(found) == brute_containment(docs, queries)


def test_item_without_id_is_removed_too(spark):
    docs = spark.createDataFrame([(1, "x one two three four five six"), (2, "clean")], TEXTS)
    items = spark.createDataFrame([(None, "one two three four five six")], "item_id long, text string")
    assert [r.doc_id for r in remove_contaminated(spark, docs, items).collect()] == [2]


def test_remove_contaminated(spark):
    df = spark.createDataFrame([(1, "one two three four five six"), (2, "clean"), (None, "one two three four five six")], TEXTS)
    items = spark.createDataFrame([(1, "One two three four five SIX")], "item_id long, text string")
    assert Counter(r.doc_id for r in remove_contaminated(spark, df, items).collect()) == Counter([2, None])
    assert remove_contaminated(spark, df, items.limit(0)).count() == 3


def test_clean_text_under_the_id_of_a_contaminated_one_stays(spark):
    rows = [(1, "one two three four five six"), (1, "clean"), (1, None)]
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert Counter(r.text for r in remove_contaminated(spark, spark.createDataFrame(rows, TEXTS), items).collect()) == Counter(["clean", None])


_STORY = "".join(f"<p>Paragraph {k} of a story that goes on for a while, with words enough to count.</p>" for k in range(6))
_PLAIN = " ".join(f"Paragraph {k} of a story that goes on for a while, with words enough to count." for k in range(6))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='layout-sidebar-right'>{_STORY}</div></body>",
        f"<body><div class='navy'>{_STORY}</div></body>",
        f"<article><div class='cookie-recipe'>{_STORY}</div></article>",
        f"<article><section class='discussion'>{_STORY}</section></article>",
        f"<body class='x'><div class='widget'><div class='sidebar'><ul><li>One</li></ul></div>{_STORY}</div></body>",
        f"<article>{_STORY}</article><div class='comments'><p>{'I do not agree with this at all. ' * 40}</p></div>",
        f"<div>{_STORY}</div><div><p>Posted in Sport</p><p>Weather 12 C</p><p>Sign in</p><p>Terms of use</p><p>Contact us</p></div>",
        f"<div><p>Sign in</p><p>Weather 12 C</p><p>Contact us</p></div><p>Some links</p><div class=nav>Home</div><div>{_STORY}</div>",
    ],
)
def test_no_story_is_lost_by_the_names_around_it(page):
    text = main_text(page)
    assert _PLAIN in text
    for other in ("agree", "One", "Weather", "Terms of use", "Posted", "Sign in"):
        assert other not in text


def test_quotes_in_tags():
    assert main_text("<p class=it's>Hello there</p><p>I don't go</p><p>Last</p>") == "Hello there I don't go Last"
    assert main_text('<p title="5" tall">Hello there, all of you.</p>') == "Hello there, all of you."
    assert main_text('<p title="a > b">Hello</p><p data-x=\'>\'>there</p>') == "Hello there"


def test_time_grows_with_the_page():
    import time

    for page in ("<div>word " * 20_000, "<b>word " * 20_000 + "</i>" * 20_000, "<li>word <div>" * 10_000, "<p a=" * 20_000):
        begun = time.monotonic()
        main_text(page)
        assert time.monotonic() - begun < 5
