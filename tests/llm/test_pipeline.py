"""The corpus pipeline, stage by stage, and the registration of the queries."""

import re

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from maskflow.llm import cotraining
from maskflow.llm.pieces import Vocabulary, decode_ids
from maskflow.llm.queries import PIECE_MODEL
from tests.llm.conftest import SF
from tests.llm.test_jaccard_join import brute
from tests.llm.test_text_operators import brute_containment
from tests.oracle import assert_same, connect


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in driver.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in driver.queries()
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", ["op5_benchmark_decontamination", "op10_ngram_jaccard_join"])
def test_sql_says_the_same(spark, name):
    assert_same(driver.queries()[name](spark, SF), connect(SF), driver.oracle_sql()[name])


def test_stages_decide_as_brute_force_does(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"
    ]
    rows = {}
    for name, stage in list(stages.items())[:4]:
        before = rows or {r.doc_id: r.text for r in docs.collect()}
        # Written and read again between stages, as the driver does.
        from maskflow.llm.tables import stored

        after = stored(spark, stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        docs, rows = after, {r.doc_id: r.text for r in after.collect()}
        gone = before.keys() - rows.keys()
        if name == "quality_classifier":
            scored = cotraining.score(
                spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"),
                meta_cols=["lang", "source", "n_chars"],
            )
            assert gone == {r.doc_id for r in scored.filter("not kept").collect()} and gone
        if name == "exact_dedup":
            plain = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
            first = {}
            for d in sorted(before):
                first.setdefault(plain(before[d]), d)
            assert rows.keys() == set(first.values())
        if name == "ngram_jaccard_join":
            assert rows.keys() == {c for _, _, c in brute(sorted(before.items()), 5, 80, 100)}
        if name == "benchmark_decontamination":
            assert gone == {d for d, *_ in brute_containment(before.items(), items)}
    ids = stages["sentencepiece"](spark, docs, SF)
    vocabulary = Vocabulary.load(PIECE_MODEL)
    assert {r.doc_id: decode_ids(vocabulary, np.array(r.ids)) for r in ids.collect()} == rows


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns[-1] == "ids" and 0 < found.count() < 200
