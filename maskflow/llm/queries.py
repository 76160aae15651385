"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm import collocations, cotraining, decontaminate, exact_dedup, html_text, jaccard_join, maxent_lm, periodic_runs, pieces, private_data, secret_scan, suffix_dedup, warc
from maskflow.session import scratch_path

#: The vocabulary file of the piece encoder: a file that the driver can read.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
    WITH normal AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain
      FROM documents
    ), held AS (
      SELECT doc_id, sha256(plain) AS text_sha256,
             min(doc_id) OVER (PARTITION BY plain) AS keep_id,
             count(*) OVER (PARTITION BY plain) AS group_size
      FROM normal
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM held
    """
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"digest_index_{uuid.uuid4().hex}"
    return exact_dedup.dedup_batch(
        spark, table(spark, sf_dir, "documents"), name, scratch_path(spark, "digest-index")
    )


@query(
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
      FROM documents
    ), sets AS MATERIALIZED (
      SELECT doc_id, CASE WHEN len(ws) < 4 THEN (CASE WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) ELSE
               list_sort(list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))) END AS shingles
      FROM words
    ), texts AS MATERIALIZED (
      SELECT min(doc_id) AS first_id, shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles
    ), tokens AS MATERIALIZED (
      SELECT first_id, n, unnest(shingles) AS shingle FROM texts
    ), links AS MATERIALIZED (
      SELECT a.first_id AS x, b.first_id AS y
      FROM tokens a JOIN tokens b ON a.shingle = b.shingle AND a.first_id < b.first_id
       AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.first_id, b.first_id, a.n, b.n
      HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), edges AS MATERIALIZED (
      SELECT x, y FROM links UNION ALL SELECT y, x FROM links
    ), reach(root, node) AS (
      SELECT first_id, first_id FROM texts
      UNION
      SELECT root, y FROM reach JOIN edges ON x = node AND y > root
    ), least_of AS (
      SELECT node, min(root) AS root FROM reach GROUP BY node
    )
    SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(l.root, s.doc_id) AS component_id
    FROM sets s LEFT JOIN texts t ON t.shingles = s.shingles LEFT JOIN least_of l ON l.node = t.first_id
    """
)
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.near_classes(spark, docs, width=4, num=85, den=100)


@query(
    r"""
    WITH words AS (
      SELECT row_number() OVER () AS row, kind, id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
      FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark)
    ), widths AS (
      SELECT DISTINCT least(5, len(ws)) AS width FROM words WHERE kind = 'i' AND len(ws) > 0
    ), shingles AS (
      SELECT DISTINCT row, kind, id, width,
             unnest(list_transform(range(1, len(ws) - width + 2), lambda i: array_to_string(ws[i:i + width - 1], ' '))) AS shingle
      FROM words, widths WHERE kind = 'd' OR width = least(5, len(ws))
    ), items AS (
      SELECT *, count(*) OVER (PARTITION BY row) AS n_item FROM shingles WHERE kind = 'i'
    )
    SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n_item)::INTEGER AS n_item, count(*)::INTEGER AS n_shared,
           count(*) / any_value(i.n_item) AS containment
    FROM shingles d JOIN items i USING (width, shingle)
    WHERE d.kind = 'd'
    GROUP BY d.row, d.id, i.row, i.id
    HAVING 10 * count(*) >= 8 * any_value(i.n_item)
    """
)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(spark, docs, items)


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("whole"))
    rows = pieces.decode(spark, pieces.encode(spark, docs, PIECE_MODEL), PIECE_MODEL)
    return rows.select(
        "doc_id",
        F.size("ids").alias("n_ids"),
        "ids",
        F.col("text").eqNullSafe(F.replace("whole", F.lit(pieces.META), F.lit(" "))).alias("round_trip"),
    )


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return cotraining.score(spark, docs, labels, meta_cols=["lang", "source", "n_chars"])


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.remove_repeats(spark, docs).drop("text", "spans")


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(spark, pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query(
    """
    WITH payloads AS (
      SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
    ), held AS (
      SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
             CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first_id
      FROM payloads
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM held
    """
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(spark, table(spark, sf_dir, "pages"), path)
    return warc.page_captures(spark, warc.assemble(warc.read(spark, path)))


@query()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(spark, table(spark, sf_dir, "documents"))


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(spark, table(spark, sf_dir, "documents"))


@query()
def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.scan(spark, table(spark, sf_dir, "documents"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.detect(spark, docs, prepare=periodic_runs.looped)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256"]
    return found.select(*names, F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


@query(
    r"""
    WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
      FROM documents
    ), pieces AS (
      SELECT lang, unnest(regexp_split_to_array(low, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
    ), rows AS (
      SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
    ), grams AS (
      SELECT lang, 1 AS m, unnest(ws) AS phrase FROM rows
      UNION ALL
      SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))) FROM rows
      UNION ALL
      SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) FROM rows
    ), f AS (
      SELECT lang, m, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL
    ), total AS (
      SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
    ), cand AS (
      SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 10
    ), cuts AS (
      SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS p, array_to_string(ws[k + 1:], ' ') AS q
      FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
    ), scored AS (
      SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score
      FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q
    ), lowest AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), within AS (
      SELECT lang, part, max(a) AS most
      FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM cand WHERE m = 3)
      GROUP BY ALL
    ), kept AS (
      SELECT s.* FROM lowest s LEFT JOIN within w ON w.lang = s.lang AND w.part = s.phrase
      WHERE s.m = 3 OR w.most IS NULL OR 100 * w.most < 50 * s.a
    )
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank,
           k.phrase, k.a::BIGINT AS a, k.l::BIGINT AS l, k.r::BIGINT AS r, t.n, k.score::BIGINT AS score
    FROM kept k JOIN total t USING (lang)
    QUALIFY rank <= 2000
    """
)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark, table(spark, sf_dir, "documents"))
