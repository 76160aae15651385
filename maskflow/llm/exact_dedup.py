"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of new rows is reduced
to one row per digest, met with the index by a sort-merge anti join, and what is
new is appended. Built-in functions only.

Defined cases: a null text counts as empty, and all empty texts are equal. Rows
whose id is null are kept in the result; an id that is not null is preferred as the
row that stays. Repeated ids each give a row. Other columns of the input are
ignored, whatever their names. An empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import join_hot, small, stored

#: Runs of these are one space before texts are compared.
SPACES = r"[\x20\x09-\x0D]+"
BUCKETS = 64
INDEX_SCHEMA = "digest BINARY, keep_id BIGINT"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with runs of white space as one space, as 32 bytes."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``digest``; whole texts, no shuffle."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), digest_of(F.col(text_col)).alias("digest")
    )


def one_per_digest(rows: DataFrame) -> DataFrame:
    """The smallest id and the row count of each digest, combined before the shuffle."""
    return rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def open_index(
    spark: SparkSession, table: str, path: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The index as a table of the catalog; made empty when it does not exist.

    With ``path`` the files lie there and outlive the catalog: a later session that
    opens the same path finds what was stored.
    """
    if not spark.catalog.tableExists(table):
        at = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE {table} ({INDEX_SCHEMA}) USING parquet {at} "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )
    return spark.table(table)


def append_new(
    spark: SparkSession,
    table: str,
    groups: DataFrame,
    path: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add the digests of ``groups`` (one row each) that the index lacks; returns the index.

    The index side of the anti join is read by bucket, already hashed and sorted, so
    only the new rows move. Appending runs over the same buckets: one task writes
    one file per bucket. A repeated run adds nothing.
    """
    index = open_index(spark, table, path, buckets)
    new = groups.select("digest", "keep_id").join(
        index.select("digest").hint("merge"), "digest", "left_anti"
    )
    # Read and appended in one statement would be refused, so the new rows are cut first.
    fresh = stored(spark, new, "digest-new")
    (
        fresh.repartition(buckets, "digest")
        .write.bucketBy(buckets, "digest")
        .sortBy("digest")
        .format("parquet")
        .mode("append")
        .saveAsTable(table)
    )
    spark.catalog.refreshTable(table)
    return spark.table(table)


def dedup_batch(
    spark: SparkSession,
    docs: DataFrame,
    table: str,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Deduplicate a batch against the index, add it, and say for each row which row stays.

    ``doc_id, keep_id, group_size, kept, text_sha256``: ``keep_id`` comes from the
    index, so a text seen in an earlier batch keeps the id that it had then and the
    new rows are all dropped; ``group_size`` counts the rows of this batch. Within a
    batch the smallest id stays.
    """
    rows = stored(spark, digests(docs, id_col, text_col), "digests")
    groups = stored(spark, one_per_digest(rows), "digest-groups")
    total = rows.count()
    index = append_new(spark, table, groups, path, buckets)
    held = groups.select("digest", "group_size").join(index.hint("merge"), "digest")
    joined = join_hot(rows, held, "digest", "group_size", total)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(
    spark: SparkSession,
    docs: DataFrame,
    table: str,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text is new to the index, one per text, all columns kept.

    The rows to drop are the smaller side, so they are what the documents are met
    with. Rows that repeat both id and text are rare; they are only looked for when
    the counts say that there are some.
    """
    verdict = dedup_batch(spark, docs, table, path, id_col, text_col)
    verdict = stored(spark, verdict, "dedup-verdict")
    dropped, kept, texts = verdict.agg(
        F.count_if(~F.col("kept")), F.count_if("kept"), F.count_distinct(F.when(F.col("kept"), F.col("text_sha256")))
    ).first()
    gone = verdict.filter("not kept").select(
        F.col("doc_id").alias("_gone"), F.unhex("text_sha256").alias("_digest")
    ).distinct()
    marked = docs.withColumn("_own", digest_of(F.col(text_col)))
    rest = marked.join(
        small(gone, dropped, 48),
        F.col("_own").eqNullSafe(F.col("_digest"))
        & F.col(id_col).cast("bigint").eqNullSafe(F.col("_gone")),
        "left_anti",
    )
    if kept != texts:
        rest = rest.dropDuplicates(["_own"])
    return rest.drop("_own")
