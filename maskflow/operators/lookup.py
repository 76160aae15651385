"""Static lookup tables and the left join that reads from them.

A lookup is measured once, by distributed aggregates over its key and value
columns. The measurement decides what must not be guessed:

* whether it may be broadcast (its size is bounded by ``broadcast_limit``);
* whether a key occurs more than once, so that a match makes several rows;
* whether the table breaks a promise of unique keys.

Beyond the limit the join shuffles, and a key may be hot on either side.

Many records with one key: a sketch of the records' keys names those with more than
``HOT_SHARE`` of the rows, a thousand at most. Their lookup rows alone are broadcast; the
records that they serve, and those without a key, have nothing to meet in the shuffle
and are spread over all tasks. So no key is hot there, whatever the lookup's size, whether
or not adaptive execution runs and however the lookup is laid out. A streaming frame
cannot be sketched beforehand: pipelines join each micro-batch as a batch, and where a
lookup is joined to a stream directly it is copied under several salts.

Many lookup rows with one key: past ``GROUP_ROWS`` they are divided into chunks,
and a record is first told how many chunks its key has, then joined to each.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import named

BROADCAST_LIMIT_BYTES = 64 << 20
REPLICATION_BUDGET_BYTES = 16 << 30
MAX_SALTS = 16
GROUP_ROWS = 100_000
#: A key is hot with more than this share of the records; at most 1 / HOT_SHARE keys can be.
HOT_SHARE = 1 / 1000
#: Keys the sketch tracks. Its error is 3.5 / 16384 of the records, a fifth of HOT_SHARE.
SKETCH_KEYS = 10_000
#: A task's share of the lookup that may be built into a hash table; sorted beyond it.
HASH_BUILD_BYTES = 64 << 20

# Bytes a row costs in a broadcast hash table beyond its own text.
_ROW_OVERHEAD = 64
# Copies of one row are made in blocks, so that no array grows with the table.
_BLOCK = 4096

KEY = "__lookup_key"
VALUE = "__lookup_value"
FIRST = "__lookup_first"
_CHUNK = "__lookup_chunk"
_CHUNKS = "__lookup_chunks"
_SALT = "__salt"


@dataclass(frozen=True)
class Lookup:
    """A measured snapshot of a lookup table, ready to join.

    ``rows`` holds ``KEY`` and ``VALUE``, and ``FIRST`` when ``marked``: true on
    one row of every key. ``chunks`` has the number of chunks per key where
    keys have very many rows.
    """

    rows: DataFrame
    broadcast: bool
    marked: bool
    salts: int
    chunks: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)
    bytes: int = 0
    key_bytes: int = 0  # the most that the rows of one key take
    limit: int = BROADCAST_LIMIT_BYTES
    hot_share: float | None = HOT_SHARE

    def close(self) -> None:
        for table in self.cached:
            table.unpersist()


def prepare_lookup(
    table: DataFrame,
    key: str,
    value: str,
    on_duplicate_key: str = "fanout",
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salts: int | None = None,
    group_rows: int = GROUP_ROWS,
    cache: bool = False,
    mark_first: bool = True,
    hot_share: float | None = HOT_SHARE,
) -> Lookup:
    """Measure a lookup table and fix how it is joined.

    ``mark_first`` tells one copy of each record apart where a key has several
    rows; the audit trail needs that. ``cache`` pins the snapshot for plans
    that read it many times, such as a stream that joins it in every
    micro-batch; ``close()`` lets it go. ``hot_share`` None leaves the records'
    keys unread, and hot ones to adaptive execution or salts.
    """
    if on_duplicate_key not in ("fanout", "error"):
        raise ValueError(f"on_duplicate_key must be 'fanout' or 'error', not {on_duplicate_key!r}")
    for column in (key, value):
        if column not in table.columns:
            raise ValueError(f"lookup column {column!r} not found in {table.columns}")

    # A null key matches nothing, so it never has to travel.
    rows = table.where(named(key).isNotNull()).select(
        named(key).alias(KEY), named(value).alias(VALUE)
    )
    # Whether keys repeat matters for marks, for promises, and for hot keys in a
    # shuffle; a plain broadcast join need not count.
    counted = mark_first or on_duplicate_key == "error"
    n_bytes, copies, key_bytes = _measure(rows, counted)
    small = n_bytes <= broadcast_limit
    if not (small or counted):
        n_bytes, copies, key_bytes = _measure(rows, True)
    if copies > 1 and on_duplicate_key == "error":
        raise ValueError(f"lookup key {key!r} is not unique: one key occurs {copies} times")

    if salts is None:
        salts = 1 if small else _salts_for(rows.sparkSession, n_bytes, cache)
    chunked = not small and copies > group_rows
    marked = mark_first and copies > 1
    chunks = None
    if chunked:
        # From the plain rows: they need not be divided for their number.
        per_key = F.ceil(F.count("*") / group_rows).cast("int").alias(_CHUNKS)
        chunks = rows.groupBy(KEY).agg(per_key).where(F.col(_CHUNKS) > 1)
        rows = _divide(rows, salts, group_rows)
    elif marked:
        # Keys have few rows each, or the whole table is small: both measured.
        within_key = Window.partitionBy(KEY).orderBy(VALUE)
        rows = rows.withColumn(FIRST, F.row_number().over(within_key) == 1)
    lookup = Lookup(
        rows.select(KEY, VALUE, *[FIRST] * marked, *[_CHUNK] * chunked),
        small,
        marked,
        salts,
        chunks,
        bytes=n_bytes,
        key_bytes=key_bytes,
        limit=max(broadcast_limit, BROADCAST_LIMIT_BYTES),
        hot_share=hot_share,
    )
    return _pin(lookup) if cache else lookup


def join_lookup(df: DataFrame, source: str, destination: str, lookup: Lookup) -> DataFrame:
    """Left join: ``destination`` gets the value found for ``source``, or null.

    Column order is kept; an existing destination is replaced where it stands
    and a new one comes last. With a marked lookup a boolean column ``FIRST`` is
    true on one copy of each record and false on the others.
    """
    if lookup.broadcast:
        joined = df.join(F.broadcast(lookup.rows), named(source) == F.col(KEY), "left")
    elif lookup.chunks is None:
        joined = _shuffled_left_join(df, named(source), lookup)
    else:
        joined = _chunked_left_join(df, source, lookup)
    added = {destination: F.col(VALUE)}
    if lookup.marked:
        added[FIRST] = F.coalesce(F.col(FIRST), F.lit(True))
    return joined.withColumns(added).drop(KEY, VALUE, _CHUNK, _CHUNKS, "__row_chunk")


def heavy_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> list:
    """All keys with more than ``share`` of the rows, and perhaps some that have nearly so many.

    One pass that reads the key only, by a mergeable sketch of frequent items; its
    size does not depend on the table. Keys of a type that it does not take are counted.
    """
    keys = df.select(key.alias("k")).where(F.col("k").isNotNull())
    most = int(1 / share)
    if isinstance(keys.schema["k"].dataType, (T.BinaryType, T.ArrayType, T.StructType)):
        total = keys.count()
        return [r.k for r in keys.groupBy("k").count().where(F.col("count") > share * total).collect()]
    found = keys.agg(
        F.count("*").alias("n"), F.call_function("approx_top_k", "k", F.lit(most), F.lit(max(SKETCH_KEYS, most))).alias("top")
    ).first()
    # An estimate is never below the true count.
    return [item["item"] for item in found.top or [] if item["count"] > share * found.n]


def _shuffled_left_join(df: DataFrame, key: Column, lookup: Lookup) -> DataFrame:
    """Left join by shuffle, with hot keys met by a broadcast of their rows alone.

    One pass over the records: those that a hot key has served go on without a key.
    """
    rows, laid_out = lookup.rows, _SALT in lookup.rows.columns
    if df.isStreaming or lookup.hot_share is None:
        return _spread_left_join(df, key, rows, lookup.salts)
    salts = lookup.salts if laid_out else 1
    hash_build = lookup.bytes // _partitions(df.sparkSession) <= HASH_BUILD_BYTES
    hot = heavy_keys(df, key, lookup.hot_share)
    # A key with more rows than fit is left to the shuffle, where its rows are in one task.
    hot = hot[: lookup.limit // max(1, lookup.key_bytes)]
    if not hot:
        return _spread_left_join(df, key, rows, salts, hash_build=hash_build)
    kept = [c for c in rows.columns if c != _SALT]
    one = rows.where(F.col(_SALT) == 0) if laid_out else rows
    few = one.where(F.col(KEY).isin(hot)).select(*[F.col(c).alias(f"__hot{c}") for c in kept])
    met = df.join(F.broadcast(few), key == F.col(f"__hot{KEY}"), "left")
    served = F.col(f"__hot{KEY}").isNotNull()
    # A hot key that the lookup lacks matches nothing in the shuffle either.
    missed = key.isin(hot)
    rest = F.when(~served & ~missed, key)
    joined = _spread_left_join(met, rest, rows, salts, hash_build=hash_build)
    chosen = {c: F.when(served, F.col(f"__hot{c}")).otherwise(F.col(c)) for c in kept}
    return joined.withColumns(chosen).drop(*[f"__hot{c}" for c in kept])


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _measure(rows: DataFrame, count_copies: bool) -> tuple[int, int, int]:
    """Bytes the rows take as a hash table, and the most rows and bytes any key has."""
    width = F.sum(_width(KEY) + _width(VALUE) + F.lit(_ROW_OVERHEAD)).alias("bytes")
    if count_copies:
        per_key = rows.groupBy(KEY).agg(width, F.count("*").alias("n"))
        found = per_key.agg(F.sum("bytes"), F.max("n"), F.max("bytes")).first()
    else:
        found = rows.agg(width, F.lit(0), F.lit(0)).first()
    return int(found[0] or 0), int(found[1] or 0), int(found[2] or 0)


def _width(column: str) -> Column:
    return F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)).cast("long")


def _salts_for(spark: SparkSession, n_bytes: int, cache: bool) -> int:
    """How many copies of a lookup to spread hot keys over.

    One, when adaptive execution sees both sides of the join as shuffles and
    splits what is hot; else as many as the budget for copies allows.
    """
    splits = all(
        spark.conf.get(name).lower() == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )
    if splits and not cache:
        return 1
    return max(1, min(MAX_SALTS, REPLICATION_BUDGET_BYTES // max(1, n_bytes)))


def _pin(lookup: Lookup) -> Lookup:
    """Keep the snapshot on the executors, a shuffled one laid out by the join keys."""
    rows = lookup.rows
    divided = lookup.salts > 1 or lookup.hot_share is not None
    if not lookup.broadcast and divided and lookup.chunks is None:
        # Later joins then move only records. Where nothing else divides a hot key it is not
        # laid out: adaptive execution must see a shuffle on both sides to split it.
        partitions = _partitions(rows.sparkSession)
        rows = _replicate(rows, lookup.salts).repartition(partitions, KEY, _SALT)
    tables = [rows] if lookup.chunks is None else [rows, lookup.chunks]
    pinned = [table.persist(StorageLevel.MEMORY_AND_DISK) for table in tables]
    return replace(lookup, rows=rows, cached=pinned)


def _divide(rows: DataFrame, salts: int, group_rows: int) -> DataFrame:
    """Divide the rows of a key into chunks, and mark the first row of every key.

    Written with aggregates that combine before the shuffle instead of a
    window, so a key with very many rows is never gathered in one task.
    """
    counted = rows.groupBy(KEY, VALUE).agg(F.count("*").alias("copies"))
    lead = counted.groupBy(F.col(KEY).alias("lead_key")).agg(
        F.min(F.struct(VALUE)).alias("lead"), F.sum("copies").alias("rows")
    )
    marked = _spread_left_join(counted, F.col(KEY), lead, salts, "lead_key")
    last_block = F.floor((F.col("copies") - 1) / _BLOCK)
    blocks = marked.select(
        KEY,
        VALUE,
        "copies",
        F.ceil(F.col("rows") / group_rows).alias("chunks"),
        F.col(VALUE).eqNullSafe(F.col(f"lead.{VALUE}")).alias("leads"),
        F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"),
    )
    start = F.col("block") * _BLOCK
    copy = F.explode(F.sequence(start, F.least(F.col("copies"), start + _BLOCK) - 1))
    each = blocks.select(KEY, VALUE, "chunks", "leads", copy.alias("copy"))
    return each.select(
        KEY,
        VALUE,
        (F.col("leads") & (F.col("copy") == 0)).alias(FIRST),
        F.pmod(F.xxhash64(VALUE, "copy"), F.col("chunks")).cast("int").alias(_CHUNK),
    )


def _replicate(rows: DataFrame, salts: int) -> DataFrame:
    return rows.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _spread_left_join(
    df: DataFrame,
    key: Column,
    right: DataFrame,
    salts: int,
    right_key: str = KEY,
    also: Column | None = None,
    hash_build: bool = False,
) -> DataFrame:
    """Left join on a key by shuffle, with the left side spread over the salts.

    The salt comes from the number of the row's input partition alone: it needs
    no column to be read, it spreads exact copies of one row, and a task that
    runs again after an executor is lost gives the same salt.
    """
    if _SALT not in right.columns:
        right = _replicate(right, salts)
    partition = F.spark_partition_id()
    # A missing key equals nothing, so any salt is right and a wide one spreads it.
    salt = F.when(key.isNull(), partition).otherwise(partition % F.lit(salts))
    on = (key == F.col(right_key)) & (F.col("__row_salt") == F.col(_SALT))
    if also is not None:
        on = on & also
    # The right side was measured as too large to broadcast; an estimate of
    # Spark's must not decide otherwise. Where a task's share of it is small,
    # a hash table of that share saves sorting both sides.
    hinted = right.hint("shuffle_hash" if hash_build else "merge")
    joined = df.withColumn("__row_salt", salt).join(hinted, on, "left")
    return joined.drop("__row_salt", _SALT)


def _chunked_left_join(df: DataFrame, source: str, lookup: Lookup) -> DataFrame:
    """Left join where a key of the lookup may have any number of rows.

    Every record becomes one row per chunk of its key, and each of those meets
    at most about ``group_rows`` lookup rows.
    """
    per_key = lookup.chunks.select(F.col(KEY).alias("__chunked_key"), _CHUNKS)
    counted = _spread_left_join(df, named(source), per_key, lookup.salts, "__chunked_key")
    last = F.coalesce(F.col(_CHUNKS), F.lit(1)) - 1
    spread = counted.drop("__chunked_key").withColumn(
        "__row_chunk", F.explode(F.sequence(F.lit(0), last))
    )
    same_chunk = F.col("__row_chunk") == F.col(_CHUNK)
    joined = _spread_left_join(spread, named(source), lookup.rows, lookup.salts, also=same_chunk)
    # A chunk that happens to be empty is no miss: the key has other chunks.
    return joined.where(F.col(_CHUNKS).isNull() | F.col(KEY).isNotNull())
