"""Exact set-similarity join on word shingles by a grouped prefix join.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold. A linked pair shares a shingle among the first ``n - ceil(t n) + 1``
shingles of either set under any global order. The order here puts rare shingles
first: shingles are counted over all documents, by packed blocks that are dealt out
by shingle, and the lists of shared shingles go back to their documents. A document
whose prefix is filled by shingles that nobody else has needs no comparison at all,
however many common passages it holds. This is done twice: with a fixed part of the
hash space counted over all documents, which settles most of them, and then with
every shingle counted over those that are left.

Equal sets are one member. Members with the same prefix and size form one group, and
groups meet by the shingles of their prefixes. Pairs are verified on the whole sets:
first each member with one hub, then with a few more, then, across the components
found so far, all that share a prefix shingle, block against block. No pair inside a component
needs to be looked at, so thousands of near copies cost one comparison each.

Defined cases: null text and text without words have no shingles and link with
nothing; fewer words than the width give one shingle. Rows with a null id take part
in the comparison of sets but get a null component unless linked. Repeated ids give
a row each. Other columns are ignored. Sets are told apart by 64-bit hashes, shingles
compared as 48-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.llm.components import components
from maskflow.llm.tables import lean_batches, small, stored, without
from maskflow.llm.words import mix, shingles, word_hashes

#: The part of the hash space whose shingles are counted over all documents at first.
COUNTED = 0.25
#: Hubs that members outside a shingle's largest component try before all are compared.
HUBS = 8
#: Shingles held before a task sends them on, and shingles in one block of counting.
FLUSH = 1_000_000
BLOCK = 500_000
#: Members that one task compares with the same hub.
HUB_MEMBERS = 2_000
#: Members outside a component that are compared at once.
BLOCK_MEMBERS = 1_000


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    for group in word_hashes(texts):
        for words in group:
            yield shingles(words, width)


def _set_id(found: np.ndarray) -> int:
    total = mix(found).sum(dtype=np.uint64) ^ np.uint64(len(found))
    return int(total.view(np.int64))


def _prefix(n, num: int, den: int):
    return n - -(-n * num // den) + 1


def shingle_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, gid, digest``: size and identity of each document's shingle set, hash of its text."""

    def run(batches):
        for batch in batches:
            sizes, ids = [], []
            for found in _sets(_texts(batch.column(1)), width):
                sizes.append(len(found))
                ids.append(_set_id(found) if len(found) else None)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), batch.column(2)],
                ["doc_id", "n", "gid", "digest"],
            )

    text = F.col(text_col).cast("string")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text, F.xxhash64(text).alias("digest"))
    return plain.mapInArrow(run, "doc_id bigint, n bigint, gid bigint, digest bigint")


def _planes(tokens: np.ndarray) -> tuple[bytes, bytes]:
    top = tokens >> np.uint64(24)
    return (top >> np.uint64(8)).astype(np.uint32).tobytes(), top.astype(np.uint8).tobytes()


def _joined(high: bytes, low: bytes) -> np.ndarray:
    top = np.frombuffer(high, np.uint32).astype(np.int64)
    return (top << 8) | np.frombuffer(low, np.uint8)


_BLOCK_SCHEMA = "bucket int, gids binary, n binary, m binary, at binary, high binary, low binary"


def _limit(counted: float) -> int:
    """The first 40-bit value that is not counted."""
    return int(counted * (1 << 40))


def _send_tokens(width: int, num: int, den: int, buckets: int, counted: float):
    """Packed blocks of (shingle, set), one per bucket of shingles."""
    names = ["bucket", "gids", "n", "m", "at", "high", "low"]
    limit = np.uint64(min(_limit(counted) << 24, (1 << 64) - 1))

    def flush(held):
        gids, ns, ms, parts = held
        tokens = np.concatenate(parts)
        at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        gids, ns, ms = np.array(gids, np.int64), np.array(ns, np.uint32), np.array(ms, np.uint32)
        rows = []
        for k in np.flatnonzero(np.diff(cut)):
            own = order[cut[k] : cut[k + 1]]
            used, where = np.unique(at[own], return_inverse=True)
            high, low = _planes(tokens[own])
            rows.append(
                (k, gids[used].tobytes(), ns[used].tobytes(), ms[used].tobytes(),
                 where.astype(np.uint32 if len(used) > 65535 else np.uint16).tobytes(), high, low)
            )
        kinds = [pa.int32()] + [pa.binary()] * 6
        return pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names
        )

    def run(batches):
        held, seen, size = ([], [], [], []), set(), 0
        for batch in batches:
            for found in _sets(_texts(batch.column(0)), width):
                n = len(found)
                if not n or (gid := _set_id(found)) in seen:
                    continue
                seen.add(gid)
                m = n if counted >= 1 else int(np.searchsorted(found, limit))
                part = found[: max(m, _prefix(n, num, den))]
                for column, value in zip(held, (gid, n, m, part)):
                    column.append(value)
                size += len(part)
                if size >= FLUSH:
                    yield flush(held)
                    held, seen, size = ([], [], [], []), set(), 0
        if size:
            yield flush(held)

    return run


def _by_bucket(batches) -> Iterator[tuple[int, list[dict]]]:
    """Rows of a partition sorted by bucket, one bucket at a time."""
    rows, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current:
                if rows:
                    yield current, rows
                rows, current = [], row["bucket"]
            rows.append(row)
    if rows:
        yield current, rows


_SHARED_SCHEMA = "bucket int, gids binary, n binary, m binary, high binary, low binary, df binary"


def _count_tokens(buckets: int):
    """Of a bucket of shingles, those that more than one set holds, dealt by set."""
    names = ["bucket", "gids", "n", "m", "high", "low", "df"]

    def run(batches):
        for _, rows in _by_bucket(batches):
            gid, n, m, token = [], [], [], []
            for row in rows:
                at = row["at"]
                count = len(row["low"])
                at = np.frombuffer(at, np.uint32 if len(at) == 4 * count else np.uint16)
                gid.append(np.frombuffer(row["gids"], np.int64)[at])
                n.append(np.frombuffer(row["n"], np.uint32)[at])
                m.append(np.frombuffer(row["m"], np.uint32)[at])
                token.append(_joined(row["high"], row["low"]))
            rows.clear()
            gid, n, m, token = map(np.concatenate, (gid, n, m, token))
            order = np.lexsort((gid, token))
            gid, n, m, token = gid[order], n[order], m[order], token[order]
            new_token = np.r_[True, token[1:] != token[:-1]]
            first = new_token | np.r_[True, gid[1:] != gid[:-1]]
            gid, n, m, token = gid[first], n[first], m[first], token[first]
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            df = np.repeat(df_each := np.diff(np.r_[start, len(token)]), df_each)
            keep = df > 1
            if not keep.any():
                continue
            gid, n, m, token, df = gid[keep], n[keep], m[keep], token[keep], df[keep]
            bucket = (mix(gid.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((gid, bucket))
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = []
            for k in np.flatnonzero(np.diff(cut)):
                own = order[cut[k] : cut[k + 1]]
                t = token[own]
                out.append(
                    (k, gid[own].tobytes(), n[own].tobytes(), m[own].tobytes(),
                     (t >> 8).astype(np.uint32).tobytes(), t.astype(np.uint8).tobytes(),
                     df[own].astype(np.uint32).tobytes())
                )
            kinds = [pa.int32()] + [pa.binary()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


_PREFIX_SCHEMA = "token bigint, gid bigint, grp bigint, n bigint, s bigint, r bigint"


def _choose_prefixes(num: int, den: int, counted: float, ids_only: bool):
    """The shared shingles in the prefix of each set, rare ones first.

    ``s`` is the number of counted shingles that no other set has; they come first
    in the order, and ``r`` is the place of the shingle in it. Sets with equal size and equal prefix get the same ``grp``.
    """
    limit = _limit(counted)

    def run(batches):
        for _, rows in _by_bucket(batches):
            gid = np.concatenate([np.frombuffer(r["gids"], np.int64) for r in rows])
            n = np.concatenate([np.frombuffer(r["n"], np.uint32) for r in rows]).astype(np.int64)
            m = np.concatenate([np.frombuffer(r["m"], np.uint32) for r in rows]).astype(np.int64)
            df = np.concatenate([np.frombuffer(r["df"], np.uint32) for r in rows])
            token = np.concatenate([_joined(r["high"], r["low"]) for r in rows])
            rows.clear()
            late = token >= limit
            order = np.lexsort((token, np.where(late, 0, df), late, gid))
            gid, n, m, token, late = gid[order], n[order], m[order], token[order], late[order]
            start = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
            count = np.diff(np.r_[start, len(gid)])
            counted = np.add.reduceat((~late).astype(np.int64), start)
            rank = np.arange(len(gid)) - np.repeat(start, count)
            s = m - np.repeat(counted, count)
            take = late | (rank < _prefix(n, num, den) - s)
            gid, n, s, token, r = gid[take], n[take], s[take], token[take], (s + rank)[take]
            if not len(gid):
                continue
            start = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
            count = np.diff(np.r_[start, len(gid)])
            if ids_only:
                yield pa.record_batch([pa.array(gid[start])], ["gid"])
                continue
            # In order of rank, so that equal prefixes sum to equal values.
            key = mix(token.view(np.uint64))
            whole = np.add.reduceat(key, start) + mix(count.astype(np.uint64) + (n[start].astype(np.uint64) << np.uint64(32)))
            alike = (s[start] == 0)
            grp = np.where(alike, mix(whole).view(np.int64), gid[start])
            yield pa.record_batch(
                [token, gid, np.repeat(grp, count), n, s, r], ["token", "gid", "grp", "n", "s", "r"]
            )

    return run


def _send_sets(width: int):
    """The set of each text, to every cell that asks for it.

    Texts are met by id; of several under one id only the one whose set is asked for counts.
    """
    names = ["hub", "cell", "role", "gid", "high", "low"]

    def run(batches):
        for batch in batches:
            out, size = [], 0
            ids, cells = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for gid, own, found in zip(ids, cells, _sets(_texts(batch.column(0)), width)):
                if _set_id(found) != gid:
                    continue
                high = (found >> np.uint64(32)).astype(np.uint32).tobytes()
                low = (found >> np.uint64(16)).astype(np.uint16).tobytes()
                for c in own:
                    out.append((c["hub"], c["cell"], c["role"], gid, high, low))
                    size += len(found) * 6
                    if size > 4 << 20:
                        yield _record(out, names)
                        out, size = [], 0
            if out:
                yield _record(out, names)

    return run


def _record(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _unpack(high: bytes, low: bytes) -> np.ndarray:
    return (np.frombuffer(high, np.uint32).astype(np.int64) << 16) | np.frombuffer(low, np.uint16)


def _links_of_hub(num: int, den: int):
    """Links between a hub and the members that follow it in the sorted partition."""

    def run(batches):
        hub, other = None, None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(k) for k in range(6)]
            for i in range(batch.num_rows):
                found = _unpack(columns[4][i].as_py(), columns[5][i].as_py())
                if columns[2][i].as_py() == 0:
                    hub, other = columns[0][i].as_py(), found
                    continue
                at = np.minimum(np.searchsorted(other, found), len(other) - 1)
                both = int((other[at] == found).sum())
                if den * both >= num * (len(other) + len(found) - both):
                    a.append(hub)
                    b.append(columns[3][i].as_py())
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _links_of_cell(num: int, den: int):
    """Links between the members of a block and the rows that follow them.

    The block is an inverted list from shingle to member; a row's overlaps with all of
    them are counted at once.
    """

    def run(batches):
        current, ids, sets, index = None, [], [], None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for hub, cell, role, gid, high, low in zip(*columns):
                if (hub, cell) != current:
                    current, ids, sets, index = (hub, cell), [], [], None
                found = _unpack(high, low)
                if role == 0:
                    ids.append(gid)
                    sets.append(found)
                    continue
                if not ids:
                    continue
                if index is None:
                    sizes = np.array([len(x) for x in sets])
                    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(ids)), sizes)
                    order = np.argsort(tokens, kind="stable")
                    index = tokens[order], owner[order], sizes
                tokens, owner, sizes = index
                lo, hi = np.searchsorted(tokens, found), np.searchsorted(tokens, found, "right")
                count = hi - lo
                at = np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)
                both = np.bincount(owner[at], minlength=len(ids))
                for k in np.flatnonzero(den * both >= num * (sizes + len(found) - both)):
                    if ids[k] != gid:
                        a.append(ids[k])
                        b.append(gid)
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _dealt_sets(
    spark: SparkSession, texts: DataFrame, members: DataFrame, asked: DataFrame, width: int
) -> DataFrame:
    """The sets that ``asked`` (gid, hub, cell, role) names, together by hub and cell.

    ``members`` has one document per set; its whole text is read again. The list of
    documents is broadcast when it is small enough.
    """
    lists = asked.groupBy("gid").agg(F.collect_list(F.struct("hub", "cell", "role")).alias("cells"))
    wanted = stored(
        spark, lists.join(members, "gid").select("gid", "cells", F.col("doc_id").alias("_doc")), "wanted"
    )
    count, cells = wanted.agg(F.count(F.lit(1)), F.sum(F.size("cells"))).first()
    chosen = texts.join(small(wanted, 1, 60 * count + 24 * (cells or 0)), F.col("_id") == F.col("_doc"))
    sets = chosen.select("text", "gid", "cells").mapInArrow(
        _send_sets(width), "hub bigint, cell int, role int, gid bigint, high binary, low binary"
    )
    return sets.repartition("hub", "cell").sortWithinPartitions("hub", "cell", "role")


def _try_hubs(
    spark: SparkSession, texts: DataFrame, members: DataFrame, pairs: DataFrame, width: int, num: int, den: int
) -> DataFrame:
    """The links among pairs (a: hub, b: member). A hub with many members has several cells."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("int").alias("parts"))
    own = parts.select(
        F.col("a").alias("gid"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("cell"),
        F.lit(0).alias("role"),
    )
    others = pairs.join(parts, "a").select(
        F.col("b").alias("gid"), F.col("a").alias("hub"), F.expr("int(pmod(xxhash64(b), parts))").alias("cell"),
        F.lit(1).alias("role"),
    )
    sets = _dealt_sets(spark, texts, members, own.unionByName(others), width)
    return sets.mapInArrow(_links_of_hub(num, den), "a bigint, b bigint")


def _try_rest(
    spark: SparkSession, texts: DataFrame, members: DataFrame, rows: DataFrame, width: int, num: int, den: int
) -> DataFrame:
    """All links that span components, among members that share a prefix shingle.

    ``rows`` come from :func:`_spanning`. Members outside a shingle's largest component
    are compared with all members around that component, block by block: no pair is
    written down unless it links.
    """
    roles = rows.groupBy(F.col("top").alias("hub"), "gid").agg(F.max(F.col("comp") != F.col("top")).alias("outside"))
    sizes = roles.groupBy("hub").agg(
        F.ceil(F.count_if("outside") / BLOCK_MEMBERS).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("int").alias("parts"),
    )
    held = roles.join(sizes.filter("blocks > 0"), "hub")
    # The cells of a block are its row of the grid, those of a part its column.
    row = F.expr("transform(sequence(0, parts - 1), p -> int(pmod(xxhash64(gid), blocks)) * parts + p)")
    column = F.expr("transform(sequence(0, blocks - 1), b -> b * parts + int(pmod(xxhash64(gid, 1), parts)))")
    strays = held.filter("outside").select(
        "gid", "hub", F.explode(row).alias("cell"),
        F.lit(0).alias("role"),
    )
    targets = held.select(
        "gid", "hub", F.explode(column).alias("cell"),
        F.lit(1).alias("role"),
    )
    sets = _dealt_sets(spark, texts, members, strays.unionByName(targets), width)
    return sets.mapInArrow(_links_of_cell(num, den), "a bigint, b bigint")


def _prefixes(
    spark: SparkSession, texts: DataFrame, tokens: int, width: int, num: int, den: int, counted: float,
    ids_only: bool,
) -> DataFrame:
    """The prefix rows of the sets of ``texts``, or only the sets that have some."""
    buckets = max(spark.sparkContext.defaultParallelism, int(tokens * counted) // BLOCK + 1)
    return (
        texts.mapInArrow(_send_tokens(width, num, den, buckets, counted), _BLOCK_SCHEMA)
        .repartition(buckets, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_count_tokens(buckets), _SHARED_SCHEMA)
        .repartition(buckets, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(
            _choose_prefixes(num, den, counted, ids_only), "gid bigint" if ids_only else _PREFIX_SCHEMA
        )
    )


def near_classes(
    spark: SparkSession,
    docs: DataFrame,
    width: int,
    num: int,
    den: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for links with ``den * both >= num * union``.

    ``component_id`` is the smallest id that can be reached by links, the row itself
    included.
    """
    return _classes(spark, docs, width, num, den, id_col, text_col).drop("digest")


def _classes(
    spark: SparkSession, docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str
) -> DataFrame:
    """The rows of :func:`near_classes` with the hash of each text, ``digest``."""
    lean_batches(spark)
    sizes = stored(spark, shingle_sets(docs, width, id_col, text_col), "shingle-sets")
    # ``doc_id`` finds a member's text: the least id, or the text's hash where no row has one.
    least_id = F.min("doc_id")
    members = stored(
        spark,
        sizes.filter("gid is not null").groupBy("gid").agg(
            least_id.alias("least_id"), F.coalesce(least_id, F.min("digest")).alias("doc_id"), F.max("n").alias("n")
        ),
        "members",
    )
    # Sets that may have a link at all, by a part of their shingles.
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("text"))
    # Equal texts without an id once: all of them have one hash to be found by.
    nameless = texts.filter("_id is null and text is not null").groupBy(F.xxhash64("text").alias("_id"))
    nameless = stored(spark, nameless.agg(F.min("text").alias("text")), "texts-without-id")
    texts = texts.filter("_id is not null").unionByName(nameless)
    tokens = members.agg(F.sum("n")).first()[0] or 0
    active = _prefixes(spark, texts.select("text"), tokens, width, num, den, COUNTED, True)
    left = stored(spark, active.join(members, "gid"), "active")
    count, tokens = left.agg(F.count(F.lit(1)), F.sum("n")).first()
    # Their prefixes, by all shingles that they share with one another.
    chosen = texts.join(small(left.select(F.col("doc_id").alias("_doc")), count, 16), F.col("_id") == F.col("_doc"))
    prefixes = stored(
        spark, _prefixes(spark, chosen.select("text"), tokens or 0, width, num, den, 1.0, False), "prefixes"
    )

    # One comparison for each member: with its group's first, or the group's best hub.
    groups = prefixes.groupBy("token", "grp").agg(F.min("gid").alias("rep"), F.min("n").alias("n"))
    groups = groups.withColumn("band", F.floor(F.ln("n") / F.ln(F.lit(den / num))))
    hubs = groups.groupBy("token", "band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("c"))
    met = groups.join(hubs.filter("c > 1"), ["token", "band"]).filter("rep != hub")
    best = met.groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("c")).groupBy("rep").agg(
        F.max_by("hub", F.struct("c", "hub")).alias("hub")
    )
    first = prefixes.groupBy("grp").agg(F.min("gid").alias("hub"))
    inside = prefixes.select("gid", "grp").distinct().join(first, "grp").filter("gid != hub")
    star = stored(
        spark,
        best.select(F.col("hub").alias("a"), F.col("rep").alias("b"))
        .unionByName(inside.select(F.col("hub").alias("a"), F.col("gid").alias("b"))),
        "star",
    )
    plain = members.select("gid", "doc_id")
    links = stored(spark, _try_hubs(spark, texts, plain, star, width, num, den), "links")
    found = stored(spark, components(spark, links), "components")
    # Members that the first hub did not settle try some more, then all that is left.
    rows = stored(spark, _spanning(prefixes, found), "spanning")
    more = stored(spark, _some_hubs(rows, star, num, den), "star")
    links = links.unionByName(stored(spark, _try_hubs(spark, texts, plain, more, width, num, den), "links"))
    found = stored(spark, components(spark, links), "components")
    rows = stored(spark, _spanning(prefixes, found), "spanning")
    links = links.unionByName(stored(spark, _try_rest(spark, texts, plain, rows, width, num, den), "links"))
    found = stored(spark, components(spark, links), "components")

    # From sets to documents: the smallest id of a component.
    labelled = members.join(found.withColumnRenamed("node", "gid"), "gid", "left").withColumn(
        "component", F.coalesce("component", "gid")
    )
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_set = labelled.join(least, "component").select("gid", "component_id")
    return sizes.join(by_set, "gid", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "digest",
    )


def _spanning(prefixes: DataFrame, found: DataFrame) -> DataFrame:
    """Prefix rows with their component, for shingles that span several.

    ``top`` is the shingle's largest component. A shingle within one component gives
    nothing: all its members are linked already.
    """
    rows = prefixes.join(found.withColumnRenamed("node", "gid"), "gid", "left").select(
        "token", "gid", "n", "r", F.coalesce("component", "gid").alias("comp")
    )
    parts = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("token").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("k")
    ).filter("k > 1")
    return rows.join(mixed.select("token", "top"), "token")


def _may_link(num: int, den: int) -> str:
    """Bounds by size, and by the places of the shingle.

    A pair needs ``least`` shingles in common. If this one is the first of them, those
    before it in either set are not shared, so at most ``n - r`` are.
    """
    least = f"(({num} * (n + x_n) + {num + den - 1}) div {num + den})"
    return f"""{den} * least(n, x_n) >= {num} * greatest(n, x_n)
        and n - r >= {least} and x_n - x_r >= {least}"""


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(known, ["a", "b"], "left_anti")


def _some_hubs(rows: DataFrame, tried: DataFrame, num: int, den: int) -> DataFrame:
    """For members outside a shingle's largest component, some members of it to try.

    A member that finds one link needs no more, which leaves few for :func:`_try_rest`.
    Of the hubs of its shingles those that share most are tried.
    """
    order = Window.partitionBy("token").orderBy(F.xxhash64("gid", F.lit(1)), "gid")
    hubs = rows.filter("comp = top").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HUBS)
    hubs = hubs.select("token", *(F.col(c).alias(f"x_{c}") for c in ("gid", "n", "r")))
    met = rows.filter("comp != top").join(hubs, "token").filter(_may_link(num, den))
    counts = met.groupBy(F.least("gid", "x_gid").alias("a"), F.greatest("gid", "x_gid").alias("b"), "gid").agg(
        F.count(F.lit(1)).alias("c")
    )
    best = Window.partitionBy("gid").orderBy(F.desc("c"), "a", "b")
    chosen = _untried(counts, tried).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= HUBS)
    return chosen.select("a", "b").distinct()


def keep_one(
    spark: SparkSession, docs: DataFrame, width: int, num: int, den: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component is kept.

    The smallest id stays. Rows with a null id stay, and so do rows that repeat the id
    that stays. Of several texts under one id only those go that have a smaller id in
    their component.
    """
    classes = _classes(spark, docs, width, num, den, id_col, text_col).filter("doc_id != component_id")
    gone = stored(
        spark, classes.select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest")).distinct(), "gone"
    )
    return without(docs, gone, id_col, text_col)
