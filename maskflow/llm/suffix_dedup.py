"""Removal of long repeated passages, byte by byte, with run-length indexes.

A byte goes when it lies in a string of ``length`` bytes that also starts at another
place, in another document or the same one.

Every window of ``length`` bytes has an anchor: the 32 bytes in it with the smallest
hash. Equal windows have equal anchors, so windows need only be compared under one
anchor. The windows of an anchor follow one another; what they cover is its context,
of at most ``2 length`` bytes. Only anchors that occur more than once go on. Equal
contexts are settled by their hash. Contexts that share an anchor and differ are put
together in a run-length index of bounded size, whose matching statistics mark the
windows that occur twice. An anchor with more contexts than one index may hold is
indexed in parts; the hashes of its remaining windows leave a part as packed blocks,
one for each share of the hashes, and are compared over all parts as sorted arrays.

Within a batch of texts equal contexts are combined before the shuffle, so a passage
in a third of all documents sends one row per batch, not one per document.

Defined cases: null text is empty; texts shorter than ``length`` keep every byte.
Rows that repeat an id, or a whole row, are separate places, so repeated rows remove
each other's text. Null ids are kept. Other columns are ignored. Anchors and
contexts are compared by 64-bit hashes; texts are told apart by a 64-bit hash of id
and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.llm.run_index import RunIndex
from maskflow.llm.tables import lean_batches, small, stored
from maskflow.llm.words import BYTES, PIECE, hashes, mix

ANCHOR = 32
#: Bytes of contexts in one index, and contexts of one anchor that it may hold.
INDEX_BYTES = 1 << 20
INDEX_CONTEXTS = 512
#: Windows of anchors in parts that are compared in one share, about.
SHARE_WINDOWS = 1 << 16
_U = np.uint64
_BASE = 0xD1342543DE82EF95


def _rolling(buffer: np.ndarray) -> np.ndarray:
    """The hash of the 32 bytes from each position on."""
    h, width = BYTES[buffer], 1
    while width < ANCHOR:
        h = h[:-width] * _U(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    return mix(h)


def _window_least(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = width - span
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def contexts(buffer: np.ndarray, first: np.ndarray, last: np.ndarray, length: int):
    """Anchor hash, context hash, start and end of each context.

    ``first`` and ``last`` bound the windows of each text: they start at ``first`` to
    ``last - 1``.
    """
    none = np.zeros(0, np.int64)
    if len(buffer) < length or not (last > first).any():
        return none.astype(_U), none.astype(_U), none, none
    h = _rolling(buffer)
    key = h & _U(0xFFFFFFFFFF000000) | np.arange(len(h), dtype=_U)
    least = _window_least(key, length - ANCHOR + 1)
    inside = np.zeros(len(least) + 1, np.int64)
    keep = last > first
    np.add.at(inside, first[keep], 1)
    np.add.at(inside, last[keep], -1)
    valid = np.flatnonzero(np.cumsum(inside[:-1]))
    anchor = (least[valid] & _U(0xFFFFFF)).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)]
    # A text begins a context of its own, even right behind another text's windows.
    new |= np.isin(valid, first[keep])
    at = np.flatnonzero(new)
    start = valid[at]
    end = valid[np.r_[at[1:], len(valid)] - 1] + length
    return h[anchor[at]], hashes(buffer, start, end, BYTES), start, end


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list, np.ndarray, np.ndarray]]:
    """Byte arrays of whole texts or parts of long ones.

    Yields the bytes, (text, offset of its first byte there) for each part, and the
    bounds of its windows. Parts of one text overlap, so that each window is in one.
    """
    group, where, first, last, size = [], [], [], [], 0

    def packed():
        return np.frombuffer(b"".join(group), np.uint8), where, np.array(first), np.array(last)

    for k, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[begin : begin + PIECE + length - 1]
            if size and size + len(part) > 2 * PIECE:
                yield packed()
                group, where, first, last, size = [], [], [], [], 0
            group.append(part)
            where.append((k, begin - size))
            first.append(size)
            last.append(size + max(0, len(part) - length + 1))
            size += len(part)
    if group:
        yield packed()


_PLACES = "deal bigint, anchor bigint, ctx bigint, k bigint, lo bigint, hi bigint, twice boolean"


def _send_places(length: int):
    """A row per context. Of equal ones in a batch one is dealt by its anchor.

    The others are settled, and dealt evenly.
    """

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = [[] for _ in range(5)]
            for buffer, where, first, last in _pieces(texts, length):
                anchor, ctx, start, end = contexts(buffer, first, last, length)
                part = np.searchsorted(first, start, "right") - 1
                owner, shift = np.array([w[0] for w in where])[part], np.array([w[1] for w in where])[part]
                for column, own in zip(found, (anchor, ctx, keys[owner], start + shift, end + shift)):
                    column.append(own)
            anchor, ctx, k, lo, hi = map(np.concatenate, found)
            if not len(anchor):
                continue
            order = np.lexsort((ctx, anchor))
            anchor, ctx, k, lo, hi = anchor[order], ctx[order], k[order], lo[order], hi[order]
            same = (anchor[1:] == anchor[:-1]) & (ctx[1:] == ctx[:-1])
            again, twice = np.r_[False, same], np.r_[False, same] | np.r_[same, False]
            deal = np.where(again, mix(k.view(_U) ^ lo.view(_U)), anchor)
            yield pa.record_batch(
                [
                    pa.array(deal.view(np.int64)), pa.array(anchor.view(np.int64)), pa.array(ctx.view(np.int64)),
                    pa.array(k), pa.array(lo), pa.array(hi), pa.array(twice),
                ],
                ["deal", "anchor", "ctx", "k", "lo", "hi", "twice"],
            )

    return run


def _repeated_places(places: DataFrame) -> DataFrame:
    """The places whose anchor occurs again.

    ``whole``: the context occurs again, so all its windows do. ``rep``: the one place
    of its context that stands for it among other contexts of the anchor.
    """
    group = Window.partitionBy("deal", "anchor")
    row = group.orderBy("ctx", "k", "lo")
    own = places.select(
        "*",
        F.lag("ctx").over(row).alias("up"),
        F.lead("ctx").over(row).alias("down"),
        (F.min("ctx").over(group) != F.max("ctx").over(group)).alias("mixed"),
    )
    found = own.select(
        "anchor", "k", "lo", "hi",
        (F.col("twice") | F.expr("up <=> ctx") | F.expr("down <=> ctx")).alias("whole"),
        (F.col("mixed") & ~F.expr("up <=> ctx")).alias("rep"),
    )
    return found.filter("whole or rep")


def _send_contexts():
    """The bytes of the contexts that a text is asked for."""

    def run(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            keys, wanted = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            anchor, part, parts, k, lo, data, size = [], [], [], [], [], [], 0
            for text, key, places in zip(texts, keys, wanted):
                for place in places:
                    anchor.append(place["anchor"])
                    part.append(place["part"])
                    parts.append(place["parts"])
                    k.append(key)
                    lo.append(place["lo"])
                    data.append(text[place["lo"] : place["hi"]])
                    size += len(data[-1])
                if size > 4 << 20:
                    yield _context_rows(anchor, part, parts, k, lo, data)
                    anchor, part, parts, k, lo, data, size = [], [], [], [], [], [], 0
            if anchor:
                yield _context_rows(anchor, part, parts, k, lo, data)

    return run


_CONTEXTS = "anchor bigint, part int, parts int, k bigint, lo bigint, data binary"


def _context_rows(*columns):
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = ["anchor", "part", "parts", "k", "lo", "data"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)


_MARKS = "k bigint, lo bigint, hi bigint, share int, block binary"


def _index(length: int, shares: int):
    """Marks of repeated windows, by one index after the other.

    Contexts come sorted by anchor and part. An index closes at an anchor's end. An
    anchor in several parts has an index for each, in whichever task the part is; the
    windows that it does not mark are passed on by hash, with one of each kind that it
    does: a block for each share of the hashes.
    """
    names = ["k", "lo", "hi", "share", "block"]

    def indexed(k, lo, data, partial):
        index = RunIndex(data)
        hit = index.repeated(length)
        owner = np.repeat(np.arange(len(data)), index.sizes + 1)
        at = np.arange(index.n) - index.starts[owner] + np.array(lo)[owner]
        keys = np.array(k)[owner]
        start = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8)]) == 1)
        stop = np.flatnonzero(np.diff(np.r_[hit.view(np.int8), 0]) == -1)
        out = [pa.array(keys[start]), pa.array(at[start]), pa.array(at[stop] + length)]
        yield pa.record_batch(
            [*out, pa.nulls(len(start), pa.int32()), pa.nulls(len(start), pa.binary())], names
        )
        if partial:
            text = np.frombuffer(b"\xff".join(data) + b"\xff", np.uint8)
            windows = np.flatnonzero(index.left >= length)
            value = hashes(text, windows, windows + length, BYTES)
            marked = hit[windows]
            _, one = np.unique(value[marked], return_index=True)
            send = np.r_[windows[~marked], windows[marked][one]]
            value = np.r_[value[~marked], value[marked][one]]
            twice = np.r_[np.zeros(int((~marked).sum()), bool), np.ones(len(one), bool)]
            share = (value % _U(shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            share, value, twice, send = share[order], value[order], twice[order], send[order]
            cut = np.flatnonzero(np.diff(share, prepend=-1))
            blocks = [
                b"".join(x[a:b].tobytes() for x in (value, keys[send], at[send], twice))
                for a, b in zip(cut, np.append(cut[1:], len(share)))
            ]
            none = pa.nulls(len(cut), pa.int64())
            yield pa.record_batch(
                [none, none, none, pa.array(share[cut].astype(np.int32)), pa.array(blocks, pa.binary())], names
            )

    def run(batches):
        k, lo, data, size, current, split = [], [], [], 0, None, False
        for batch in batches:
            for anchor, part, parts, own, at, text in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if (anchor, part) != current:
                    if data and (size > INDEX_BYTES or split or parts > 1):
                        yield from indexed(k, lo, data, split)
                        k, lo, data, size = [], [], [], 0
                    current, split = (anchor, part), parts > 1
                k.append(own)
                lo.append(at)
                data.append(text)
                size += len(text)
        if data:
            yield from indexed(k, lo, data, split)

    return run


def _compare(length: int):
    """Windows of anchors in parts that occur again in any part, as spans of their texts."""

    def found(blocks):
        columns = []
        for block in blocks:
            n = len(block) // 25
            kinds = (np.uint64, 0), (np.int64, 8 * n), (np.int64, 16 * n), (bool, 24 * n)
            columns.append([np.frombuffer(block, kind, n, place) for kind, place in kinds])
        value, k, lo, twice = (np.concatenate(c) for c in zip(*columns))
        order = np.argsort(value, kind="stable")
        value, k, lo, twice = value[order], k[order], lo[order], twice[order]
        at = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        size = np.diff(np.append(at, len(value)))
        again = np.repeat((size > 1) | np.logical_or.reduceat(twice, at), size) & ~twice
        k, lo = k[again], lo[again]
        order = np.lexsort((lo, k))
        k, lo = k[order], lo[order]
        # Windows that touch are one span.
        first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (lo[1:] > lo[:-1] + length)]) if len(k) else order
        last = np.append(first[1:], len(k)) - 1 if len(k) else order
        return pa.record_batch([pa.array(k[first]), pa.array(lo[first]), pa.array(lo[last] + length)], ["k", "lo", "hi"])

    def run(batches):
        current, blocks = None, []
        for batch in batches:
            for share, block in zip(*(c.to_pylist() for c in batch.columns)):
                if share != current and blocks:
                    yield found(blocks)
                    blocks = []
                current = share
                blocks.append(block)
        if blocks:
            yield found(blocks)

    return run


def _merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _merged(batches):
    for batch in batches:
        found = [
            np.array(_merge_spans([(s["lo"], s["hi"]) for s in spans]), np.int64).tobytes()
            for spans in batch.column(1).to_pylist()
        ]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], ["k", "spans"])


def _cut(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "spans"]
    for batch in batches:
        sizes, removed, counts, digests, kept, runs = [], [], [], [], [], []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for text, packed in zip(texts, batch.column(2).to_pylist()):
            text = text or b""
            spans = np.frombuffer(packed or b"", np.int64).reshape(-1, 2).tolist()
            edges = [0, *(x for span in spans for x in span), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2]))
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            counts.append(len(spans))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode("utf-8", "replace"))
            runs.append([{"start": a, "stop": b} for a, b in spans])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.record_batch(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(counts, pa.int64()), pa.array(digests), pa.array(kept), pa.array(runs, kind),
            ],
            names,
        )


def repeated_spans(
    spark: SparkSession, docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``k, spans``: merged byte ranges to remove, for texts that have some.

    ``k`` is the hash of id and text; ``spans`` are pairs of 64-bit integers.
    """
    lean_batches(spark)
    texts = _keyed(docs, id_col, text_col)
    places = texts.select("k", "text").mapInArrow(_send_places(length), _PLACES)
    found = stored(spark, _repeated_places(places), "places")
    reps = found.filter("rep").select("anchor", "k", "lo", "hi")
    # Anchors with more contexts than an index may hold are dealt out in parts.
    many = reps.groupBy("anchor").agg(
        F.ceil(F.count(F.lit(1)) / INDEX_CONTEXTS).cast("int").alias("parts")
    ).filter("parts > 1")
    many = stored(spark, many.withColumnRenamed("anchor", "_anchor"), "many-contexts")
    dealt = reps.join(small(many, many.count(), 24), F.col("anchor") == F.col("_anchor"), "left")
    parts = F.coalesce("parts", F.lit(1))
    dealt = dealt.select(
        "anchor", "k", "lo", "hi", parts.alias("parts"), F.pmod(F.xxhash64("k", "lo"), parts).cast("int").alias("part")
    )
    asked = dealt.groupBy(F.col("k").alias("_k")).agg(
        F.collect_list(F.struct("anchor", "part", "parts", "lo", "hi")).alias("wanted")
    )
    # The side grows with the documents, so it is always met by a shuffle.
    sent = texts.select("text", "k").join(asked.hint("merge"), F.col("k") == F.col("_k")).select("text", "k", "wanted")
    # Each part has at most so many windows; the shares grow with the parts.
    parted = many.agg(F.sum("parts")).first()[0] or 0
    shares = 1 + parted * INDEX_CONTEXTS * length // SHARE_WINDOWS
    marks = stored(
        spark,
        sent.mapInArrow(_send_contexts(), _CONTEXTS)
        .repartition("anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(_index(length, shares), _MARKS),
        "marks",
    )
    # Windows of anchors that were indexed in parts: repeated when any part says so.
    blocks = marks.filter("share is not null").select("share", "block")
    late = blocks.repartition("share").sortWithinPartitions("share").mapInArrow(_compare(length), "k bigint, lo bigint, hi bigint")
    spans = (
        found.filter("whole").select("k", "lo", "hi")
        .unionByName(marks.filter("share is null").select("k", "lo", "hi"))
        .unionByName(late)
    )
    lists = spans.groupBy("k").agg(F.collect_list(F.struct("lo", "hi")).alias("all"))
    return lists.mapInArrow(_merged, "k bigint, spans binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.withColumn("k", F.xxhash64("doc_id", "text"))


def remove_repeats(
    spark: SparkSession, docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text, spans`` for every row.

    ``text`` is what is left; a character cut in the middle becomes U+FFFD there, while
    ``kept_sha256`` is over the bytes themselves. ``spans`` are the removed byte ranges.
    """
    spans = repeated_spans(spark, docs, length, id_col, text_col).withColumnRenamed("k", "_k")
    joined = _keyed(docs, id_col, text_col).join(spans.hint("merge"), F.col("k") == F.col("_k"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string, "
        "spans array<struct<start: bigint, stop: bigint>>",
    )
