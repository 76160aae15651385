"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are put into classes by their number of shingles. For each class the
documents are cut into overlapping windows of about the size of its items, so that
a short item inside a long document is a large part of some window. An item and a
window are a candidate when one of ``HASHES`` minima agrees; a candidate is decided
by the exact containment of the item's distinct shingles in the whole document.

An item of class c has at most ``s = 2**(c+1)`` shingles, windows have ``2 s``
positions and start every ``s``, so a passage of an item lies in one window whole.
With a containment of 0.8 their similarity is at least 0.19, and the chance that
all 64 minima differ is below 2e-6; for a whole copy it is below 1e-7. A passage torn
apart into distant halves is still a candidate by each half.

No window is small enough for items of fewer than ``EXACT`` distinct shingles. Their
shingles are one sorted list, every shingle of a document is looked up in it, and
nothing is left to chance.

Items are taken in blocks of bounded size that are sent to all tasks, one after
another: a block's pairs are written down and the block is given up before the next
one is made. Documents are read once for each block and never shuffled.

Defined cases: items whose text is null or empty match nothing, null and empty
documents contain nothing. An item without an id is matched like any other and its
rows have a null ``item_id``. An item with fewer words than the width is one shingle of its own length.
Repeated items and documents each give their rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import lean_batches, stored, without
from maskflow.llm.words import mix, shingle_rows, word_hashes

HASHES = 64
#: Items with fewer distinct shingles are found without minima.
EXACT = 8
_LOW = (1 << 20) - 1
#: Bytes of item text in one block; a longer item is a block of its own.
BLOCK_BYTES = 8 << 20
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_SCHEMA = "doc_id bigint, item_id bigint, n_item int, n_shared int, containment double, digest bigint"


def _minima(rows: np.ndarray, k: int) -> np.ndarray:
    return ((rows * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32)


class Items:
    """The signatures of a block of items, by shingle width and size class."""

    def __init__(self, rows: list[tuple[int, bytes]], width: int):
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.classes: dict[tuple[int, int], list[int]] = {}
        short: dict[int, list[int]] = {}
        words = [w for group in word_hashes(text for _, text in rows) for w in group]
        for (item, _), found in zip(rows, words):
            if not len(found):
                continue
            own = min(width, len(found))
            unique = np.unique(shingle_rows(found, own))
            if len(unique) < EXACT:
                short.setdefault(own, []).append(len(self.ids))
            else:
                step = 1 << int(len(unique)).bit_length()
                self.classes.setdefault((own, step), []).append(len(self.ids))
            self.ids.append(item)
            self.sets.append(unique)
        self.tables = {
            key: [self._table(members, k) for k in range(HASHES)]
            for key, members in self.classes.items()
        }
        self.short = {own: self._list(members) for own, members in short.items()}
        self.widths = sorted({own for own, _ in self.classes} | set(short))

    def _list(self, members: list[int]):
        """The shingles of short items in order, each with its item."""
        tokens = np.concatenate([self.sets[i] for i in members])
        owner = np.repeat(members, [len(self.sets[i]) for i in members])
        order = np.argsort(tokens, kind="stable")
        low = np.zeros(_LOW + 1, bool)
        low[tokens & np.uint64(_LOW)] = True
        return low, tokens[order], owner[order]

    def short_matches(self, rows: np.ndarray, offsets: np.ndarray, width: int):
        """(text, item, shared) for every short item that has a shingle in common with a text."""
        if width not in self.short or not len(rows):
            return
        low, values, owner = self.short[width]
        places = np.flatnonzero(low[rows & np.uint64(_LOW)])
        at = np.minimum(np.searchsorted(values, rows[places]), len(values) - 1)
        places = places[values[at] == rows[places]]
        texts = np.searchsorted(offsets, places, "right") - 1
        cut = np.flatnonzero(np.diff(texts, prepend=-1, append=-1)) if len(texts) else []
        for first, last in zip(cut[:-1], cut[1:]):
            own = np.unique(rows[places[first:last]])
            lo, hi = np.searchsorted(values, own), np.searchsorted(values, own, "right")
            count = hi - lo
            met = owner[np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)]
            for item, shared in zip(*(x.tolist() for x in np.unique(met, return_counts=True))):
                yield int(texts[first]), item, shared

    def _table(self, members: list[int], k: int):
        least = np.array([_minima(self.sets[i], k).min() for i in members])
        order = np.argsort(least, kind="stable")
        low = np.zeros(1 << 16, bool)
        low[least & 0xFFFF] = True
        return low, least[order], np.array(members)[order]

    def candidates(self, rows: np.ndarray, offsets: np.ndarray, width: int) -> set[tuple[int, int]]:
        """(text, item) for shingle rows of several texts laid end to end."""
        steps = sorted(step for own, step in self.classes if own == width)
        found: set[tuple[int, int]] = set()
        if not steps or not len(rows):
            return found
        size = -(-len(rows) // steps[-1]) * steps[-1]
        for k in range(HASHES):
            least = np.full(size, 0xFFFFFFFF, np.uint32)
            least[: len(rows)] = _minima(rows, k)
            step = 1
            for wanted in steps:
                while step < wanted:
                    least = np.minimum(least[0::2], least[1::2])
                    step *= 2
                windows = np.minimum(least, np.r_[least[1:], np.uint32(0xFFFFFFFF)])
                low, values, members = self.tables[width, wanted][k]
                for w in np.flatnonzero(low[windows & 0xFFFF]):
                    a, b = np.searchsorted(values, windows[w]), np.searchsorted(values, windows[w], "right")
                    if a == b:
                        continue
                    first = np.searchsorted(offsets, w * step, "right") - 1
                    last = np.searchsorted(offsets, min((w + 2) * step, len(rows)), "left")
                    found.update((int(d), int(i)) for d in range(first, last) for i in members[a:b])
        return found


def _search(items, num: int, den: int):
    names = ["doc_id", "item_id", "n_item", "n_shared", "containment", "digest"]

    def run(batches):
        block = items.value
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            out, at = [], 0
            for group in word_hashes(texts):
                for width in block.widths:
                    rows = [shingle_rows(words, width) for words in group]
                    offsets = np.cumsum([0, *map(len, rows)])
                    joined = np.concatenate(rows)
                    for d, i, shared in block.short_matches(joined, offsets, width):
                        n = len(block.sets[i])
                        if den * shared >= num * n:
                            out.append((ids[at + d], block.ids[i], n, shared, shared / n, digests[at + d]))
                    pairs = block.candidates(joined, offsets, width)
                    for d in sorted({d for d, _ in pairs}):
                        whole = np.unique(rows[d])
                        for i in sorted(i for e, i in pairs if e == d):
                            item = block.sets[i]
                            if not len(whole):
                                continue
                            where = np.minimum(np.searchsorted(whole, item), len(whole) - 1)
                            shared = int((whole[where] == item).sum())
                            if den * shared >= num * len(item):
                                out.append((ids[at + d], block.ids[i], len(item), shared, shared / len(item), digests[at + d]))
                at += len(group)
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def contaminated(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    num: int = 8,
    den: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment``, one row per pair found.

    A pair is found when ``den * n_shared >= num * n_item``, counted over the item's
    distinct shingles.
    """
    return _pairs(spark, docs, items, width, num, den, id_col, text_col, item_col, item_text_col).drop("digest")


def _pairs(
    spark: SparkSession, docs: DataFrame, items: DataFrame, width: int, num: int, den: int,
    id_col: str, text_col: str, item_col: str, item_text_col: str,
) -> DataFrame:
    """The rows of :func:`contaminated` with the hash of the document's text, ``digest``."""
    lean_batches(spark)
    text = F.col(text_col).cast("string")
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest")
    )
    queries = items.select(
        F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    ).filter("text is not null")
    total = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    dealt = queries.withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {blocks})"))
    found = []
    for k in range(blocks):
        rows = [(r.item_id, r.text.encode()) for r in dealt.filter(f"block = {k}").toLocalIterator()]
        sent = spark.sparkContext.broadcast(Items(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), width))
        # Written before the next block is made, so that one block at a time is held.
        found.append(stored(spark, texts.mapInArrow(_search(sent, num, den), _SCHEMA), "contaminated-block"))
        sent.destroy()
    return reduce(DataFrame.unionByName, found)


def remove_contaminated(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    num: int = 8,
    den: int = 10,
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that contain no item; rows with a null id stay.

    Of several texts under one id only those go that contain an item.
    """
    pairs = _pairs(spark, docs, items, width, num, den, id_col, text_col, item_col, item_text_col)
    gone = pairs.select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest")).distinct()
    return without(docs, stored(spark, gone, "contaminated"), id_col, text_col)
