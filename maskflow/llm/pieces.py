"""SentencePiece BPE encoding by suffix-array matching, and decoding.

The distinct words of a batch are laid out in one array of characters with a suffix
array over it. Every piece of the vocabulary is found by binary search, which gives
its occurrences as a range; the ranges become edges, the edges are sorted by their
end, and one pass over the ends relaxes them: the piece that ends the encoding of a
prefix is the only one whose neighbour on the left, already known, may stand beside
it. Two neighbours may stand side by side when encoding both together gives back the
two, which the merge order of their inner pieces decides.

A word is a run of meta spaces with what follows; no piece reaches over its border,
so a batch encodes each distinct word once. Characters without a piece become bytes.

Defined cases: null stays null, empty text has no ids. All white space and any
character round-trips; only U+2581 comes back as a space, as in the library. Other
columns are kept. A vocabulary with a piece that its own merges don't give is
refused, since there the pass would not be exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.llm.tables import lean_batches

META = "▁"
#: Characters of distinct words in one suffix array; words kept between batches.
SLICE = 1 << 18
KEPT_WORDS = 200_000
#: Pairs of pieces whose answer is kept.
PAIRS = 1 << 20
#: Characters of texts that are split into words at once.
GROUP = 1 << 21
_NEVER = np.int64(1) << 40


def _merge(text: str, rank: dict[str, int]) -> tuple[list[str], list[tuple[str, str]]]:
    """Merge the best pair, the leftmost of equals, until none is left."""
    parts, steps = list(text), []
    while len(parts) > 1:
        best = min((rank.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if best[0] == _NEVER:
            break
        i = best[1]
        steps.append((parts[i], parts[i + 1]))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, steps


@dataclass
class Vocabulary:
    """Arrays over pieces that encoding and decoding need; made once on the driver."""

    alphabet: dict[str, int]
    texts: list[str]
    ids: np.ndarray  # the model's id of each piece
    rank: np.ndarray  # order of merging; -1 for single characters
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    byte_ids: np.ndarray
    pieces: list[bytes]  # by the model's id, as decoded

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids, pieces, normal = np.zeros(256, np.int32), [], []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                pieces.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i):
                pieces.append(b"")
            elif model.is_unknown(i):
                pieces.append(" ⁇ ".encode())
            else:
                pieces.append(piece.replace(META, " ").encode())
                normal.append((piece, i, -model.get_score(i)))
        texts = [p for p, _, _ in normal]
        at = {p: k for k, p in enumerate(texts)}
        order = {p: int(s) for p, _, s in normal}
        rank = np.array([-1 if len(p) == 1 else order[p] for p in texts], np.int64)
        left, right = np.full(len(texts), -1, np.int32), np.full(len(texts), -1, np.int32)
        pairs = {}
        for k, piece in enumerate(texts):
            if len(piece) == 1:
                continue
            parts, steps = _merge(piece, order)
            last = [order[a + b] for a, b in steps]
            if len(parts) > 1 or last != sorted(last):
                raise ValueError(f"piece {piece!r} is not what its own merges give")
            left[k], right[k] = at[steps[-1][0]], at[steps[-1][1]]
            for cut in range(1, len(piece)):
                if piece[:cut] in at and piece[cut:] in at:
                    pairs[at[piece[:cut]] * len(texts) + at[piece[cut:]]] = order[piece]
        keys = np.array(sorted(pairs), np.int64)
        return cls(
            {c: n + 1 for n, c in enumerate(sorted({c for p in texts for c in p}))},
            texts,
            np.array([i for _, i, _ in normal], np.int32),
            rank, left, right, keys, np.array([pairs[k] for k in keys.tolist()], np.int64),
            byte_ids, pieces,
        )

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces ``a`` and ``b``, each merged alone, are never merged across.

        Walks down the right edge of ``a`` and the left edge of ``b``. A part lives
        from its own merge to that of the part above it; two parts that live at the
        same time are merged when their join comes before either ends.
        """
        valid = np.ones(len(a), bool)
        x, y = a.astype(np.int64), b.astype(np.int64)
        end_x, end_y = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        active = np.arange(len(a))
        while len(active):
            p, q = x[active], y[active]
            key = p * len(self.texts) + q
            where = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joined = np.where(self.pair_keys[where] == key, self.pair_ranks[where], _NEVER)
            bad = (joined < end_x[active]) & (joined <= end_y[active]) & (joined < _NEVER)
            valid[active[bad]] = False
            # The part made later is opened first, back in time: its two parts lived before.
            # On a tie the left one is merged first, so the right one is opened first.
            rp, rq = self.rank[p], self.rank[q]
            open_x = rp > rq
            done = bad | ((rp < 0) & (rq < 0))
            go_x, go_y = active[open_x & ~done], active[~open_x & ~done]
            end_x[go_x], x[go_x] = self.rank[x[go_x]], self.right[x[go_x]]
            end_y[go_y], y[go_y] = self.rank[y[go_y]], self.left[y[go_y]]
            active = active[~done]
        return valid


class Encoder:
    """Encodes words of one task; keeps those it has met, up to a number."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}
        self.pair_key, self.pair_answer = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        free = "".join(c for c in "\t\n\r\x0b\x0c" if c not in vocabulary.alphabet)
        self.split = re.compile(f"{META}+[^{META}{free}]*|[{free}]|[^{META}{free}]+").findall
        lengths = np.array([len(p) for p in vocabulary.texts])
        self.lengths = lengths
        self.width = 4 * -(-int(lengths.max()) // 4)
        codes = np.zeros((len(lengths), self.width), np.uint64)
        for k, piece in enumerate(vocabulary.texts):
            codes[k, : len(piece)] = [vocabulary.alphabet[c] for c in piece]
        inside = np.arange(self.width) < lengths[:, None]
        self.low = self._packed(codes)
        self.high = self._packed(np.where(inside, codes, np.uint64(0xFFFF)))

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As the vocabulary's, with the answers of pairs met before; a newer pair takes the place."""
        key = a * np.int64(len(self.lengths)) + b
        slot = (key * np.int64(0x9E3779B1) >> np.int64(7)) & np.int64(PAIRS - 1)
        new = np.flatnonzero(self.pair_key[slot] != key)
        out = self.pair_answer[slot]
        if len(new):
            out[new] = self.v.beside(a[new], b[new])
            self.pair_key[slot[new]] = key[new]
            # Of pairs that fall on one slot the last key stays; so must its answer.
            self.pair_answer[slot[new]] = out[new]
        return out

    @staticmethod
    def _packed(codes: np.ndarray) -> list[np.ndarray]:
        words = codes.astype(np.uint64)
        return [
            (words[:, k] << np.uint64(48)) | (words[:, k + 1] << np.uint64(32))
            | (words[:, k + 2] << np.uint64(16)) | words[:, k + 3]
            for k in range(0, codes.shape[1], 4)
        ]

    def suffixes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array, by at least the longest piece's length, and packed fours."""
        n = len(codes)
        padded = np.zeros(n + self.width + 4, np.uint64)
        padded[:n] = codes
        fours = padded[:-3] << np.uint64(48) | padded[1:-2] << np.uint64(32)
        fours |= padded[2:-1] << np.uint64(16) | padded[3:]
        key, reach = fours[:n], 4
        while True:
            order = np.argsort(key, kind="stable")
            if reach >= self.width:
                return order, fours
            ordered = key[order]
            rank = np.zeros(n + reach, np.uint64)
            rank[order] = np.cumsum(np.r_[1, ordered[1:] != ordered[:-1]]).astype(np.uint64)
            key = rank[:n] << np.uint64(32) | rank[reach:]
            reach *= 2

    def bound(self, order: np.ndarray, fours: np.ndarray, wanted: list[np.ndarray], after: bool):
        """For every piece, the first suffix not below it (or above it)."""
        lo, hi = np.zeros(len(self.lengths), np.int64), np.full(len(self.lengths), len(order))
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(order) - 1)
            start = order[mid]
            less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for k, w in enumerate(wanted):
                own = fours[start + 4 * k]
                less |= same & (own < w)
                same &= own == w
            less |= same & after
            go = lo < hi
            lo = np.where(go & less, mid + 1, lo)
            hi = np.where(go & ~less, mid, hi)
        return lo

    def encode_new(self, words: list[str]) -> None:
        """Add the ids of words, all different, to what is known."""
        v = self.v
        text = "\n".join(words)  # a separator without a code
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        table, where = np.unique(points, return_inverse=True)
        codes = np.array([v.alphabet.get(chr(c), 0) for c in table], np.uint16)[where]
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(np.r_[0, sizes[:-1] + 1])
        separators = (starts + sizes)[:-1]
        codes[separators] = 0
        order, fours = self.suffixes(codes)
        lo, hi = self.bound(order, fours, self.low, False), self.bound(order, fours, self.high, True)
        count = np.maximum(hi - lo, 0)
        # Edges are many: 32 bits each, and no more columns at a time than needed.
        piece = np.repeat(np.arange(len(count), dtype=np.int32), count)
        at = np.arange(len(piece), dtype=np.int32)
        at += np.repeat((lo - np.cumsum(count) + count).astype(np.int32), count)
        begin = order.astype(np.int32)[at]
        del at
        # A character without a code is an edge of its own, beside anything.
        odd = np.flatnonzero(codes == 0)
        odd = np.setdiff1d(odd, separators, assume_unique=True)
        size = np.concatenate([np.repeat(self.lengths.astype(np.int32), count), np.ones(len(odd), np.int32)])
        begin = np.concatenate([begin, odd.astype(np.int32)])
        piece = np.concatenate([piece, np.full(len(odd), -2, np.int32)])
        end = begin + size
        # Sorted by how far the end is into its word: all words are relaxed abreast.
        first = np.repeat(starts, np.diff(np.r_[starts, len(codes)])).astype(np.int32)
        depth = end - first[begin]
        # Small numbers are sorted by radix.
        by_end = np.argsort(depth.astype(np.uint16) if depth.max() < 1 << 16 else depth, kind="stable")
        begin, piece, end = begin[by_end], piece[by_end], end[by_end]
        cuts = np.searchsorted(depth[by_end], np.arange(1, depth.max() + 2))
        # last[i]: the piece that ends before i; shifted by one word border each.
        last = np.full(len(codes) + 2, -3, np.int64)
        came = np.zeros(len(codes) + 2, np.int64)
        last[starts] = -1
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, p, e = begin[a:b], piece[a:b], end[a:b]
            before = last[s]
            good = before != -3
            test = good & (before >= 0) & (p >= 0)
            good[test] = self.beside(before[test], p[test])
            # A word's end is the next word's separator, so its slot is free.
            last[e[good]], came[e[good]] = p[good], s[good]
        self._collect(words, points, starts, sizes, last, came)

    def _collect(self, words, points, starts, sizes, last, came) -> None:
        """Follow the last pieces back from the end of each word."""
        v = self.v
        at = starts + sizes
        where = np.arange(len(words))
        owners, pieces, places = [], [], []
        while len(where):
            owners.append(where)
            pieces.append(last[at])
            at = came[at]
            places.append(at)
            more = at > starts[where]
            where, at = where[more], at[more]
        owner, piece, place = map(np.concatenate, (owners, pieces, places))
        order = np.lexsort((place, owner))
        owner, piece, place = owner[order], piece[order], place[order]
        if (piece == -3).any():
            raise ValueError("a word has no encoding; the vocabulary lacks single characters")
        ids = np.where(piece >= 0, v.ids[np.maximum(piece, 0)], 0).astype(np.int32)
        count = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(piece < 0)
        spelled = [v.byte_ids[list(chr(points[place[k]]).encode("utf-8", "surrogatepass"))] for k in odd]
        if len(odd):
            count[odd] = [len(x) for x in spelled]
            ids = np.repeat(ids, count)
            first = np.cumsum(count) - count
            for k, x in zip(odd, spelled):
                ids[first[k] : first[k] + len(x)] = x
        total = np.add.reduceat(count, np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]))
        raw, cut = ids.tobytes(), (np.cumsum(np.r_[0, total]) * 4).tolist()
        self.known.update((w, raw[cut[k] : cut[k + 1]]) for k, w in enumerate(words))

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as packed 32-bit integers."""
        out = []
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size > GROUP:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str | None]) -> list[bytes | None]:
        split = [self.split(META + t.replace(" ", META)) if t else [] for t in texts]
        here = {w for words in split for w in words}
        if len(self.known) > KEPT_WORDS:
            # Words of the texts at hand are likely to come again; others go.
            self.known = {w: self.known[w] for w in here & self.known.keys()}
        new = here - self.known.keys()
        part, size = [], 0
        for word in sorted(new):
            part.append(word)
            size += len(word) + 1
            if size > SLICE:
                self.encode_new(part)
                part, size = [], 0
        if part:
            self.encode_new(part)
        known = self.known
        return [
            None if t is None else b"".join([known[w] for w in words]) for t, words in zip(texts, split)
        ]


def decode_ids(vocabulary: Vocabulary, ids) -> str:
    """The text of a list of ids; the space that encoding put in front is taken off."""
    raw = b"".join([vocabulary.pieces[i] for i in ids]).decode("utf-8", "replace")
    return raw[1:] if raw.startswith(" ") else raw


_encoders: dict[int, Encoder] = {}


def _encode(sent):
    def run(batches):
        encoder = _encoders.get(id(sent.value)) or Encoder(sent.value)
        _encoders.clear()
        _encoders[id(sent.value)] = encoder
        for batch in batches:
            packed = encoder.encode(batch.column(batch.num_columns - 1).to_pylist())
            sizes = np.array([len(p or b"") // 4 for p in packed])
            values = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), np.int32))
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, values, mask=pa.array([p is None for p in packed]))
            yield pa.record_batch(
                [*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"]
            )

    return run


def encode(
    spark: SparkSession, docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``docs`` with its text replaced by ``ids_col``, an array of piece ids."""
    lean_batches(spark)
    sent = spark.sparkContext.broadcast(Vocabulary.load(model))
    rest = [c for c in docs.columns if c != text_col]
    # Names that could clash inside the task are numbered, and given back after it.
    plain = docs.select(
        *(F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(rest)),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )
    schema = T.StructType(
        [*plain.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    )
    done = plain.mapInArrow(_encode(sent), schema)
    return done.select(
        *(F.col(f"_{k}").alias(c) for k, c in enumerate(rest)), F.col("ids").alias(ids_col)
    )


def _decode(sent):
    def run(batches):
        vocabulary = sent.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts = []
            for k in range(batch.num_rows):
                ids = column[k].values
                texts.append(None if ids is None else decode_ids(vocabulary, ids.to_numpy(zero_copy_only=False).tolist()))
            yield pa.record_batch(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"]
            )

    return run


def decode(
    spark: SparkSession, rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text"
) -> DataFrame:
    """``rows`` with the text that the ids stand for as ``text_col``."""
    lean_batches(spark)
    sent = spark.sparkContext.broadcast(Vocabulary.load(model))
    plain = rows.select(
        *(F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(rows.columns)),
        F.col(f"`{ids_col}`").alias("_ids"),
    )
    schema = T.StructType([*plain.schema.fields, T.StructField("text", T.StringType())])
    done = plain.mapInArrow(_decode(sent), schema)
    return done.select(
        *(F.col(f"_{k}").alias(c) for k, c in enumerate(rows.columns)), F.col("text").alias(text_col)
    )
