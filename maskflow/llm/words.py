"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. All
texts of a piece are laid out in one byte array; the hash of a word is a difference
of prefix sums, so no Python code runs per word. Equal words have equal hashes in
every task. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes handled at once. A text is cut here only between words, so the limit bounds
#: memory and changes no result.
PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all positions (a bijection)."""
    x = x.copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: A random number for each byte; for words, A-Z have those of a-z.
BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_FOLDED = BYTES.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte array."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = ~SPACE[buffer]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def hashes(
    buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _FOLDED
) -> np.ndarray:
    """The hash of each stretch ``buffer[start:end]``."""
    power, inverse = _tables(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, _U)
    np.cumsum(values[buffer] * power[: len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def _cuts(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            # Back to a space if the piece has one, else on to the next.
            back = max(text.rfind(bytes([b]), at, end) for b in (32, 10, 9, 11, 12, 13))
            if back > at:
                end = back
            else:
                found = [p for b in (32, 10, 9, 11, 12, 13) if (p := text.find(bytes([b]), end)) >= 0]
                end = min(found, default=len(text))
        yield text[at:end]
        at = end


def _words(texts: Iterable[bytes], of) -> Iterator[list]:
    """``of`` applied to groups of consecutive texts, with long texts in parts."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > PIECE:
            yield of(group)
            group, size = [], 0
        if len(text) > PIECE:
            parts = [of([part])[0] for part in _cuts(text)]
            yield [tuple(map(np.concatenate, zip(*parts)))]
        else:
            group.append(text)
            size += len(text) + 1
    if group:
        yield of(group)


def _laid_out(group: list[bytes]):
    buffer = np.frombuffer(b"\n".join(group), np.uint8)
    starts, ends = spans(buffer)
    cut = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in group)]))
    return buffer, starts, ends, cut


def word_hashes(texts: Iterable[bytes]) -> Iterator[list[np.ndarray]]:
    """For groups of consecutive texts, the word hashes of each text."""

    def of(group: list[bytes]) -> list[tuple[np.ndarray]]:
        buffer, starts, ends, cut = _laid_out(group)
        found = hashes(buffer, starts, ends)
        return [(found[a:b],) for a, b in zip(cut[:-1], cut[1:])]

    for group in _words(texts, of):
        yield [found for (found,) in group]


def word_tails(texts: Iterable[bytes]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Like :func:`word_hashes`, with the last two bytes of each word as one number."""

    def of(group: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        buffer, starts, ends, cut = _laid_out(group)
        found = hashes(buffer, starts, ends)
        low = np.where((buffer >= 65) & (buffer <= 90), buffer + 32, buffer).astype(np.int64)
        tails = low[ends - 1] + 256 * np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0)
        return [(found[a:b], tails[a:b]) for a, b in zip(cut[:-1], cut[1:])]

    yield from _words(texts, of)


_STEP = [_U(pow(0x9FB21C651E98DF25, k + 1, 1 << 64)) for k in range(64)]


def shingle_rows(words: np.ndarray, width: int) -> np.ndarray:
    """The shingle that starts at each word; none when there are fewer words."""
    n = max(0, len(words) - width + 1)
    joined = np.full(n, _U(width), _U)
    for k in range(width if n else 0):
        joined += words[k : k + n] * _STEP[k]
    return mix(joined)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct ``width``-word shingles of one text, sorted.

    A text with fewer words has its whole sequence as its only shingle; a text
    without words has none.
    """
    return np.unique(shingle_rows(words, min(width, len(words)))) if len(words) else words
