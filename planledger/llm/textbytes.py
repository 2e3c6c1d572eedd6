"""Texts as UTF-8 bytes in numpy: splitting and hashing spans without a Python loop per word.

A span is read as little-endian words of eight bytes, the last one padded with zeros.
Each word is mixed with its place, and the sum of these is mixed with the span's length:
no algebra carries from the bytes to the hash, so spans built from repeated or mirrored
parts don't collide. Words are worked on ``WORDS`` at a time, texts in blocks of ``BLOCK``
bytes, so memory stays bounded for a span and a text of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
#: Words of eight bytes looked at together.
WORDS = 1 << 17
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: What of a word belongs to a span that has k bytes left, for k up to 8.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def eight_bytes(buf: np.ndarray) -> np.ndarray:
    """The little-endian word that begins at each place of ``buf`` and at its end."""
    return word_view(np.append(buf, np.zeros(8, np.uint8)))


def word_view(padded: np.ndarray) -> np.ndarray:
    """The same for bytes that have eight more behind them, over the bytes themselves."""
    return np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))


def span_words(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the words of spans: (first span, end span, where each one's words begin in
    the slice, place of each word in its span, the span of each word less the first)."""
    counts = (ends - starts + 7) >> 3
    upto = np.cumsum(counts)
    total = int(upto[-1]) if len(upto) else 0
    for low in range(0, total, WORDS):
        high = min(low + WORDS, total)
        a, b = int(np.searchsorted(upto, low, "right")), int(np.searchsorted(upto, high, "left")) + 1
        if low == 0 and high == total:
            own, begin, skip = counts, upto - counts, None
        else:
            begin = np.maximum(upto[a:b] - counts[a:b], low) - low
            own = np.minimum(upto[a:b], high) - low - begin
            skip = np.maximum(low - (upto[a:b] - counts[a:b]), 0)
        a, b = (0, len(counts)) if skip is None else (a, b)
        span = np.repeat(np.arange(b - a), own)
        place = np.arange(high - low) - begin[span] + (0 if skip is None else skip[span])
        yield a, b, begin, place, span


def read_words(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The words at ``place`` of the spans numbered ``span``; zeros behind a span's end."""
    at = starts[span] + 8 * place
    return words[at] & _KEEP[np.minimum(ends[span] - at, 8)]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of ``buf[start:end]`` for each of the spans; ``words`` saves reading ``buf`` anew."""
    words, sums = eight_bytes(buf) if words is None else words, np.zeros(len(starts), np.uint64)
    for a, b, begin, place, span in span_words(starts, ends):
        own = read_words(words, starts[a:b], ends[a:b], place, span)
        own = mix(own ^ mix(place.astype(np.uint64) * np.uint64(2) + _SEED))
        some = np.flatnonzero(np.diff(np.append(begin, len(own))) > 0)
        sums[a + some] += np.add.reduceat(own, begin[some])
    return mix(sums + (ends - starts).astype(np.uint64) * _SEED)


def same_spans(
    left: np.ndarray, starts: np.ndarray, ends: np.ndarray, right: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray
) -> np.ndarray:
    """Whether the k-th span on the left has the bytes of the k-th one on the right; both
    texts are given by ``eight_bytes``."""
    same = ends - starts == other_ends - other_starts
    rows = np.flatnonzero(same)
    starts, ends, other_starts, other_ends = starts[rows], ends[rows], other_starts[rows], other_ends[rows]
    for a, b, _, place, span in span_words(starts, ends):
        here = read_words(left, starts[a:b], ends[a:b], place, span)
        there = read_words(right, other_starts[a:b], other_ends[a:b], place, span)
        same[rows[a + span[here != there]]] = False
    return same


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after another in ``buf``.

    ``offsets`` has where each text starts, and the end of the last one.
    """
    inside = np.ones(len(buf) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(SPACE[buf], out=inside[1:-1])
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends


def text_blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of texts into runs of whole texts of about ``size`` bytes.

    Yields (first row, end row, bytes, offsets); nulls count as empty.
    """
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        own = offsets[first : end + 1]
        yield first, end, data[own[0] : own[-1]], own - own[0]
        first = end
