"""Token ids of spans of text, looked up by the span's hash and compared by its bytes.

A direct-mapped table in numpy: one slot per hash prefix, a newer span takes the
slot of an older one. It only saves work: what is not in it is encoded, and its
size is fixed. Spans whose hashes agree but not their bytes are encoded each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from planledger.llm.textbytes import eight_bytes, same_spans, span_hashes, word_view

#: Spans looked up together, so that a very long text takes no more memory than others.
SPANS = 1 << 17
#: Longer spans, in bytes, are encoded whenever they come.
KEPT = 256

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class SpanCache:
    """``encode`` gives, for a list of spans, their ids one after another and how many each has."""

    def __init__(self, encode: Encode, bits: int = 19, room: int = 1 << 22) -> None:
        self.encode, self.bits, self.room = encode, bits, room
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.start = np.zeros(1 << self.bits, np.int64)
        self.count = np.zeros(1 << self.bits, np.int32)
        self.byte = np.zeros(1 << self.bits, np.int64)
        self.size = np.zeros(1 << self.bits, np.int32)
        self.flat = np.zeros(self.room, np.int32)
        self.bytes = np.zeros(2 * self.room + 8, np.uint8)
        self.used = self.used_bytes = 0

    def _known(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which spans their slot holds."""
        known = self.keys[slot] == hashes
        hit = np.flatnonzero(known)
        byte = self.byte[slot[hit]]
        known[hit] = same_spans(words, starts[hit], ends[hit], word_view(self.bytes), byte, byte + self.size[slot[hit]])
        return known

    def ids(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans one after another, and how many each of the sorted spans has."""
        if len(starts) > SPANS:
            parts = []
            for low in range(0, len(starts), SPANS):
                a, b = starts[low : low + SPANS], ends[low : low + SPANS]
                parts.append(self.ids(buf[a[0] : b[-1]], a - a[0], b - a[0]))
            ids, counts = zip(*parts, strict=True)
            return np.concatenate(ids), np.concatenate(counts)
        words = eight_bytes(buf)
        hashes = span_hashes(buf, starts, ends, words) | np.uint64(1)
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        start, count = self.start[slot], self.count[slot]
        miss = np.flatnonzero(~self._known(words, starts, ends, hashes, slot))
        if len(miss):
            _, at, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            own = miss[at]
            odd = np.flatnonzero(~same_spans(words, starts[miss], ends[miss], words, starts[own[back]], ends[own[back]]))
            back[odd] = len(own) + np.arange(len(odd))
            own = np.append(own, miss[odd])
            data = buf.tobytes()
            spans = [data[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
            new, sizes = self.encode(spans)
            if self.used + len(new) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], new, np.zeros(self.room, np.int32)])
            self.flat[self.used : self.used + len(new)] = new
            first = self.used + np.cumsum(sizes) - sizes
            self.used += len(new)
            start[miss], count[miss] = first[back], sizes[back]
            short = np.flatnonzero(ends[own] - starts[own] <= KEPT)
            _, last = np.unique(slot[own[short]][::-1], return_index=True)  # one span for each slot
            self._put(short[len(short) - 1 - last], own, slot, hashes, spans, first, sizes)
        total = int(count.sum())
        behind = np.cumsum(count) - count
        ids = self.flat[np.repeat(start - behind, count) + np.arange(total)]
        if self.used > self.room or self.used_bytes > self.room:
            self._clear()
        return ids, count

    def _put(
        self, last: np.ndarray, own: np.ndarray, slot: np.ndarray, hashes: np.ndarray,
        spans: list[bytes], first: np.ndarray, sizes: np.ndarray,
    ) -> None:
        """Give the new spans numbered ``last`` their slots."""
        kept = [spans[k] for k in last.tolist()]
        raw = np.frombuffer(b"".join(kept), np.uint8)
        if self.used_bytes + len(raw) + 8 > len(self.bytes):
            self.bytes = np.concatenate([self.bytes[: self.used_bytes], raw, np.zeros(self.room + 8, np.uint8)])
        self.bytes[self.used_bytes : self.used_bytes + len(raw)] = raw
        size = np.fromiter(map(len, kept), np.int32, len(kept))
        put = slot[own[last]]
        self.keys[put], self.start[put], self.count[put] = hashes[own[last]], first[last], sizes[last]
        self.byte[put], self.size[put] = self.used_bytes + np.cumsum(size) - size, size
        self.used_bytes += len(raw)
