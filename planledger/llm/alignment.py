"""Cross-tokenizer alignment, with corpus counts indexed by a minimal perfect hash.

A text is encoded by a byte-level vocabulary (A, over a space and the text) and by a
SentencePiece one (B, which puts that space there itself). Where tokens of both end at
the same byte, the text is cut into groups; the two tokens that end there are linked.
The first pass counts per task how often each pair of ids is linked. The distinct
pairs get a minimal perfect hash, each task's counts become a dense vector indexed by
it, and these are summed as a tree. The second pass aligns every document again and
looks its links up, compared with the pairs themselves, when a span of text is first met.

Of two linked tokens one is a suffix of the other, as both end at the same byte. So
there are at most as many pairs as the tokens of both vocabularies have suffixes, at
any corpus size; that bounds the hash, the vectors and what is broadcast.

No token of A crosses from a byte into a space that has a visible character behind it,
and where B's pieces have no marker behind another character, none of B does either. Text
between such places is encoded and aligned once and looked up after that; other
vocabularies take each text as one span. Long texts are worked on in slices of spans.

Texts that are null, empty, or not the same as the bytes that either encoding spells
have no tokens: zeros, and an empty ``groups``. Repeated rows count each. Extra columns
are kept, all but the text; columns named as the operator's own are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from copy import copy
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from planledger.llm.packing import byte_letters
from planledger.llm.perfect_hash import PerfectHash, counted_index
from planledger.llm.spancache import SpanCache
from planledger.llm.storage import saved
from planledger.llm.textbytes import text_blocks

#: Spans whose alignments are held at a time.
SLICE = 1 << 15
#: Numbers at the head of a span's record.
_HEAD = 7
#: Spans that are encoded together.
_JOINED = 128
#: Distinct pairs a task holds before it merges them.
_MERGE = 1 << 21
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
#: Whether a character that begins with this byte is visible: ASCII marks, letters and digits, and
#: the characters of lead bytes under which Unicode has no white space.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE1] = _VISIBLE[0xE4:0xF5] = True
#: Longer spans, in bytes, are encoded one by one by the library that takes any length in proportion.
_LONG = 256
#: Fixed value: how byte-level vocabularies split text before merging.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_aligners: dict[tuple[str, str], Aligner] = {}


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The tokens' bytes with their ids, where the file is a plain byte-level one whose ids
    stand in the order of its merges; such ids are also the ranks of the merges."""
    file = json.loads(Path(path).read_text())
    split = file.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if file.get("normalizer") or not plain or file["model"].get("type", "BPE") != "BPE":
        return None
    vocab, letters = file["model"]["vocab"], {letter: byte for byte, letter in byte_letters().items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
    made = [vocab.get("".join(m), -1) for m in merges]
    single = [vocab.get(letter, -1) for letter in letters]
    if min(single) < 0 or any(x >= y for x, y in zip([max(single), *made], made, strict=False)):
        return None
    known = [*letters, *("".join(m) for m in merges)]
    return {bytes(letters[c] for c in token): vocab[token] for token in known}


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for ``count`` places each."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Strings:
    """Short byte strings by number, in one buffer."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.begin = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> bytes:
        return self.data[spread(self.begin[numbers], self.sizes[numbers])].tobytes()


class Aligner:
    """Both vocabularies, and the alignments of spans seen so far. One per worker process and pair of files.

    A span's record is the numbers of its A ids, B ids, links and bytes of text, how many links
    are best, and the sum of their counts (in two halves). While pairs are counted, the A ids
    and the B ids of its links follow. With the counts known (``looking_up``), its groups follow
    as text, ``;`` in front of each.
    """

    known: tuple[PerfectHash, np.ndarray, np.ndarray] | None = None

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        ranks = merge_ranks(path_a)
        self.merge = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        letters = {letter: byte for byte, letter in byte_letters().items()}
        bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.bytes_a, self.bytes_b = Strings(bytes_a), Strings(bytes_b)
        most = max(len(bytes_a), len(bytes_b))
        self.numbers = Strings([b",%d" % i for i in range(most)])
        self.cache = SpanCache(self._records, bits=19, room=1 << 23)

    def looking_up(self, index: PerfectHash, counts: np.ndarray, best: np.ndarray) -> Aligner:
        """The same with each pair's count, and whether it is its B id's highest one."""
        other = copy(self)
        other.known = index, counts, best
        other.cache = SpanCache(other._records, bits=19, room=1 << 23)
        return other

    def _ids_a(self, spans: list[bytes], texts: list[str]) -> np.ndarray:
        """The ids of all spans one after another. Those in front of which any text may be cut
        are encoded many at a time."""
        long = [k for k, x in enumerate(spans) if len(x) > _LONG]
        bare = [k for k, x in enumerate(spans) if not self.cuts or len(x) < 2 or not _VISIBLE[x[1]]]
        stops = sorted({0, len(spans), *long, *(k + 1 for k in long), *bare})
        found = []
        for a, b in pairwise(stops):
            for low in range(a, b, _JOINED):
                found.append(self._encode_a("".join(texts[low : min(low + _JOINED, b)]), len(spans[a]) > _LONG))
        return np.fromiter(chain.from_iterable(found), np.int32)

    def _encode_a(self, text: str, long: bool) -> list[int]:
        if self.merge and not long:
            return self.merge.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _records(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [s.decode("utf-8", "replace") for s in spans]
        a = self._ids_a(spans, texts)
        lists_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        b = np.fromiter(chain.from_iterable(lists_b), np.int32)
        raw, sizes = b"".join(spans), np.fromiter(map(len, spans), np.int64, len(spans))
        stops = np.cumsum(sizes)
        ends_a = np.cumsum(self.bytes_a.sizes[a])
        ends_b = np.cumsum(self.bytes_b.sizes[b])
        # The usual case: both spell all the spans. Else it is found out which don't.
        if not (self.bytes_a.joined(a) == raw == self.bytes_b.joined(b) and np.isin(stops, ends_a).all() and np.isin(stops, ends_b).all()):
            if len(spans) == 1:
                return np.array([-1] + [0] * (_HEAD - 1), np.int32), np.array([_HEAD], np.int32)
            half = len(spans) // 2
            parts = [self._records(spans[:half]), self._records(spans[half:])]
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        common = np.zeros(len(raw) + 1, np.int8)
        common[ends_a] += 1
        common[ends_b] += 1
        last_a, last_b = common[ends_a] == 2, common[ends_b] == 2
        first_a, first_b = np.append(True, last_a[:-1]), np.append(True, last_b[:-1])
        group_a, group_b = np.cumsum(first_a) - 1, np.cumsum(first_b) - 1
        # Where each span's tokens and links end.
        upto = [np.searchsorted(x, stops, "right") for x in (ends_a, ends_b, ends_a[last_a])]
        n_a, n_b, n_links = (np.diff(x, prepend=0) for x in upto)
        n_text, n_best, sums = (np.zeros(len(spans), np.int64) for _ in range(3))
        if self.known:
            text, behind = self._spelled(a, b, first_a, first_b, group_a, group_b)
            n_text = np.diff(np.append(0, behind)[upto[0] + upto[1]], prepend=0)
            index, counts, best = self.known
            at = index.find(pair_keys(a[last_a], b[last_b]))
            if (at < 0).any():
                raise ValueError("a link was not counted")
            n_best, sums = (np.diff(np.append(0, np.cumsum(x[at]))[upto[2]], prepend=0) for x in (best.astype(np.int64), counts))
        out_sizes = _HEAD + (0 if self.known else 2 * n_links) + (n_text + 3 >> 2)
        begin = np.cumsum(out_sizes) - out_sizes
        out = np.zeros(int(out_sizes.sum()), np.int32)
        halves = sums.astype("<i8").view(np.int32).reshape(-1, 2)
        out[begin[:, None] + np.arange(_HEAD)] = np.column_stack([n_a, n_b, n_links, n_text, n_best, halves])
        if self.known:
            out.view(np.uint8)[spread(4 * (begin + _HEAD), n_text)] = text
        else:
            place = spread(begin + _HEAD, n_links)
            out[place], out[place + np.repeat(n_links, n_links)] = a[last_a], b[last_b]
        return out, out_sizes.astype(np.int32)

    def _spelled(self, a, b, first_a, first_b, group_a, group_b) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
        """Each group's A ids, then its B ids, as text, and where each number of it ends."""
        upto_a, upto_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        place_a = np.arange(len(a)) + np.append(0, upto_b)[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        order, separators = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
        order[place_a], order[place_b] = a, b
        separators[place_a], separators[place_b] = np.where(first_a, 0x3B, 0x2C), np.where(first_b, 0x7C, 0x2C)
        width = self.numbers.sizes[order]
        text = np.frombuffer(self.numbers.joined(order), np.uint8).copy()
        behind = np.cumsum(width)
        text[behind - width] = separators
        return text, behind

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Iterator[Slice]]]:
        """(first row, end row, which rows have tokens, slices of these rows' alignments)."""
        for first, end, buf, offsets in text_blocks(texts):
            data = [b" " + buf[a:b].tobytes() if b > a else b"" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            bounds = np.cumsum([0, *map(len, data)])
            own = np.frombuffer(b"".join(data), np.uint8)
            cut = np.zeros(len(own), bool)
            cut[bounds[:-1][np.diff(bounds) > 0]] = True
            if self.cuts:
                cut[1:-1] |= (own[1:-1] == 0x20) & (own[:-2] != 0x20) & _VISIBLE[own[2:]]
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(own)) if len(starts) else starts
            doc = np.searchsorted(bounds, starts, "right") - 1
            valid = np.diff(bounds) > 0
            lows = range(0, len(starts), SLICE)

            def look(low: int) -> Slice:
                s = slice(low, low + SLICE)
                return Slice(doc[s], *self.cache.ids(own[starts[s][0] : ends[s][-1]], starts[s] - starts[low], ends[s] - starts[low]))

            # Of a text in several slices all are looked through before any counts.
            held = None
            for low in lows:
                held = look(low)
                valid[held.doc[held.head[:, 0] < 0]] = False
            slices = (held.of(valid) for held in ([held] if len(lows) == 1 else map(look, lows)))
            yield first, end, valid, slices


class Slice:
    """The records of some spans, and the row each span is of."""

    def __init__(self, doc: np.ndarray, records: np.ndarray, sizes: np.ndarray) -> None:
        self.doc, self.records = doc, records
        self.at = np.cumsum(sizes, dtype=np.int64) - sizes
        self.head = records[self.at[:, None] + np.arange(_HEAD)]

    def of(self, valid: np.ndarray) -> Slice:
        """Only the spans of these rows."""
        if not (keep := valid[self.doc]).all():
            self.doc, self.at, self.head = self.doc[keep], self.at[keep], self.head[keep]
        return self

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The A ids and the B ids of the links."""
        count = self.head[:, 2].astype(np.int64)
        place = spread(self.at + _HEAD, count)
        return self.records[place], self.records[place + np.repeat(count, count)]

    def sums(self, rows: int) -> np.ndarray:
        """n_a, n_b, n_groups, n_best and count_sum of each row, as far as its spans are here."""
        out = np.zeros((rows, 5), np.int64)
        if len(self.doc):
            each = np.column_stack([self.head[:, [0, 1, 2, 4]].astype(np.int64), np.ascontiguousarray(self.head[:, 5:]).view("<i8")])
            first = np.flatnonzero(np.diff(self.doc, prepend=-1))
            out[self.doc[first]] = np.add.reduceat(each, first, axis=0)
        return out

    def spelled(self) -> Iterator[tuple[int, memoryview]]:
        """(row, its groups as text) for each row with spans here."""
        size = self.head[:, 3].astype(np.int64)
        upto = np.append(0, np.cumsum(size))
        whole = memoryview(self.records.view(np.uint8)[spread(4 * (self.at + _HEAD), size)])
        first = np.flatnonzero(np.diff(self.doc, prepend=-1))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(self.doc)], strict=True):
            yield int(self.doc[a]), whole[upto[a] : upto[b]]


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, back, np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)]))
    return keys, counts


def link_counts(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """(key, n): how often each pair of ids is linked in the texts of a task, a row for each pair and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, parts, held = aligner(path_a, path_b), [], 0
        for batch in batches:
            for _, _, _, slices in both.blocks(batch.column(0)):
                for own in slices:
                    parts.append(np.unique(pair_keys(*own.links()), return_counts=True))
                    held += len(parts[-1][0])
                    if held > _MERGE:
                        parts = [_summed(parts)]
                        held = 0
        keys, counts = _summed(parts)
        for low in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[low : low + (1 << 16)]) for x in (keys, counts)], names=["key", "n"])

    return docs.select(text).mapInArrow(count, "key long, n long")


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep_groups: bool = True
) -> DataFrame:
    """Per row the numbers of tokens, groups and links, how many links are their B id's most
    frequent one (n_best), the sum of the links' counts, the groups' sha256 and, with
    ``keep_groups``, the groups: ``a1,a2|b1;a3|b2,b3``."""
    index, counts = counted_index(saved(link_counts(docs, path_a, path_b, text), "links"))
    best = np.zeros(int((index.keys & 0xFFFFFFFF).max(initial=-1)) + 1, np.int64)
    np.maximum.at(best, index.keys & 0xFFFFFFFF, counts)
    # As many entries as pairs: bounded by the suffixes of the vocabularies' tokens.
    shared = docs.sparkSession.sparkContext.broadcast((index, counts, counts == best[index.keys & 0xFFFFFFFF]))
    rest = [f for f in docs.schema if f.name != text and f.name not in RESULT]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b).looking_up(*shared.value)
        for batch in batches:
            for first, end, valid, slices in both.blocks(batch.column(len(rest))):
                yield _aligned(batch.slice(first, end - first), len(rest), valid, slices, keep_groups)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    kinds += [f"{name} {'string' if 'groups_' in name or name == 'groups' else 'long'}" for name in RESULT[: len(RESULT) - (not keep_groups)]]
    return docs.select(*[f"`{f.name}`" for f in rest], text).mapInArrow(align, ", ".join(kinds))


def _aligned(rows: pa.RecordBatch, width: int, valid: np.ndarray, slices: Iterator[Slice], keep_groups: bool) -> pa.RecordBatch:
    """The result for the rows of a block."""
    n = len(valid)
    sums = np.zeros((n, 5), np.int64)
    digests: dict[int, hashlib._Hash] = {}
    groups: list[list[bytes]] = [[] for _ in range(n)]
    for own in slices:
        sums += own.sums(n)
        for k, spelled in own.spelled():
            if k not in digests:
                digests[k], spelled = hashlib.sha256(), spelled[1:]
            digests[k].update(spelled)
            if keep_groups:
                groups[k].append(bytes(spelled))
    hexes = [digests[k].hexdigest() if k in digests else "" for k in range(n)]
    columns = [*rows.columns[:width], *(pa.array(sums[:, k]) for k in (0, 1, 2, 2, 3, 4)), pa.array(hexes, pa.string())]
    names = [*rows.schema.names[:width], *RESULT[:7]]
    if keep_groups:
        columns.append(pa.array([b"".join(g).decode() for g in groups], pa.string()))
        names.append("groups")
    return pa.RecordBatch.from_arrays(columns, names=names)
