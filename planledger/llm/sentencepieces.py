"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

``load_pieces`` reads a model file's pieces and scores and lays the pieces' bytes
out as a double array (``base``/``check``), of a size fixed by the vocabulary.
Encoding marks spaces by U+2581, walks the trie from every position of many spans
at once, and keeps for each position the best-scored way to reach it. Characters
that no piece covers score below every piece and are written as byte pieces.
Best paths never cross from one byte into the next where no piece of the
vocabulary does, so the text between such places is encoded once and looked up
after that.

Of equally good ways the one whose last piece is longest wins. Null and empty
texts have no ids. Decoding joins the pieces, turns markers into spaces, drops
the one that encoding put in front, and turns byte pieces back into UTF-8; bytes
that are no UTF-8 become U+FFFD. Null ids decode to null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from planledger.llm.spancache import SpanCache
from planledger.llm.textbytes import text_blocks

MARKER = "▁"
_MARK = MARKER.encode()
#: What a character outside the vocabulary scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: How many places for a node's children are tried at once.
_WINDOW = 4096


@dataclass(eq=False)
class Pieces:
    """A vocabulary as a double-array trie, with scores and the pieces' bytes by id."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # the id of the piece that ends in this node, or -1
    score: np.ndarray
    bytes_of: list[bytes]  # by id; markers are spaces here, special pieces are empty
    byte_ids: np.ndarray  # the piece of each byte value
    unknown: float
    splits: bool  # whether text may be cut in front of a marker
    crossed: np.ndarray  # [a, b]: whether a piece has byte b, which begins a character, behind byte a
    longest: int  # bytes, with room for any character
    _cache: SpanCache | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_cache": None}

    @property
    def cache(self) -> SpanCache:
        if self._cache is None:
            self._cache = SpanCache(self.encode_spans, bits=20)
        return self._cache

    def encode_spans(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The best ids of each span, one span after another, and how many each has."""
        sizes = np.fromiter(map(len, spans), np.int64, len(spans))
        buf = np.frombuffer(b"".join(spans), np.uint8)
        begin = np.cumsum(sizes) - sizes
        span_end = np.repeat(begin + sizes, sizes)
        heads = np.flatnonzero((buf & 0xC0) != 0x80)
        width = np.diff(np.append(heads, len(buf)))  # bytes of each character
        edges = [self._walk(buf, heads, span_end), self._unknown(heads, width)]
        starts, ends, scores, ids = (np.concatenate(x) for x in zip(*edges, strict=True))
        single = np.zeros(len(buf) + 1, bool)
        whole = ends[: -len(heads) or None] == np.append(heads, len(buf))[np.searchsorted(heads, starts[: -len(heads) or None]) + 1]
        single[starts[: -len(heads) or None][whole]] = True
        keep = np.ones(len(starts), bool)
        keep[len(starts) - len(heads) :] = ~single[heads]  # unknown only where no piece is the character
        starts, ends, scores, ids = (x[keep] for x in (starts, ends, scores, ids))
        back, came = self._best(buf, begin, sizes, starts, ends, scores, ids)
        return self._paths(buf, begin, sizes, back, came)

    def _walk(self, buf: np.ndarray, heads: np.ndarray, span_end: np.ndarray) -> tuple[np.ndarray, ...]:
        found = []
        at, node, depth = heads, np.zeros(len(heads), np.int32), 0
        while len(at):
            inside = at + depth < span_end[at]
            at, node = at[inside], node[inside]
            to = self.base[node] + buf[at + depth]
            ok = self.check[to] == node
            at, node, depth = at[ok], to[ok], depth + 1
            value = self.value[node]
            hit = value >= 0
            found.append((at[hit], at[hit] + depth, self.score[value[hit]], value[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _unknown(self, heads: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
        return heads, heads + width, np.full(len(heads), self.unknown), np.full(len(heads), -1, np.int32)

    def _best(self, buf, begin, sizes, starts, ends, scores, ids) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
        """For each position: where the best way's last piece began, and its id."""
        # Position p of span k is p + k, so that each span has a place for its end too.
        shift = np.repeat(np.arange(len(sizes)), sizes)
        span = shift[starts]
        best = np.full(len(buf) + len(sizes), -np.inf)
        best[begin + np.arange(len(sizes))] = 0.0
        back = np.zeros(len(best), np.int64)
        came = np.zeros(len(best), np.int32)
        depth = ends - begin[span]
        # By depth, then end, then start: one sortable number, as pieces are short.
        order = np.argsort((depth * (len(buf) + 1) + ends) * self.longest + self.longest - (ends - starts))
        starts, ends, scores, ids = starts[order] + span[order], ends[order] + span[order], scores[order], ids[order]
        groups = np.flatnonzero(np.diff(np.append(-1, depth[order])))
        for a, b in zip(groups, np.append(groups[1:], len(starts)), strict=True):
            way = best[starts[a:b]] + scores[a:b]
            end = ends[a:b]
            first = np.flatnonzero(np.diff(np.append(-1, end)))
            top = np.maximum.reduceat(way, first)
            # The first edge that reaches the top: the earliest start, so the longest piece.
            is_top = np.flatnonzero(way == np.repeat(top, np.diff(np.append(first, b - a))))
            pick = is_top[np.flatnonzero(np.diff(np.append(-1, end[is_top])))]
            best[end[pick]], back[end[pick]], came[end[pick]] = way[pick], starts[a:b][pick], ids[a:b][pick]
        return back, came

    def _paths(self, buf, begin, sizes, back, came) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
        """Walk all spans back from their ends together; then write the pieces forwards."""
        spans = np.flatnonzero(sizes > 0)
        first = begin + np.arange(len(sizes))
        at = (first + sizes)[spans]
        seen = []
        while len(spans):
            from_ = back[at]
            seen.append((spans, from_, at, came[at]))
            going = from_ > first[spans]
            spans, at = spans[going], from_[going]
        if not seen:
            return np.zeros(0, np.int32), sizes.astype(np.int32)
        span, from_, to, ids = (np.concatenate(x) for x in zip(*seen, strict=True))
        order = np.argsort(from_, kind="stable")
        span, from_, to, ids = span[order], from_[order], to[order], ids[order]
        count = np.where(ids < 0, to - from_, 1)
        out = np.repeat(ids, count)
        raw = np.flatnonzero(out < 0)
        if len(raw):
            within = np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)
            out[raw] = self.byte_ids[buf[(np.repeat(from_ - span, count) + within)[raw]]]
        return out, np.bincount(span, weights=count, minlength=len(sizes)).astype(np.int32)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (ids of some texts one after another, where each text's ids end)."""
        for _, _, buf, offsets in text_blocks(texts):
            data, bounds = [], [0]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if b > a:  # a marker goes in front of every text that isn't empty
                    data.append(_MARK + buf[a:b].tobytes().replace(b" ", _MARK))
                bounds.append(bounds[-1] + (len(data[-1]) if b > a else 0))
            own, stops = np.frombuffer(b"".join(data), np.uint8), np.array(bounds)
            mark = np.zeros(len(own) + 3, bool)
            mark[:-5] = (own[:-2] == _MARK[0]) & (own[1:-1] == _MARK[1]) & (own[2:] == _MARK[2]) if len(own) > 2 else False
            mark = mark[: len(own)]
            cut = np.zeros(len(own), bool)
            cut[stops[:-1][np.diff(stops) > 0]] = True
            if self.splits:  # a span is a run of markers and what follows up to the next marker
                cut[3:] |= mark[3:] & ~mark[:-3]
            # Nor does a best path cross where no piece does.
            cut[1:] |= ((own[1:] & 0xC0) != 0x80) & ~self.crossed[own[:-1], own[1:]]
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(own)) if len(starts) else starts
            ids, counts = self.cache.ids(own, starts, ends)
            upto = np.append(0, np.cumsum(counts))
            yield ids, upto[np.searchsorted(starts, stops[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one list of ids."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace").removeprefix(" ")


def _double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lay out a trie so that the child of node s by byte c is base[s] + c, where check is s."""
    children: dict[bytes, set[int]] = {b"": set()}
    for piece in pieces:
        for k in range(len(piece)):
            children.setdefault(piece[: k + 1], set())
            children[piece[:k]].add(piece[k])
    room = 2 * len(children) + 2 * _WINDOW
    base, check, value = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
    used = np.zeros(room, bool)
    used[0] = True
    place, free = {b"": 0}, 1
    for prefix in sorted(children, key=len):
        value[place[prefix]] = pieces.get(prefix, -1)
        if kids := sorted(children[prefix]):
            while used[free]:
                free += 1
            offset, own = max(free - kids[0], 1), np.array(kids)
            while True:
                if offset + _WINDOW + 256 > len(used):
                    more = len(used) + _WINDOW
                    base, used = np.append(base, np.zeros(more, np.int32)), np.append(used, np.zeros(more, bool))
                    check, value = (np.append(x, np.full(more, -1, np.int32)) for x in (check, value))
                taken = used[offset + kids[0] : offset + kids[0] + _WINDOW].copy()
                for c in kids[1:]:
                    taken |= used[offset + c : offset + c + _WINDOW]
                at = int(np.argmin(taken))
                if not taken[at]:
                    offset += at
                    break
                offset += _WINDOW
            base[place[prefix]] = offset
            used[offset + own] = True
            check[offset + own] = place[prefix]
            for c in kids:
                place[prefix + bytes([c])] = offset + c
    pad = 256  # a leaf's base is 0, and its lookups must stay inside
    return base, np.append(check, np.full(pad, -1, np.int32)), value


def build_pieces(pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int) -> Pieces:
    """``pieces``: text to (id, log score), without special and byte pieces."""
    base, check, value = _double_array({p.encode(): i for p, (i, _) in pieces.items() if p})
    score = np.zeros(size)
    bytes_of = [b""] * size
    for piece, (i, s) in pieces.items():
        score[i], bytes_of[i] = s, piece.replace(MARKER, " ").encode()
    for byte, i in enumerate(byte_ids):
        bytes_of[i] = bytes([byte])
    lowest = min((s for _, s in pieces.values()), default=0.0)
    splits = all(re.fullmatch(f"{MARKER}*[^{MARKER}]*", p) for p in pieces)
    crossed = np.zeros((256, 256), bool)
    for piece in pieces:
        for a, b in zip(piece[:-1], piece[1:], strict=True):
            crossed[a.encode()[-1], b.encode()[0]] = True
    longest = max([len(p.encode()) for p in pieces] + [4]) + 1
    return Pieces(base, check, value, score, bytes_of, np.array(byte_ids, np.int32), lowest - UNKNOWN_PENALTY, splits, crossed, longest)


def load_pieces(path: str) -> Pieces:
    """The vocabulary of a SentencePiece model file with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the model has no byte pieces")
    return build_pieces(pieces, byte_ids, size)


def encode_text(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column ``ids`` (array of int) to every row; a column of that name is replaced."""
    own = docs.drop(ids)
    shared = own.sparkSession.sparkContext.broadcast(pieces)  # of the vocabulary's size

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for flat, stops in shared.value.encode(batch.column(batch.schema.get_field_index(text))):
                own = batch.slice(first, len(stops))
                column = pa.ListArray.from_arrays(pa.array(np.append(0, stops).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*own.columns, column], names=[*batch.schema.names, ids])
                first += len(stops)

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema] + [f"`{ids}` array<int>"])
    return own.mapInArrow(encode, kinds)


def decode_ids(df: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the column ``text`` (string) to every row; a column of that name is replaced."""
    own = df.drop(text)
    shared = own.sparkSession.sparkContext.broadcast(pieces)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            flat = column.values.to_numpy(zero_copy_only=False)
            offsets, nulls = column.offsets.to_numpy(), column.is_null().to_pylist()
            spoken = [None if n else shared.value.decode(flat[a:b]) for a, b, n in zip(offsets[:-1], offsets[1:], nulls, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spoken, pa.string())], names=[*batch.schema.names, text])

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema] + [f"`{text}` string"])
    return own.mapInArrow(decode, kinds)
