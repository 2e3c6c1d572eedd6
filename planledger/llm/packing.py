"""Packing: shortest-pack-first over the histogram of lengths.

A document's token ids are cut into pieces of the sequence length and a rest.
The histogram of piece lengths has at most ``size`` entries at any corpus size;
it alone goes to the driver. There lengths are placed longest first, each into
the packs that are shortest so far. Packs with equal content are one pattern
with a count, held as a range of sequence numbers, so a step places many pieces
at once. The steps then are joined back to the pieces by length and rank.

Ranks are counted without a task that sees all pieces of one length: pieces are
dealt into buckets by hash, ranked within (length, bucket), and shifted by the
counts of the buckets before.

Null texts count as empty, and an empty document still has its end id. Rows that
repeat are packed each. Extra columns are kept beside every piece; columns named
as the operator's own are replaced.
"""

from __future__ import annotations

import heapq
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from planledger.llm.spancache import SpanCache
from planledger.llm.storage import saved
from planledger.llm.textbytes import LOWER, text_blocks, word_spans

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
_encoders: dict[str, SpanCache] = {}


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_encoder(path: str) -> SpanCache:
    """A cached encoder for a tokenizer of lower-cased words that drops white space and
    splits letters from punctuation. One per worker process and file."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        merge, letters = tokenizer.model.tokenize, byte_letters()

        def encode(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            found: list[list[int]] = [[]] * len(spans)
            rest = []
            for k, span in enumerate(spans):
                # Lower-case Latin letters are one word of the vocabulary's merges; all
                # else takes the tokenizer's whole way.
                if span.isalpha() and span.islower():
                    found[k] = [t.id for t in merge(span.decode())]
                elif (word := span.decode()).isalpha() and word.islower() and max(word) < "\u0180" and word == unicodedata.normalize("NFC", word):
                    found[k] = [t.id for t in merge(span.decode("latin-1").translate(letters))]
                else:
                    rest.append(k)
            words = [spans[k].decode() for k in rest]
            for k, x in zip(rest, tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
                found[k] = x.ids
            sizes = np.fromiter(map(len, found), np.int32, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

        _encoders[path] = SpanCache(encode, bits=20)
    return _encoders[path]


_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = True


def encodable_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of spans that can be encoded one by one.

    Spans end at white space, and where a Latin letter meets an ASCII mark other than
    an apostrophe; letters are lower-cased. A block in which a special token may stand
    is cut at white space only.
    """
    starts, ends = word_spans(buf, offsets)
    if b"<|" in buf.tobytes():
        return buf, starts, ends
    buf = LOWER[buf]
    # The two-byte letters U+00C0 to U+00FF: all but the signs for times and division.
    second = np.append(False, buf[:-1] == 0xC3) & (buf != 0x97) & (buf != 0xB7)
    buf[second & (buf >= 0x80) & (buf <= 0x9E)] += 0x20
    ends_letter = _LETTER[buf] | second
    begins_letter = _LETTER[buf] | np.append(second[1:], False)
    mark = _MARK[buf]
    cut = np.flatnonzero((ends_letter[:-1] & mark[1:]) | (mark[:-1] & begins_letter[1:])) + 1
    cut = cut[~np.isin(cut, offsets)]
    return buf, np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))


def document_ids(texts: pa.Array, path: str, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (ids of some documents one after another, end of each document)."""
    cache = word_encoder(path)
    for _, _, buf, offsets in text_blocks(texts):
        buf, starts, ends = encodable_spans(buf, offsets)
        ids, counts = cache.ids(buf, starts, ends)
        upto = np.append(0, np.cumsum(counts))[np.searchsorted(starts, offsets)]
        stop = upto[1:] + np.arange(1, len(upto))  # each document has its end id behind it
        out = np.full(int(stop[-1]), end_id, np.uint32)
        own = np.ones(len(out), bool)
        own[stop - 1] = False
        out[own] = ids
        yield out, stop


def tokenize_pieces(
    docs: DataFrame,
    path: str,
    size: int = 4096,
    end_id: int = 2,
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: the columns of ``docs`` but ``text``, then start, length, ids_crc32,
    doc_tokens, row_number (of the piece's document in its task) and, with ``keep_ids``, ids."""
    own = docs.drop("start", "length", "ids_crc32", "doc_tokens", "ids")
    rest = [name for name in own.columns if name != text]
    kinds = own.select(*rest).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds] + [PIECE] + ["ids array<int>"] * keep_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            row = 0
            for ids, stop in document_ids(table[text], path, end_id):
                totals = np.diff(np.append(0, stop))
                pieces = -(-totals // size)
                which = np.repeat(np.arange(len(stop)), pieces)
                start = (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
                length = np.minimum(size, totals[which] - start)
                begin = (stop - totals)[which] + start
                view = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                out = table.select(rest).take(pa.array(which + row)) if rest else None
                columns = [*(out.columns if out else [])] + [pa.array(x, pa.int64()) for x in (start, length, crcs, totals[which])]
                if keep_ids:
                    # Pieces lie one after another, as the ids do.
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                names = [*rest, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
                yield from pa.table(columns, names=names).combine_chunks().to_batches()
                row += len(stop)

    return own.select(*rest, text).mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Place lengths, longest first, into the packs that are shortest so far.

    Returns steps (length, first rank, end rank, first sequence, offset): the pieces
    of that length with these ranks go, one each, into the sequences from the first
    one on, all at the same offset. A pattern is a range of sequences with equal content.
    """
    steps: list[tuple[int, int, int, int, int]] = []
    packs: list[tuple[int, int, int]] = []  # (filled, first sequence, count)
    made = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= size:
                filled, first, count = heapq.heappop(packs)
            else:
                filled, first, count = 0, made, left
                made += left
            used = min(count, left)
            if used < count:
                heapq.heappush(packs, (filled, first + used, count - used))
            if filled + length < size:
                heapq.heappush(packs, (filled + length, first, used))
            steps.append((length, rank, rank + used, first, filled))
            rank, left = rank + used, left - used
    return steps


def place_pieces(pieces: DataFrame, keys: list[str], size: int = 4096) -> DataFrame:
    """Add sequence_id and offset to ``pieces``, which have ``length`` and were saved before.

    ``keys`` tell pieces apart; pieces that agree in all of them are exchangeable.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()  # at most ``size`` rows
    total = sum(row["count"] for row in counts)
    steps = shortest_pack_first({row["length"]: row["count"] for row in counts}, size)
    buckets = max(16, total // 200_000)
    dealt = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    # The counts are per length and bucket: far fewer rows than pieces at scale.
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
        .select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    )
    within = Window.partitionBy("length", "__bucket").orderBy(*keys)
    ranked = (
        dealt.withColumn("__row", F.row_number().over(within) - 1)
        .join(shifts, ["length", "__bucket"])
        .withColumn("__rank", F.col("__shift") + F.col("__row"))
    )
    plan = spark.createDataFrame(steps, "__length long, __low long, __high long, __first long, __offset long")
    # Bounded by the histogram, not by the pieces: see shortest_pack_first.
    at = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high"))
    return (
        ranked.join(F.broadcast(plan), at)
        .withColumn("sequence_id", F.col("__first") + F.col("__rank") - F.col("__low"))
        .withColumn("offset", F.col("__offset"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    end_id: int = 2,
    keep_ids: bool = True,
) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` ids: one row per piece."""
    own = docs.drop("sequence_id", "offset")
    pieces = saved(tokenize_pieces(own, path, size, end_id, text, keep_ids), "pieces")
    return place_pieces(pieces, [key, "start", "ids_crc32"], size)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and where each piece begins.

    A sequence has ``size`` ids at most, so its pieces are few enough to gather.
    """
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts")).select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.offset").alias("starts"),
    )
