"""MinHash near-dedup by min-max hashing.

Under each permutation of the hash space both the smallest and the largest
shingle hash are kept: two values of the signature for one hashing of the set, and
each pair of values agrees with the probability of the sets' similarity. Two
permutations (four values) make a band; documents that agree in a band are
candidates, and candidates are confirmed on their full shingle sets. With the
default 28 bands a pair at similarity 0.85 is missed with probability 1e-9, one
at 0.8 with 4e-7.

Documents with equal sets are one class. Each band bucket is first compared with its
smallest member only; the links found give components, and a bucket that lies in one
component is done. In the others, members of different components may still be similar.
Small ones are compared pair by pair. The documents of larger ones are banded anew, by
so many values that a band lets few pairs through that are not similar enough, and in so
many bands that one in a million pairs at the threshold is missed (at 0.85, 44 bands of
eight values). These buckets are again compared with their smallest member first. Where
several components are left, two similar documents either share a shingle that few have,
and are found by it, or have only common ones in common; how many of these each has
bounds their similarity, and pairs whose bound is high enough are compared. Pairs whose
signatures agree too rarely go before full sets are fetched.

So documents that share much without being similar, such as pages of one template, meet
rarely: two at similarity 0.33 with probability 0.006, at 0.5 with 0.16; and copies with
edits of their own are told apart by counting these. A family that is close below the
threshold by common shingles alone stays dear: at 0.75 most of its pairs are compared.

Null and empty texts and texts without words have the empty set and link with
nothing. Rows without key link with nothing and stay: their component is null.
Repeated rows share their component, and of rows that share a key but not the
text the links of one count for all. Columns of the input are not carried along, but
with ``text_hash`` each row's hash of its text is, which tells such rows apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from planledger.llm.components import connected_components
from planledger.llm.storage import saved
from planledger.llm.textbytes import LOWER, mix, span_hashes, text_blocks, word_spans
from planledger.operators.joins import split_join

BANDS = 28
#: Buckets up to this size are compared pair by pair, the documents of larger ones are banded anew.
SMALL_BUCKET = 4
#: A shingle that at most this many documents of open buckets have is rare.
RARE = 8
#: What part of the pairs at the threshold the steep bands may miss, and the signature check may drop.
MISSED, DROPPED = 1e-6, 1e-8
#: Steep bands at most, and permutations whose values make a signature.
MOST_BANDS, SIGNATURE = 128, 32

_rng = np.random.Generator(np.random.PCG64(715))
_PLACES = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_FACTORS = _rng.integers(0, 1 << 32, 2 * BANDS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, 2 * BANDS, dtype=np.uint32)
_STEEP_FACTORS = _rng.integers(0, 1 << 32, 4 * MOST_BANDS + SIGNATURE, dtype=np.uint32) | np.uint32(1)
_STEEP_SHIFTS = _rng.integers(0, 1 << 32, 4 * MOST_BANDS + SIGNATURE, dtype=np.uint32)


def steep_shape(percent: int) -> tuple[int, int]:
    """(bands, permutations of each) of the steep bands: up to eight values a band."""
    s = percent / 100
    for permutations in (4, 3, 2, 1):
        let = s ** (2 * permutations)
        bands = 1 if let >= 1 else ceil(log(MISSED) / log1p(-let))
        if bands <= MOST_BANDS:
            break
    return min(bands, MOST_BANDS), permutations


def least_agreement(percent: int) -> int:
    """How many of a signature's values two sets at the threshold agree in, but for a share of DROPPED."""
    values, s, tail = 2 * SIGNATURE, percent / 100, 0.0
    for least in range(values + 1):
        tail += comb(values, least) * s**least * (1 - s) ** (values - least)
        if tail > DROPPED:
            break
    return least


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Blocks of (first row, per text its distinct shingle hashes, ascending)."""
    for first, end, buf, offsets in text_blocks(texts):
        starts, ends = word_spans(buf, offsets)
        words = span_hashes(LOWER[buf], starts, ends)
        upto = np.searchsorted(starts, offsets)
        wide = max(len(words) - n + 1, 0)
        whole = np.zeros(wide, np.uint64)
        for k in range(n):
            whole += words[k : k + wide] * _PLACES[k]
        whole = mix(whole)
        sets = []
        for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
            if b - a >= n:
                own = np.sort(whole[a : b - n + 1])
                sets.append(own[np.append(True, own[1:] != own[:-1])])
            else:  # fewer words than a shingle has: all of them are one
                part = np.add.reduce(mix(words[a:b] * _PLACES[n : n + b - a]))
                sets.append(mix(np.array([part] if b > a else [], np.uint64)))
        yield first, sets


def set_hashes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    pairs = [(np.bitwise_xor.reduce(mix(s)) if len(s) else 0, np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)))) for s in sets]
    first, second = zip(*pairs, strict=True)
    return np.array(first, np.uint64).view(np.int64), np.array(second, np.uint64).view(np.int64)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The band keys of non-empty sets, one row each; the band's number is hashed in."""
    short, at = _short(sets)
    keys = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, np.uint64)
        for p in (2 * band, 2 * band + 1):
            key = mix(key ^ _extremes(short, at, _FACTORS[p], _SHIFTS[p]))
        keys[:, band] = key
    return keys.view(np.int64)


def _short(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The low halves of the sets' hashes, as the high halves order the sets, and where each set begins."""
    sizes = np.array([len(s) for s in sets])
    return np.concatenate(sets).astype(np.uint32), np.cumsum(sizes) - sizes


def _extremes(short: np.ndarray, at: np.ndarray, factor: np.uint32, shift: np.uint32) -> np.ndarray:
    """The smallest and the largest value of each set under a permutation, in one number."""
    ranks = short * factor + shift
    low, high = np.minimum.reduceat(ranks, at), np.maximum.reduceat(ranks, at)
    return low.astype(np.uint64) << np.uint64(32) | high


def steep_keys(sets: list[np.ndarray], bands: int, permutations: int) -> np.ndarray:
    """The steep bands' keys of non-empty sets, one row each."""
    short, at = _short(sets)
    keys = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), BANDS + band + 1, np.uint64)
        for p in range(SIGNATURE + band * permutations, SIGNATURE + (band + 1) * permutations):
            key = mix(key ^ _extremes(short, at, _STEEP_FACTORS[p], _STEEP_SHIFTS[p]))
        keys[:, band] = key
    return keys.view(np.int64)


def set_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Two values of 32 bits for each of SIGNATURE permutations, a row for each non-empty set."""
    short, at = _short(sets)
    return np.column_stack([_extremes(short, at, _STEEP_FACTORS[p], _STEEP_SHIFTS[p]) for p in range(SIGNATURE)])


def signatures(docs: DataFrame, key: str, text: str, n: int, text_hash: bool = False) -> DataFrame:
    """(doc, n_shingles, set_a, set_b, keys): set hashes and band keys of every row;
    with ``text_hash`` also that."""
    carried = ["text_hash"] if text_hash else []

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), n):
                full = [s for s in sets if len(s)]
                keys = band_keys(full).ravel() if full else np.zeros(0, np.int64)
                stops = np.cumsum([0] + [BANDS if len(s) else 0 for s in sets])
                a, b = set_hashes(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(a),
                        pa.array(b),
                        pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(keys)),
                        *[batch.column(2).slice(first, len(sets)) for _ in carried],
                    ],
                    names=["doc", "n_shingles", "set_a", "set_b", "keys", *carried],
                )

    own = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), *[F.xxhash64(text).alias(c) for c in carried])
    schema = ", ".join(["doc long, n_shingles long, set_a long, set_b long, keys array<long>", *(f"{c} long" for c in carried)])
    return own.mapInArrow(sign, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(doc, shingles) of the documents in ``wanted`` (doc, set_a, set_b)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), n):
                a, b = set_hashes(sets)
                own = slice(first, first + len(sets))
                same = (a == batch.column(2).to_numpy()[own]) & (b == batch.column(3).to_numpy()[own])
                picked = [s for s, keep in zip(sets, same, strict=True) if keep]
                stops = np.cumsum([0] + [len(s) for s in picked]).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint64), *picked]).view(np.int64)
                ids = batch.column(0).slice(first, len(sets)).filter(pa.array(same))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(stops), pa.array(values))], names=["doc", "shingles"])

    own = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return own.join(wanted, "doc").select("doc", "text", "set_a", "set_b").mapInArrow(gather, "doc long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right"))
    small, large = F.least(F.size("left"), F.size("right")), F.greatest(F.size("left"), F.size("right"))
    common = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(right, "b").join(left, "a")
        .filter(100 * small >= percent * large)
        .filter(100 * common >= percent * (small + large - common))
        .select("a", "b")
    )


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that lie in more than one component, with their labels."""
    found = (
        split_join(members.withColumn("node", F.col("rep")), labels, "node", "left")
        .withColumn("label", F.coalesce("label", "rep"))
        .select("key", "rep", "n", "centre", "label")
    )
    found = saved(found, "members")
    mixed = (
        found.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
        .filter("low <> high").select("key", "size")
    )
    return saved(split_join(found, mixed, "key", "inner"), "open")


def _pairs_within(members: DataFrame, percent: int, first: str = "") -> DataFrame:
    """Pairs (a, b) of different components within buckets (key, rep, label, n, k) that may be similar
    if they share at most min(k) shingles. With ``first``, the column of a document's keys,
    each pair comes from the first bucket that both are in."""
    columns = ["label", "n", "k", *([first] if first else [])]
    left, right = (members.select("key", F.col("rep").alias(x), *[F.col(c).alias(c + x) for c in columns]) for x in "ab")
    close = f"a < b and labela <> labelb and 100 * least(ka, kb) >= {percent} * (na + nb - least(ka, kb))"
    if first:
        close += f" and key = array_intersect({first}a, {first}b)[0]"
    return left.join(right, "key").filter(close).select("a", "b")


def rare_shingles(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, label, s, mixed): the shingles of the documents (rep, label) that at most RARE of them
    have, and whether documents of several components do.

    Each task counts by some thousand documents first. What more than RARE of those have is
    passed on as one row, so that a shingle that all documents share makes few rows.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy()[offsets[0] : offsets[-1]]
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            values, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
            few = counts[back] <= RARE
            rows = pa.array(row[few])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(flat[few]), pa.array(np.ones(len(rows), np.int64))],
                names=["rep", "label", "s", "c"],
            )
            common = counts > RARE
            nobody = pa.nulls(int(common.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([nobody, nobody, pa.array(values[common]), pa.array(counts[common])], names=["rep", "label", "s", "c"])

    own = docs.join(sets.withColumnRenamed("doc", "rep"), "rep").select("rep", "label", "shingles")
    tokens = saved(own.mapInArrow(local, "rep long, label long, s long, c long"), "tokens")
    spread = tokens.groupBy("s").agg(F.sum("c").alias("df"), F.min("label").alias("low"), F.max("label").alias("high"))
    rare = spread.filter(F.col("df") <= RARE).select("s", (F.col("low") != F.col("high")).alias("mixed"))
    return saved(split_join(tokens.filter("rep is not null").drop("c"), rare, "s", "inner"), "rare")


def steep_members(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep, n, keys, signature) of the documents in open buckets, by the steep bands."""
    bands, permutations = steep_shape(percent)

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            for low in range(0, batch.num_rows, 256):
                high = min(low + 256, batch.num_rows)
                own = [flat[a:b] for a, b in zip(offsets[low:high], offsets[low + 1 : high + 1], strict=True)]
                keys, signs = steep_keys(own, bands, permutations).ravel(), set_signatures(own)
                stops = np.arange(high - low + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(keys)), pa.array([x.tobytes() for x in signs]),
                    ],
                    names=["rep", "n", "keys", "signature"],
                )

    docs = members.select("rep", "n").distinct()
    own = docs.join(sets.withColumnRenamed("doc", "rep"), "rep").select("rep", "n", "shingles")
    return own.mapInArrow(band, "rep long, n long, keys array<long>, signature binary")


def alike(pairs: DataFrame, steep: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) whose signatures agree as often as similar ones do."""
    least = least_agreement(percent)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, 2 * SIGNATURE) for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= least))

    left = steep.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = steep.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    both = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(keep, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, n, label, centre) of steep buckets that lie in more than one component."""
    own = split_join(members.withColumn("node", F.col("rep")), labels, "node", "left").select(
        "key", "rep", "n", F.coalesce("label", "rep").alias("label")
    )
    own = saved(own, "members")
    mixed = own.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("rep").alias("centre"))
    return saved(split_join(own, mixed.filter("low <> high").select("key", "centre"), "key", "inner"), "open")


def _steep_links(members: DataFrame, sets: DataFrame, links: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between different components among the documents of open buckets."""
    steep = saved(steep_members(members, sets, percent), "steep")
    rare = rare_shingles(members.select("rep", "label").distinct(), sets)
    # Similar documents share a rare shingle, of which each has few holders ...
    left, right = (rare.filter("mixed").select("s", F.col("rep").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    sharing = left.join(right, "s").filter("a < b and la <> lb").select("a", "b")
    # ... or have only common ones in common, at most as many (k) as either has of these.
    few = rare.groupBy("rep").agg(F.count("*").alias("r"))
    known = saved(steep.select("rep", "n", "keys").join(few, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("r", F.lit(0))).alias("k"), "keys"), "known")
    small = members.filter((F.col("size") <= SMALL_BUCKET) & (F.col("rep") != F.col("centre")))
    banded = steep.select(F.explode("keys").alias("key"), "rep", "n")
    still = _labelled(banded, labels)
    star = still.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b"))
    own = small.drop("n").join(known, "rep")
    near = saved(alike(_pairs_within(own, percent).unionByName(star).unionByName(sharing), steep, percent), "pairs")
    found = saved(confirmed(near, sets, percent), "links")
    if found.limit(1).count():
        labels = connected_components(links.unionByName(found))
        still = _labelled(still.select("key", "rep", "n"), labels)
    near = saved(alike(_pairs_within(still.drop("n").join(known, "rep"), percent, "keys"), steep, percent), "pairs")
    return found.unionByName(saved(confirmed(near, sets, percent), "links"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, text_hash: bool = False
) -> DataFrame:
    """(doc, n_shingles, component, kept) of every row: documents linked by a similarity
    of at least ``percent`` hundredths on sets of ``n``-word shingles, directly or in steps.
    With ``text_hash`` also that column, xxhash64 of the text."""
    carried = ["text_hash"] if text_hash else []
    signed = saved(signatures(docs, key, text, n, text_hash), "signed")
    full = signed.filter("n_shingles > 0 and doc is not null")
    classes = full.groupBy("set_a", "set_b").agg(F.min("doc").alias("rep"))
    classes = saved(classes, "classes")
    reps = (
        full.join(classes.withColumnsRenamed({"rep": "doc", "set_a": "ra", "set_b": "rb"}), "doc")
        .filter("set_a = ra and set_b = rb")
        .dropDuplicates(["doc", "set_a", "set_b"])
    )
    banded = reps.select(F.explode("keys").alias("key"), F.col("doc").alias("rep"), F.col("n_shingles").alias("n"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("m")).filter("m > 1").select("key", "centre")
    members = saved(split_join(banded, buckets, "key", "inner"), "buckets")
    wanted = members.select(F.col("rep").alias("doc")).distinct()
    wanted = wanted.join(classes.withColumnRenamed("rep", "doc"), "doc")
    sets = saved(full_sets(docs, wanted, key, text, n), "sets")
    star = members.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = saved(confirmed(star, sets, percent), "links")
    labels = connected_components(links)

    found = _steep_links(_open_members(members, labels), sets, links, labels, percent)
    if found.limit(1).count():
        labels = connected_components(links.unionByName(found))

    known = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_a", "set_b", F.coalesce("label", "rep").alias("component")
    )
    own = signed.select("doc", "n_shingles", "set_a", "set_b", *carried)
    linked = split_join(own.filter("n_shingles > 0"), known, ["set_a", "set_b"], "left").select("doc", "n_shingles", "component", *carried)
    alone = own.filter("n_shingles = 0").select("doc", "n_shingles", F.col("doc").alias("component"), *carried)
    whole = linked.unionByName(alone)
    component = F.when(F.col("doc").isNotNull(), F.col("component"))
    kept = F.coalesce(F.col("doc") == component, F.lit(True))
    return whole.select("doc", "n_shingles", component.alias("component"), kept.alias("kept"), *carried)
