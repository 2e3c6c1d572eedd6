"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every unit of text (a run of letters, of digits, or of marks) falls into one of
``BUCKETS`` by hash. A bucket has a fixed sparse random vector; its word vector is
the sum of the random vectors of the units before and behind it, over all
documents. These sums are integers, added up per task and then per bucket, so the
table has a fixed size and does not depend on the order of rows. A document's
features are mean and standard deviation of its units' word vectors and a few
shares. The network (tanh, then logistic) is fitted in numpy on at most
``max_train`` labelled rows, which ``usable`` admits; of these a fifth sets the
temperature of the probabilities.

Null and empty texts have all-zero features and get the score those give. Of rows that
share an id only the text with the smallest hash is learned from; all are scored. Labels
other than 0 and 1 are ignored, of a repeated label row the smallest counts, and
labels of absent documents have no effect. Without labels of both kinds the score
is (1 + ones) / (2 + rows) for all. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from planledger.llm.textbytes import SPACE, span_hashes, text_blocks

BUCKETS = 8192
WIDTH = 32
#: Nonzero entries of a random vector.
NONZERO = 4
HIDDEN = 32
#: Units whose vectors are gathered together.
UNITS = 1 << 16

_rng = np.random.Generator(np.random.PCG64(90210))
_SPOTS = np.argsort(_rng.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
_SIGNS = _rng.integers(0, 2, (BUCKETS, NONZERO)) * 2 - 1

#: 0 white space, 1 letters and all bytes beyond ASCII, 2 digits, 3 marks.
_KIND = np.full(256, 3, np.int8)
_KIND[SPACE] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
N_FEATURES = 2 * WIDTH + 4


def units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bucket) of the units of texts that lie one after another."""
    kind = np.append(_KIND[buf], 0)
    edge = np.append(True, kind[1:] != kind[:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    inside = kind[starts] > 0
    starts, ends = starts[inside], ends[inside]
    return starts, ends, (span_hashes(buf, starts, ends) >> np.uint64(51)).astype(np.int64)


def context_sums(texts: pa.Array, table: np.ndarray) -> None:
    """Add the random vectors of every unit's neighbours to its bucket's row of ``table``."""
    for _, _, buf, offsets in text_blocks(texts):
        starts, _, bucket = units(buf, offsets)
        document = np.searchsorted(offsets, starts, "right")
        near = np.flatnonzero(document[1:] == document[:-1])
        for own, other in ((bucket[near], bucket[near + 1]), (bucket[near + 1], bucket[near])):
            for k in range(NONZERO):
                place = own * WIDTH + _SPOTS[other, k]
                table += np.bincount(place, _SIGNS[other, k], BUCKETS * WIDTH).astype(np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors of all ``docs``: BUCKETS rows of unit length, or zero."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS * WIDTH, np.int64)
        for batch in batches:
            context_sums(batch.column(0), table)
        rows = table.reshape(BUCKETS, WIDTH)
        some = np.flatnonzero(rows.any(axis=1))
        columns = [pa.array(some.astype(np.int32))] + [pa.array(rows[some, k]) for k in range(WIDTH)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    names = [f"v{k}" for k in range(WIDTH)]
    schema = ", ".join(["bucket int", *(f"{name} long" for name in names)])
    added = docs.select(text).mapInArrow(sums, schema).groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names])
    table = np.zeros((BUCKETS, WIDTH))
    for row in added.collect():  # BUCKETS rows at most
        table[row["bucket"]] = row[1:]
    # Damp what the commonest neighbours add, then compare directions only.
    table = np.sign(table) * np.sqrt(np.abs(table))
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES per text."""
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    for first, end, buf, offsets in text_blocks(texts):
        starts, ends, bucket = units(buf, offsets)
        upto = np.searchsorted(starts, offsets)
        some = np.flatnonzero(np.diff(upto))
        if not len(some):
            continue
        at, n = upto[some], np.diff(upto)[some].astype(np.float32)[:, None]
        sums = np.zeros((2, len(some), WIDTH))
        document = np.repeat(np.arange(len(some)), np.diff(upto)[some])
        for low in range(0, len(bucket), UNITS):
            own, here = table[bucket[low : low + UNITS]], document[low : low + UNITS]
            starts_here = np.flatnonzero(np.diff(np.append(-1, here)))
            sums[0, here[starts_here]] += np.add.reduceat(own, starts_here)
            sums[1, here[starts_here]] += np.add.reduceat(own * own, starts_here)
        mean = sums[0] / n
        spread = np.sqrt(np.maximum(sums[1] / n - mean * mean, 0))
        total = np.append(0, np.cumsum(_UPPER[buf]))
        upper = np.diff(total[offsets])[some] / np.diff(offsets)[some]
        marks = np.add.reduceat((_KIND[buf[starts]] == 3).astype(np.float32), at) / n[:, 0]
        same = np.append(False, bucket[1:] == bucket[:-1])
        same[at] = False  # a text's first unit has none before it
        again = np.add.reduceat(same.astype(np.float32), at) / n[:, 0]
        rows = first + some
        out[rows, :WIDTH], out[rows, WIDTH : 2 * WIDTH] = mean, spread
        out[rows, 2 * WIDTH :] = np.column_stack([upper, marks, again, np.log1p(n[:, 0]) / 10])
    return out


@dataclass(frozen=True, eq=False)
class Model:
    """Word vectors and network; without a network, ``prior`` is everyone's score."""

    table: np.ndarray
    prior: float
    network: tuple[np.ndarray, ...] | None = None
    temperature: float = 1.0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(rows), self.prior)
        return 1 / (1 + np.exp(-np.clip(_logits(self.network, rows) / self.temperature, -60, 60)))


def _logits(network: tuple[np.ndarray, ...], rows: np.ndarray) -> np.ndarray:
    centre, scale, w1, b1, w2, b2 = network
    return np.tanh((rows - centre) / scale @ w1 + b1) @ w2 + b2


def train(rows: np.ndarray, labels: np.ndarray, epochs: int = 60, seed: int = 7) -> tuple[np.ndarray, ...]:
    """Fit the two layers by Adam on cross entropy."""
    rng = np.random.Generator(np.random.PCG64(seed))
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-3)
    x = (rows - centre) / scale
    weights = [rng.normal(0, 0.2, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(())]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for low in range(0, len(order), 256):
            own = order[low : low + 256]
            hidden = np.tanh(x[own] @ weights[0] + weights[1])
            guess = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -60, 60)))
            error = (guess - labels[own]) / len(own)
            back = error[:, None] * weights[2] * (1 - hidden**2)
            grads = [x[own].T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error + 1e-4 * weights[2], error.sum()]
            step += 1
            for k, (w, g, (m, v)) in enumerate(zip(weights, grads, moments, strict=True)):
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g**2
                moments[k] = [m, v]
                weights[k] = w - 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return (centre, scale, *weights)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits at which the labels are likeliest."""
    tried = np.exp(np.linspace(np.log(0.25), np.log(20), 120))
    sides = np.where(labels > 0, 1.0, -1.0)
    losses = [np.logaddexp(0, -sides * logits / t).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, max_train: int = 20_000,
    key: str = "doc_id", text: str = "text", label: str = "quality",
) -> Model:
    """Word vectors over all ``docs``; the network on at most ``max_train`` labelled rows,
    taken in the order of a hash of the key. ``usable`` is over the key."""
    table = word_vectors(docs, text)
    known = labels.filter(F.col(label).isin(0, 1) & usable).groupBy(key).agg(F.min(label).alias("__label"))
    # The sample is max_train ids at most, so it may be broadcast.
    picked = known.orderBy(F.xxhash64(key), key).limit(max_train)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch.column(2), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(rows), pa.list_(pa.float32()))], names=["k", "y", "x"])

    # Of rows that share an id one text is learned from, whichever task has read it.
    texts = docs.select(key, F.struct(F.xxhash64(text), F.col(text).alias("text")).alias("__one")).join(F.broadcast(picked), key)
    own = texts.groupBy(key).agg(F.min("__one").alias("__one"), F.min("__label").alias("__label")).select(
        F.col(key).cast("string").alias("k"), F.col("__label").cast("int").alias("y"), F.col("__one.text").alias("__text")
    )
    found = own.mapInArrow(pooled, "k string, y int, x array<float>").collect()  # max_train rows at most
    found.sort(key=lambda row: row["k"])
    y = np.array([row["y"] for row in found], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(table, float((1 + y.sum()) / (2 + len(y))))
    x = np.array([row["x"] for row in found], np.float64)
    order = np.random.Generator(np.random.PCG64(3)).permutation(len(y))
    rest, held = order[len(y) // 5 :], order[: len(y) // 5]
    if len(set(y[rest])) < 2 or not len(held):
        rest = held = order
    network = train(x[rest], y[rest])
    return Model(table, float(y.mean()), network, temperature(_logits(network, x[held]), y[held]))


def score_quality(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` (double, 0 to 1) to every row; a column of that name is replaced."""
    own = docs.drop(score)
    shared = own.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(features(batch.column(batch.schema.get_field_index(text)), shared.value.table))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.float64))], names=[*batch.schema.names, score])

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema] + [f"`{score}` double"])
    return own.mapInArrow(scored, kinds)


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
