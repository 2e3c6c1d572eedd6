"""Sharding by Karmarkar-Karp differencing: equal bytes for groups that stay whole.

A partial partition has one sum per shard. Differencing repeatedly takes the two partial
partitions with the largest spread (largest less smallest sum) and adds them oppositely
ordered, the largest sum of one to the smallest of the other, until one is left.

Groups are equal texts (null and empty ones are one group), told apart by two checksums
and the length. They are dealt by hash into parcels of about ``PARCEL`` groups; each parcel is
differenced in a task of its own into one partial partition. Parcels are differenced
again, ``PARCEL`` sums at a time, until a few are left; those and the groups that are
large against a shard, of which there can only be few, are differenced together. So no
task holds all groups, and the driver gets at most ``FEW`` partitions and 100 groups a shard.

A group of copies is one row while it is placed, however many rows it has; its rows are
then joined to their shard in a way that can be split over tasks. A group larger than a
shard's share makes that shard larger than the others; the others are still equal.

Within its shard, each row gets a slot: rows are dealt into buckets by hash, counted and
ranked there, and shifted by the buckets before, so that no task sees a whole shard. Rows
that agree in key and text are one row with a count until then. Rows without key are
placed like others. Only key and text are read, so extra columns play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from planledger.llm.storage import saved
from planledger.operators.joins import split_join

#: Groups, or parcels of groups, that one task differences.
PARCEL = 1 << 11
#: Parcels that are left to the last step.
FEW = 64
#: What a row costs besides its text, in bytes.
ROW_BYTES = 16
GROUP = ["text_hash", "text_crc32", "size"]


class _Part:
    """A partial partition: ascending sums, and per sum the tree of what is in it."""

    __slots__ = ("sums", "trees")

    def __init__(self, sums: list[int], trees: list) -> None:
        self.sums, self.trees = sums, trees


def differenced(parts: Iterable[list[int]], shards: int) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions, each up to ``shards`` sums, into one.

    Returns its sums, ascending, and for each given part the places its own sums went to.
    """
    given = [list(p) for p in parts]
    heap: list[tuple[int, int, _Part]] = []
    trees: list[tuple] = []  # (left, right) trees; a leaf is (part, place of its sum)
    for k, sums in enumerate(given):
        order = sorted(range(len(sums)), key=sums.__getitem__)
        nodes: list[int | None] = [None] * (shards - len(sums))
        for place in order:
            trees.append((-1 - k, place))
            nodes.append(len(trees) - 1)
        whole = [0] * (shards - len(sums)) + [sums[place] for place in order]
        if any(x > y for x, y in zip(whole, whole[1:], strict=False)):
            raise ValueError("sums must not be negative")
        heap.append((whole[0] - whole[-1], k, _Part(whole, nodes)))
    heapq.heapify(heap)
    count = len(given)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        sums = [x + y for x, y in zip(one.sums, reversed(two.sums), strict=True)]
        nodes = []
        for x, y in zip(one.trees, reversed(two.trees), strict=True):
            if x is not None and y is not None:
                trees.append((x, y))
                nodes.append(len(trees) - 1)
            else:
                nodes.append(x if y is None else y)
        order = sorted(range(shards), key=sums.__getitem__)
        sums, nodes = [sums[i] for i in order], [nodes[i] for i in order]
        heapq.heappush(heap, (sums[0] - sums[-1], count, _Part(sums, nodes)))
        count += 1
    went = [[0] * len(sums) for sums in given]
    if not heap:
        return [0] * shards, went
    last = heap[0][2]
    place_of = [0] * len(trees)
    for place, node in enumerate(last.trees):
        if node is not None:
            place_of[node] = place
    for node in range(len(trees) - 1, -1, -1):
        left, right = trees[node]
        if left < 0:
            went[-1 - left][right] = place_of[node]
        else:
            place_of[left] = place_of[right] = place_of[node]
    return last.sums, went


def text_groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, text_crc32, size) of every row: GROUP names equal texts."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(
        key, F.xxhash64(raw).alias("text_hash"), F.crc32(raw).alias("text_crc32"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
    )


def _difference_parcels(sums: DataFrame, shards: int) -> DataFrame:
    """(parcel, part, place) and more, to (parcel, part, place, went): each parcel's parts differenced.

    ``sums`` has a row (parcel, part, place, bytes) for each sum of a part; ``went`` is the place
    in the parcel's own partition.
    """

    def difference(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), table["place"].to_pylist(), table["bytes"].to_pylist(), strict=True))
        parts: dict[object, list[tuple[int, int]]] = {}
        for part, place, size in rows:
            parts.setdefault(part, []).append((place, size))
        _, went = differenced([[size for _, size in own] for own in parts.values()], shards)
        to = [x for places in went for x in places]
        return pa.table([
            pa.array([table["parcel"][0].as_py()] * len(rows), pa.int64()),
            pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array(to, pa.int32()),
        ], names=["parcel", "part", "place", "bytes", "went"])

    return sums.groupBy("parcel").applyInArrow(difference, "parcel long, part string, place int, bytes long, went int")


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(the columns GROUP, shard) for groups (the columns GROUP, bytes), which were saved before."""
    spark = groups.sparkSession
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    heavy = F.col("bytes") * 100 * shards > total
    # At most 100 for each shard, as all of them together are no more than the total.
    large = sorted((tuple(r) for r in groups.filter(heavy).select(*GROUP, "bytes").collect()), key=lambda r: (-r[3], r[:3]))
    name = F.concat_ws(":", *GROUP)
    parcels = max(1, -(-count // PARCEL))
    rows = groups.filter(~heavy).select(
        F.pmod(F.xxhash64(*GROUP, F.lit(1)), F.lit(parcels)).alias("parcel"), name.alias("part"), F.lit(0).alias("place"), "bytes"
    )
    levels = []
    while True:
        level = saved(_difference_parcels(rows, shards), "differences")
        levels.append(level)
        sums = level.groupBy("parcel", F.col("went").alias("place")).agg(F.sum("bytes").alias("bytes"))
        if parcels <= FEW:
            break
        parcels = -(-parcels // FEW)
        rows = sums.select((F.col("parcel") % parcels).alias("parcel"), F.col("parcel").cast("string").alias("part"), "place", "bytes")
    last = sorted(tuple(r) for r in sums.collect())  # FEW parcels, a sum for each shard
    parts: dict[int, list[tuple[int, int]]] = {}
    for parcel, place, size in last:
        parts.setdefault(parcel, []).append((place, size))
    _, went = differenced([*([size for _, size in own] for own in parts.values()), *([r[3]] for r in large)], shards)
    top = [(parcel, place, to) for (parcel, own), tos in zip(parts.items(), went, strict=False) for (place, _), to in zip(own, tos, strict=True)]
    shard_of = spark.createDataFrame(top, "parcel long, place int, shard int")
    # Back down: where each parcel's places went gives where its parts' places did.
    for level in reversed(levels):
        own = level.join(shard_of.withColumnRenamed("place", "went"), ["parcel", "went"]).select("part", "place", "shard")
        shard_of = own.select(F.expr("try_cast(part AS bigint)").alias("parcel"), "place", "shard")
    named = groups.filter(~heavy).select(*GROUP, name.alias("part")).join(own, "part").select(*GROUP, "shard")
    tos = [(*r[:3], to[0]) for r, to in zip(large, went[len(parts):], strict=True)]
    return named.unionByName(spark.createDataFrame(tos, "text_hash long, text_crc32 long, size long, shard int"))


def numbered(rows: DataFrame, within: str, by: list[str], out: str, copies: str) -> DataFrame:
    """Number the rows of each ``within`` from 0 on, without gaps; a row takes ``copies`` numbers.

    ``out`` is the row's first number. Rows are dealt into buckets by hash, so that no task
    has more than some hundred thousand of them.
    """
    buckets = max(16, rows.count() // 100_000)
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64(*by, F.lit(2)), F.lit(buckets)))
    before = Window.partitionBy(within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy(within, "__bucket").agg(F.sum(copies).alias("__n"))
        .select(within, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    )
    earlier = Window.partitionBy(within, "__bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("__row", F.coalesce(F.sum(copies).over(earlier), F.lit(0)))
    return ranked.join(shifts, [within, "__bucket"]).withColumn(out, F.col("__shift") + F.col("__row")).drop("__bucket", "__shift", "__row")


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, text_hash) of every row."""
    # Rows that agree are one row with a count: a row may repeat as often as it likes.
    rows = saved(text_groups(docs, key, text).groupBy(key, *GROUP).agg(F.count("*").alias("copies")), "rows")
    groups = saved(rows.groupBy(*GROUP).agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")), "groups")
    placed = saved(split_join(rows, place_groups(groups, shards), GROUP, "inner"), "placed")
    slots = numbered(placed, "shard", [key, *GROUP], "slot", "copies")
    each = slots.withColumn("slot", F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("copies") - 1)))
    return each.select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "text_hash",
    )


def write_shards(docs: DataFrame, sharded: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> None:
    """Write (key, text, slot), a folder ``shard=k`` for each shard, in order of slots within
    each file. A shard's rows go to several tasks and files."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    named = docs.select(key, text, F.xxhash64(raw).alias("text_hash"), F.crc32(raw).alias("text_crc32"))
    once = named.groupBy(key, "text_hash", "text_crc32").agg(F.max(text).alias(text))
    slots = sharded.select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash"), F.col("text_crc32").alias("__crc32"), "shard", "slot")
    same = F.col("__key").eqNullSafe(F.col(key)) & (F.col("__hash") == F.col("text_hash")) & (F.col("__crc32") == F.col("text_crc32"))
    rows = slots.join(once, same).select(key, text, "shard", "slot")
    dealt = rows.repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(16)))
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
