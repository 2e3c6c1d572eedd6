"""Join shapes: enrichment, role-playing dimensions, list membership, joins of skewed sides,
reduction of a list to the keys that a report has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SPLIT = "__split"
#: Bits of a key filter, and bits of one of its words. Its size is bounded by them whatever the
#: number of keys: at most 2**20 rows of two numbers.
KEY_BITS = 1 << 26
_WORD = 64


def enrich(base: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join columns of ``right`` to ``base`` by one or more equal-named keys.

    No broadcast hint: Spark broadcasts a side only below its size threshold,
    and AQE re-decides with the measured sizes and splits skewed partitions.
    """
    return base.join(right, on, how)


def role_join(
    base: DataFrame, dim: DataFrame, base_key: str, dim_key: str, prefix: str, how: str = "left"
) -> DataFrame:
    """Join a dimension in one of several roles; its columns come back as ``prefix + name``."""
    renamed = dim.select(*[F.col(name).alias(prefix + name) for name in dim.columns])
    return base.join(renamed, F.col(base_key) == F.col(prefix + dim_key), how)


def left_filtered(
    base: DataFrame, right: DataFrame, on: str | list[str], predicate: Column
) -> DataFrame:
    """Left join in which ``predicate`` restricts only the right side (a filter inside ON)."""
    return base.join(right.filter(predicate), on, "left")


def inner_filtered(
    base: DataFrame, right: DataFrame, on: str | list[str], predicate: Column
) -> DataFrame:
    """A left join followed by a null-rejecting filter on the right, which is an inner join."""
    return base.join(right.filter(predicate), on, "inner")


def in_list(
    base: DataFrame, lst: DataFrame, on: str, flag: str, list_key: str | None = None
) -> DataFrame:
    """Add the boolean ``flag``: whether ``on`` occurs in the list."""
    keys = lst.select(F.col(list_key or on).alias(on)).filter(F.col(on).isNotNull()).distinct()
    joined = split_join(base, keys.withColumn(flag, F.lit(True)), on, "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def attach_total(
    base: DataFrame, totals: DataFrame, on: str, total: str, fill: object = None
) -> DataFrame:
    """Left join a total per key; ``fill`` replaces the total of keys without one."""
    joined = base.join(totals, on, "left")
    return joined if fill is None else joined.fillna({total: fill})


def split_join(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left"
) -> DataFrame:
    """Join a side with hot keys to one that was just aggregated on the same keys.

    AQE splits a skewed partition only if both inputs of the join come straight
    out of a shuffle. An input aggregated on the join keys does not: Spark joins
    it where it is. The constant extra key forces one more shuffle of those
    already reduced rows, after which a hot key's rows on the left are divided
    over many tasks. A small right side is broadcast by Spark's own size checks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    marker = F.pmod(F.xxhash64(*keys), F.lit(1))
    return (
        left.withColumn(_SPLIT, marker)
        .join(right.withColumn(_SPLIT, marker), [*keys, _SPLIT], how)
        .drop(_SPLIT)
    )


def key_filter(keys: DataFrame, on: str, bits: int = KEY_BITS) -> DataFrame:
    """A bitmap of the hashes of ``on``, for ``only_keys``: one row for each 64 bits in which a key lies.

    It holds as many rows as there are words at most, ``bits`` / 64, however many keys there are;
    with many keys it only excludes fewer others.
    """
    place = F.pmod(F.xxhash64(on), F.lit(bits))
    bit = F.pmod(place, F.lit(_WORD)).cast("int")
    placed = keys.filter(F.col(on).isNotNull()).select(
        F.shiftright(place, 6).alias("__word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("__bit")
    )
    return placed.groupBy("__word").agg(F.bit_or("__bit").alias("__mask"))


def only_keys(df: DataFrame, mask: DataFrame, on: str, bits: int = KEY_BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among those of ``mask``, made by ``key_filter``.

    All rows with such a key stay, and a few others, which a later join drops. Nothing is shuffled:
    the mask is broadcast, as its size is bounded by ``bits``. Rows without key go.
    """
    place = F.pmod(F.xxhash64(on), F.lit(bits))
    placed = df.filter(F.col(on).isNotNull()).withColumn("__word", F.shiftright(place, 6))
    kept = placed.join(F.broadcast(mask), "__word").filter(
        F.getbit("__mask", F.pmod(place, F.lit(_WORD)).cast("int")) == 1
    )
    return kept.select(*df.columns)
