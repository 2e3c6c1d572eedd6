"""A month's billed revenue from sums per day, kept as partitions.

Sums merge: a month is the sum of its days. Each day's sums per subscriber are stored under
the day they were billed on, and only the days that got new or corrected rows are summed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from planledger.functions.calendar import period_bounds
from planledger.operators.reduce import billed_month, recurring_charges

DAY = "bill_date"


def days_of(arrivals: DataFrame, day: str = DAY) -> DataFrame:
    """The days that newly arrived rows belong to: late ones too."""
    return arrivals.filter(F.col(day).isNotNull()).select(F.col(day).alias(DAY)).distinct()


def daily_sums(detail: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """(subscriber, bill_date, amount) of recurring charges, of ``days`` only if given.

    Days without any such charge that ``days`` names come as one row without subscriber, so that
    storing them clears what was there.
    """
    rows = recurring_charges(detail)
    if days is not None:
        rows = rows.join(days, DAY, "left_semi")
    sums = rows.groupBy("subscriber_key", DAY).agg(F.sum("charge_amount").cast("decimal(28,2)").alias("amount"))
    if days is None:
        return sums
    empty = days.select(F.lit(None).cast("string").alias("subscriber_key"), DAY, F.lit(None).cast("decimal(28,2)").alias("amount"))
    return sums.unionByName(empty)


def store_days(detail: DataFrame, folder: str, days: DataFrame | None = None) -> None:
    """Sum ``days`` again (all, without) and put them in place of what the folder has for them.

    Only these days' partitions are overwritten; ``detail`` must hold all their rows.
    """
    sums = daily_sums(detail, days).repartition(DAY, F.pmod(F.xxhash64("subscriber_key"), F.lit(8)))
    sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(folder)


def billed_month_of_days(spark: SparkSession, folder: str, period: str, total: str = "arpu") -> DataFrame:
    """What ``billed_month`` gives, by adding the stored days of a ``yyyyMM`` period."""
    first, last = period_bounds(period)
    days = spark.read.schema(f"subscriber_key string, amount decimal(28,2), {DAY} date").parquet(folder)
    own = days.filter(F.col(DAY).between(F.lit(first), F.lit(last)) & F.col("amount").isNotNull())
    return own.groupBy("subscriber_key").agg(F.sum("amount").alias(total))


__all__ = ["billed_month", "billed_month_of_days", "daily_sums", "days_of", "store_days"]
