"""Period reporting on business subscription plans, as Spark DataFrame functions."""

from planledger.config import DAILY, DAILY_V2, MONTHLY, JobConfig
from planledger.plans.ingest import ingest_cycle_discounts
from planledger.plans.snapshots import (
    daily_snapshot, daily_snapshot_v2, monthly_close, reduced_lists,
)

__all__ = [
    "DAILY", "DAILY_V2", "MONTHLY", "JobConfig", "daily_snapshot", "daily_snapshot_v2",
    "ingest_cycle_discounts", "monthly_close", "reduced_lists",
]
