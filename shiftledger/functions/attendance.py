"""Attendance flags. NULL means that the punch cannot be assessed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _grace(minutes: int) -> Column:
    return F.expr(f"INTERVAL {int(minutes)} MINUTES")


def _both_known(*columns: str) -> Column:
    known = F.lit(True)
    for name in columns:
        known = known & F.col(name).isNotNull()
    return known


def late_arrival(grace_minutes: int) -> Column:
    assessable = _both_known("scheduled_start_datetime", "scheduled_end_datetime", "punch_in_datetime")
    limit = F.col("scheduled_start_datetime") + _grace(grace_minutes)
    return F.when(assessable, F.col("punch_in_datetime") > limit)


def early_departure(grace_minutes: int) -> Column:
    assessable = _both_known("scheduled_start_datetime", "scheduled_end_datetime", "punch_out_datetime")
    limit = F.col("scheduled_end_datetime") - _grace(grace_minutes)
    return F.when(assessable, F.col("punch_out_datetime") < limit)


def overtime(grace_minutes: int) -> Column:
    assessable = _both_known(
        "scheduled_start_datetime", "scheduled_end_datetime", "punch_in_datetime", "punch_out_datetime"
    )
    worked = F.col("punch_out_datetime") - F.col("punch_in_datetime")
    planned = F.col("scheduled_end_datetime") - F.col("scheduled_start_datetime")
    return F.when(assessable, worked > planned + _grace(grace_minutes))
