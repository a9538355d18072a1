"""Attendance KPIs from the curated flags; NULL flags are not assessable."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import percentage
from shiftledger.plans.hours import in_range

ID = "client_employee_id"

# Flag column, name of its count, name of its overall count, name of its rate.
MEASURES = {
    "late_arrival": ("is_late_arrival", "late_arrivals", "total_late_arrivals", "late_arrival_rate"),
    "early_departure": (
        "is_early_departure", "early_departures", "total_early_departures", "early_departure_rate",
    ),
    "overtime": ("is_overtime", "overtime_days", "total_overtime_days", "overtime_rate"),
}


def flag_rate(flag: str) -> Column:
    return percentage(F.count_if(F.col(flag)), F.count(flag))


def by_employee(timesheets: DataFrame, measure: str) -> DataFrame:
    """Assessable punches, flagged ones and their percentage per employee with any assessable."""
    flag, count, _, rate = MEASURES[measure]
    # Rows that cannot be assessed change no output, so the scan may leave them out.
    return (
        timesheets.where(F.col(flag).isNotNull())
        .groupBy(ID)
        .agg(F.count(flag).alias("assessable_punches"), F.count_if(F.col(flag)).alias(count))
        .withColumn(f"{rate}_percentage", percentage(F.col(count), F.col("assessable_punches")))
        .orderBy(F.desc(count), ID)
    )


def overall(timesheets: DataFrame, measure: str) -> DataFrame:
    """One row: the same over all punches."""
    flag, _, count, rate = MEASURES[measure]
    totals = timesheets.agg(
        F.count(flag).alias("total_assessable_punches"), F.count_if(F.col(flag)).alias(count)
    )
    return totals.withColumn(
        f"overall_{rate}_percentage", percentage(F.col(count), F.col("total_assessable_punches"))
    )


def summary(
    timesheets: DataFrame,
    *,
    employee_id: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """One row with the three rates."""
    rows = in_range(timesheets, employee_id=employee_id, start=start, end=end)
    return rows.agg(*[flag_rate(flag).alias(rate) for flag, _, _, rate in MEASURES.values()])
