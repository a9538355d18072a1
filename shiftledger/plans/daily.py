"""Sums per employee and day, kept beside the punches, and the KPIs read from them.

Punches are only ever added, so a load adds the sums of its own rows; a day that several loads
brought punches of has a row of each, which readers add up. The KPIs then read a row per employee and day
instead of one per punch, and only the columns of sums.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import percentage
from shiftledger.plans.attendance import MEASURES
from shiftledger.plans.hours import DAY, ID, average_hours, in_range
from shiftledger.sources import Layers

TABLE, SOURCE = "curated.timesheet_daily", "curated.timesheet"


def _together(rows: DataFrame) -> DataFrame:
    """Rows of an employee and day in one partition. Their number is given, as adaptive execution would join partitions by their
    bytes, and what is shuffled here is far smaller than the sums of it in memory."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ID, DAY)


def daily_sums(timesheets: DataFrame) -> DataFrame:
    """Per employee and day: punches with hours and their sum, and per flag the assessable and the flagged punches.

    Rows go to their employee and day before they are added up. A file of punches holds some twenty million rows in what one
    task reads, with few rows a day, so a task that added them up first would hold a sum for nearly every row.
    """
    flags = [
        column for name, (flag, *_) in MEASURES.items()
        for column in (F.count(flag).alias(f"{name}_assessable"), F.count_if(F.col(flag)).alias(f"{name}_flagged"))
    ]
    return _together(timesheets).groupBy(ID, DAY).agg(
        F.count("hours_worked").alias("punches"), F.sum("hours_worked").alias("hours_worked"), *flags
    )


def update(layers: Layers) -> None:
    """Takes up the punches committed since the last update; all of them, in place of the sums, if the punches were replaced."""
    upto, after = layers.position(SOURCE), layers.consumed(TABLE, SOURCE)
    if upto == after:
        return
    anew = layers.replaced(SOURCE, after)
    sums = daily_sums(layers.read(SOURCE, after=0 if anew else after, upto=upto))
    (layers.replace if anew else layers.append)(sums, TABLE, consumed={SOURCE: upto})


def per_day(daily: DataFrame) -> DataFrame:
    """One row per employee and day with hours: ``hours_worked`` is their sum and ``punches`` their number.

    It serves in place of punches wherever these are only added up by day or week. Rows are brought together first,
    as in :func:`daily_sums`: most days have one row already.
    """
    return _together(daily.where(F.col("punches") > 0)).groupBy(ID, DAY).agg(
        F.sum("hours_worked").alias("hours_worked"), F.sum("punches").alias("punches")
    )


def hours_per_day_by_employee(daily: DataFrame) -> DataFrame:
    """Days worked and average hours per punch, highest first."""
    return (
        per_day(daily).groupBy(ID)
        .agg(F.count(DAY).alias("days_worked"), F.sum("hours_worked").alias("hours"), F.sum("punches").alias("punches"))
        .select(ID, "days_worked", average_hours(F.col("hours"), F.col("punches")).alias("avg_hours_per_day"))
        .orderBy(F.desc_nulls_first("avg_hours_per_day"), ID)
    )


def hours_summary(
    daily: DataFrame, *, employee_id: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """One row: average hours per punch and average of the weekly totals of employees."""
    rows = in_range(daily, employee_id=employee_id, start=start, end=end).where(F.col("punches") > 0)
    weekly = rows.groupBy(ID, F.trunc(DAY, "week")).agg(F.sum("hours_worked").alias("hours"), F.sum("punches").alias("punches"))
    total = weekly.agg(F.sum("hours").alias("hours"), F.sum("punches").alias("punches"), F.count(F.lit(1)).alias("weeks"))
    return total.select(
        average_hours(F.col("hours"), F.col("punches")).alias("overall_avg_hours_per_day"),
        average_hours(F.col("hours"), F.col("weeks")).alias("overall_avg_hours_per_week"),
    )


def attendance_by_employee(daily: DataFrame, measure: str) -> DataFrame:
    """Assessable punches, flagged ones and their percentage per employee with any assessable."""
    _, count, _, rate = MEASURES[measure]
    return (
        daily.where(F.col(f"{measure}_assessable") > 0).groupBy(ID)
        .agg(F.sum(f"{measure}_assessable").alias("assessable_punches"), F.sum(f"{measure}_flagged").alias(count))
        .withColumn(f"{rate}_percentage", percentage(F.col(count), F.col("assessable_punches")))
        .orderBy(F.desc(count), ID)
    )


def attendance_summary(
    daily: DataFrame, *, employee_id: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """One row with the rates of late arrival, early departure and overtime."""
    rows = in_range(daily, employee_id=employee_id, start=start, end=end)
    return rows.agg(*[
        percentage(F.sum(f"{name}_flagged"), F.sum(f"{name}_assessable")).alias(rate) for name, (*_, rate) in MEASURES.items()
    ])
