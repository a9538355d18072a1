"""Working hours: averages per day and week, and rolling averages over worked days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions import hour_units, rounded_ratio
from shiftledger.functions.measures import UNITS_PER_HOUR

ID, DAY = "client_employee_id", "punch_apply_date"


def in_range(
    timesheets: DataFrame,
    *,
    employee_id: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Timesheets of one employee and of a range of days, as far as given.

    On a table with monthly folders the range also selects the folders.
    """
    rows = timesheets
    monthly = "month" in timesheets.columns
    if employee_id is not None:
        rows = rows.where(F.col(ID) == employee_id)
    if start is not None:
        rows = rows.where(F.col(DAY) >= F.lit(start))
        if monthly:
            rows = rows.where(F.col("month") >= F.lit(start.replace(day=1)))
    if end is not None:
        rows = rows.where(F.col(DAY) <= F.lit(end))
        if monthly:
            rows = rows.where(F.col("month") <= F.lit(end))
    return rows


def average_hours(hours: Column, parts: Column) -> Column:
    return rounded_ratio(hour_units(hours), parts * F.lit(UNITS_PER_HOUR))


def _recorded(timesheets: DataFrame) -> DataFrame:
    return timesheets.where(F.col("hours_worked").isNotNull())


def _weekly(timesheets: DataFrame) -> DataFrame:
    """Hours and punches per employee and week (Monday to Sunday)."""
    return (
        _recorded(timesheets)
        .groupBy(ID, F.trunc(DAY, "week").alias("week_start"))
        .agg(F.sum("hours_worked").alias("hours"), F.count(F.lit(1)).alias("punches"))
    )


def daily_hours(timesheets: DataFrame) -> DataFrame:
    return _recorded(timesheets).groupBy(ID, DAY).agg(F.sum("hours_worked").alias("daily_hours"))


def hours_per_day_by_employee(timesheets: DataFrame) -> DataFrame:
    """Days worked and average hours per punch, highest first.

    Summing per day first counts distinct days without a distinct aggregation.
    """
    by_day = _recorded(timesheets).groupBy(ID, DAY).agg(
        F.sum("hours_worked").alias("hours"), F.count(F.lit(1)).alias("punches")
    )
    return (
        by_day.groupBy(ID)
        .agg(F.count(DAY).alias("days_worked"), F.sum("hours").alias("hours"), F.sum("punches").alias("punches"))
        .select(ID, "days_worked", average_hours(F.col("hours"), F.col("punches")).alias("avg_hours_per_day"))
        .orderBy(F.desc_nulls_first("avg_hours_per_day"), ID)
    )


def hours_per_week_by_employee(timesheets: DataFrame) -> DataFrame:
    return (
        _weekly(timesheets)
        .groupBy(ID)
        .agg(F.count(F.lit(1)).alias("weeks_worked"), F.sum("hours").alias("hours"))
        .select(ID, "weeks_worked", average_hours(F.col("hours"), F.col("weeks_worked")).alias("avg_hours_per_week"))
        .orderBy(F.desc_nulls_first("avg_hours_per_week"), ID)
    )


def hours_per_day(timesheets: DataFrame) -> DataFrame:
    """One row: average hours per punch."""
    total = _recorded(timesheets).agg(F.sum("hours_worked").alias("hours"), F.count(F.lit(1)).alias("punches"))
    return total.select(average_hours(F.col("hours"), F.col("punches")).alias("overall_avg_hours_per_day"))


def hours_per_week(timesheets: DataFrame) -> DataFrame:
    """One row: average of the weekly totals of all employees."""
    total = _weekly(timesheets).agg(F.sum("hours").alias("hours"), F.count(F.lit(1)).alias("weeks"))
    return total.select(average_hours(F.col("hours"), F.col("weeks")).alias("overall_avg_hours_per_week"))


def hours_summary(
    timesheets: DataFrame,
    *,
    employee_id: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """One row with both overall averages, from one pass over the selected punches."""
    total = _weekly(in_range(timesheets, employee_id=employee_id, start=start, end=end)).agg(
        F.sum("hours").alias("hours"), F.sum("punches").alias("punches"), F.count(F.lit(1)).alias("weeks")
    )
    return total.select(
        average_hours(F.col("hours"), F.col("punches")).alias("overall_avg_hours_per_day"),
        average_hours(F.col("hours"), F.col("weeks")).alias("overall_avg_hours_per_week"),
    )


def rolling_hours(timesheets: DataFrame) -> DataFrame:
    """Average daily hours over the last 7 and 30 worked days, for every worked day.

    Daily sums come first, so an employee has at most one row per calendar day
    in the window. Sums over the last days are differences of running sums (exact
    on decimals), where a sliding frame would be added up anew for every row.
    Range partitioning by employee serves the windows and the final order alike.
    """
    by_day = Window.partitionBy(ID).orderBy(DAY)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)

    def over_last(days: int) -> Column:
        before = F.coalesce(F.lag("hours_so_far", days).over(by_day), F.lit(0))
        return average_hours(F.col("hours_so_far") - before, F.least(F.col("days_so_far"), F.lit(days)))

    return (
        daily_hours(timesheets)
        .repartitionByRange(ID)
        .withColumns({
            "hours_so_far": F.sum("daily_hours").over(so_far),
            "days_so_far": F.row_number().over(by_day),
        })
        .select(
            ID,
            DAY,
            "daily_hours",
            over_last(7).alias("rolling_avg_hours_7day"),
            over_last(30).alias("rolling_avg_hours_30day"),
        )
        .orderBy(ID, DAY)
    )


def rolling_snapshot(timesheets: DataFrame, *, employee_id: str | None = None) -> DataFrame:
    """The latest rolling averages of each employee.

    Only the last 30 worked days of an employee leave a task.
    """
    latest = Window.partitionBy(ID).orderBy(F.desc(DAY))
    recent = (
        daily_hours(in_range(timesheets, employee_id=employee_id))
        .withColumn("recency", F.row_number().over(latest))
        .where(F.col("recency") <= 30)
    )
    last_week = F.when(F.col("recency") <= 7, F.col("daily_hours"))
    return (
        recent.groupBy(ID)
        .agg(
            F.max(DAY).alias("as_of_date"),
            F.sum(last_week).alias("hours_7"),
            F.count(last_week).alias("days_7"),
            F.sum("daily_hours").alias("hours_30"),
            F.count("daily_hours").alias("days_30"),
        )
        .select(
            ID,
            "as_of_date",
            average_hours(F.col("hours_7"), F.col("days_7")).alias("rolling_avg_hours_7day"),
            average_hours(F.col("hours_30"), F.col("days_30")).alias("rolling_avg_hours_30day"),
        )
        .orderBy(ID)
    )


def rolling_top(timesheets: DataFrame, *, employee_id: str | None = None, limit: int = 15) -> DataFrame:
    """The first ``limit`` employees by id of the snapshot; only their hours are added up."""
    rows = in_range(timesheets, employee_id=employee_id)
    first = _recorded(rows).select(F.col(ID).alias("first_id")).distinct().orderBy("first_id").limit(limit)
    return rolling_snapshot(rows.join(first, F.col(ID).eqNullSafe(F.col("first_id")), "left_semi"))
