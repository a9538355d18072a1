"""Turnover, tenure and early attrition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions import percentage, rounded_ratio
from shiftledger.plans.headcount import real_employees

# A year has 365.25 days, written as a whole number of hundredths.
HUNDREDTHS_OF_DAYS_PER_YEAR = 36_525

# Bounds in days of the attrition buckets, and their labels.
NINETY_DAYS = 90
SIX_MONTHS = 182


def turnover(
    employees: DataFrame, *, grain: str = "month", start: date | None = None, end: date | None = None
) -> DataFrame:
    """(termination_month or termination_quarter, terminations), periods with any."""
    leavers = real_employees(employees).where(F.col("term_date").isNotNull())
    if start is not None:
        leavers = leavers.where(F.col("term_date") >= F.lit(start))
    if end is not None:
        leavers = leavers.where(F.col("term_date") <= F.lit(end))
    period = f"termination_{grain}"
    return (
        leavers.groupBy(F.trunc("term_date", grain).alias(period))
        .agg(F.count(F.lit(1)).alias("terminations"))
        .orderBy(period)
    )


def turnover_series(
    employees: DataFrame, *, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Terminations of every month from the first to the last one with any, with a label."""
    months = turnover(employees, start=start, end=end)
    following = F.lead("termination_month").over(Window.orderBy("termination_month"))
    until = F.coalesce(F.add_months(following, -1), F.col("termination_month"))
    filled = months.withColumn("until", until).select(
        F.explode(F.sequence("termination_month", "until", F.expr("INTERVAL 1 MONTH"))).alias("month"),
        "termination_month",
        "terminations",
    )
    return filled.select(
        F.col("month").alias("termination_month"),
        F.date_format("month", "MMM yyyy").alias("month_label"),
        F.when(F.col("month") == F.col("termination_month"), F.col("terminations"))
        .otherwise(0)
        .alias("terminations"),
    ).orderBy("termination_month")


def _years(days: Column, employees: Column) -> Column:
    return rounded_ratio(days * F.lit(100), employees * F.lit(HUNDREDTHS_OF_DAYS_PER_YEAR))


def tenure_by_department(employees: DataFrame, *, department: str | None = None) -> DataFrame:
    """Employees with a known tenure and their average in years, longest first.

    Employees without a department form a group of their own.
    """
    staff = real_employees(employees).where(F.col("tenure_days").isNotNull())
    if department is not None:
        staff = staff.where(F.col("department_name") == department)
    return (
        staff.groupBy("department_name")
        .agg(F.count(F.lit(1)).alias("employee_count"), F.sum("tenure_days").alias("days"))
        .select(
            "department_name",
            "employee_count",
            _years(F.col("days"), F.col("employee_count")).alias("avg_tenure_years"),
        )
        .orderBy(F.desc_nulls_first("avg_tenure_years"), F.asc_nulls_last("department_name"))
    )


def tenure_by_status(employees: DataFrame) -> DataFrame:
    """Average tenure per department, of active and of terminated employees."""
    staff = real_employees(employees).where(F.col("tenure_days").isNotNull())
    active = F.col("active_status")
    return (
        staff.groupBy("department_name")
        .agg(
            F.count_if(active).alias("active_count"),
            F.sum(F.when(active, F.col("tenure_days"))).alias("active_days"),
            F.count_if(~active).alias("terminated_count"),
            F.sum(F.when(~active, F.col("tenure_days"))).alias("terminated_days"),
        )
        .select(
            "department_name",
            "active_count",
            _years(F.col("active_days"), F.col("active_count")).alias("avg_tenure_years_active"),
            "terminated_count",
            _years(F.col("terminated_days"), F.col("terminated_count")).alias("avg_tenure_years_terminated"),
        )
        .orderBy(F.asc_nulls_last("department_name"))
    )


def short_label(name: Column) -> Column:
    """A department name without the code before its first hyphen, at most 30 characters."""
    bare = F.regexp_replace(name, r"^[^-]*-", "")
    return F.when(F.length(bare) > 30, F.concat(F.substring(bare, 1, 28), F.lit("…"))).otherwise(bare)


def tenure_leaders(employees: DataFrame, *, limit: int = 12) -> DataFrame:
    """The departments with the longest average tenure, with a short label."""
    top = tenure_by_department(employees).limit(limit)
    return top.select(
        "department_name", short_label(F.col("department_name")).alias("short_label"), "avg_tenure_years"
    )


def _hired(employees: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    staff = real_employees(employees).where(F.col("hire_date").isNotNull())
    if start is not None:
        staff = staff.where(F.col("hire_date") >= F.lit(start))
    if end is not None:
        staff = staff.where(F.col("hire_date") <= F.lit(end))
    return staff


def _days_employed() -> Column:
    return F.datediff("term_date", "hire_date")


def early_attrition(employees: DataFrame, *, days: int = NINETY_DAYS) -> DataFrame:
    """One row: employees, those who left within ``days``, and the percentage."""
    span, rate = ("6_months", "6_month") if days == SIX_MONTHS else (f"{days}_days", f"{days}_day")
    counted = _hired(employees).agg(
        F.count(F.lit(1)).alias("total_employees"),
        F.count_if(_days_employed() <= days).alias("leavers"),
    )
    return counted.select(
        "total_employees",
        F.col("leavers").alias(f"left_within_{span}_count"),
        percentage(F.col("leavers"), F.col("total_employees")).alias(f"early_attrition_rate_{rate}_percentage"),
    )


def attrition_counts(
    employees: DataFrame, *, start: date | None = None, end: date | None = None
) -> DataFrame:
    """One row: employees hired in a range and those who left within 90 days and six months."""
    return _hired(employees, start, end).agg(
        F.count(F.lit(1)).alias("total_employees"),
        F.count_if(_days_employed() <= NINETY_DAYS).alias("left_within_90_days"),
        F.count_if(_days_employed() <= SIX_MONTHS).alias("left_within_6_months"),
    )


def early_leavers(employees: DataFrame) -> DataFrame:
    """Employees who left within six months, with the bucket they fall in."""
    days = F.col("days_employed")
    return (
        _hired(employees)
        .withColumn("days_employed", _days_employed())
        .where(days <= SIX_MONTHS)
        .select(
            "client_employee_id", "full_name", "department_name", "hire_date", "term_date", "days_employed",
            F.when(days <= NINETY_DAYS, "90 days").when(days <= SIX_MONTHS, "6 months").alias("attrition_bucket"),
        )
        .orderBy("days_employed", "client_employee_id")
    )
