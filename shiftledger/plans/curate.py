"""Staging rows to curated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import early_departure, late_arrival, overtime
from shiftledger.operators import first_per_key, insert_absent
from shiftledger.plans.clean import arrival_order
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE_FIELDS, CURATED_TIMESHEET_FIELDS

PUNCH_KEY = ("client_employee_id", "punch_in_datetime", "punch_out_datetime")


def is_placeholder() -> Column:
    unknown = F.lit("Unknown")
    return F.col("first_name").eqNullSafe(unknown) & F.col("last_name").eqNullSafe(unknown)


def full_name() -> Column:
    """The non-empty name parts joined by a space; NULL when there is none."""
    parts = [F.nullif(F.col(name), F.lit("")) for name in ("first_name", "middle_name", "last_name")]
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def tenure_days(rules: Rules) -> Column:
    end = F.coalesce(F.col("term_date"), F.lit(rules.as_of).cast("date"))
    return F.datediff(end, F.col("hire_date"))


def curate_employees(staging: DataFrame, rules: Rules) -> DataFrame:
    return staging.select(
        "*",
        is_placeholder().alias("is_placeholder"),
        full_name().alias("full_name"),
        tenure_days(rules).alias("tenure_days"),
    ).select(*CURATED_EMPLOYEE_FIELDS)


def dedup_timesheets(staging: DataFrame) -> DataFrame:
    """The first row per employee, punch in and punch out; missing punches are equal."""
    return first_per_key(staging, PUNCH_KEY, arrival_order(staging))


def with_attendance_flags(timesheets: DataFrame, rules: Rules) -> DataFrame:
    return timesheets.withColumns({
        "is_late_arrival": late_arrival(rules.grace_minutes),
        "is_early_departure": early_departure(rules.grace_minutes),
        "is_overtime": overtime(rules.grace_minutes),
    })


def curate_timesheets(staging: DataFrame, rules: Rules) -> DataFrame:
    return curated(dedup_timesheets(staging), rules)


def absent_timesheets(staging: DataFrame, held: DataFrame, rules: Rules) -> DataFrame:
    """:func:`curate_timesheets` without the punches of ``held``; missing punches are equal. The staged rows are shuffled once."""
    return curated(insert_absent(held, staging, PUNCH_KEY, null_safe=True, order=arrival_order(staging)), rules)


def curated(once: DataFrame, rules: Rules) -> DataFrame:
    return with_attendance_flags(once, rules).select(*CURATED_TIMESHEET_FIELDS)
