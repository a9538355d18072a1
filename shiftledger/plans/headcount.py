"""Active headcount over time, without joining employees to dates.

Each employee adds one at the first date on which they count and takes one
away at the first on which they no longer do. Summed per date, these steps are
at most one row per calendar month or day; a running sum over them and a fill
of the gaps give every date of the range. The employee table is read once and
only partial sums are shuffled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions import percentage


def real_employees(employees: DataFrame) -> DataFrame:
    """Employees that are not placeholders."""
    return employees.where(~F.col("is_placeholder"))


def _point(day: Column, grain: str) -> Column:
    """The first reporting date on or after a day: its month's end, or the day itself."""
    return F.last_day(day) if grain == "month" else day


def _step(day: Column, grain: str, headcount: Column | int, terminations: int = 0, starts: bool = False) -> Column:
    return F.struct(
        _point(day, grain).alias("as_of_date"),
        F.lit(headcount).cast("long").alias("change"),
        F.lit(terminations).cast("long").alias("terminations"),
        F.lit(starts).alias("starts"),
    )


def _presence(grain: str, weight: Column | int) -> list[Column]:
    """Steps of one employee; one who left before being hired never counts."""
    hired, left = F.col("hire_date"), F.col("term_date")
    gone = F.greatest(hired, left)
    return [
        F.when(hired.isNotNull(), _step(hired, grain, weight, starts=True)),
        F.when(hired.isNotNull() & left.isNotNull(), _step(gone, grain, -F.lit(weight))),
    ]


def _sum_steps(people: DataFrame, steps: list[Column]) -> DataFrame:
    listed = people.select(F.explode(F.array_compact(F.array(*steps))).alias("step")).select("step.*")
    return _merge_steps(listed)


def _merge_steps(listed: DataFrame) -> DataFrame:
    return listed.groupBy("as_of_date").agg(
        F.sum("change").alias("change"),
        F.sum("terminations").alias("terminations"),
        F.max("starts").alias("starts"),
    )


def _fill(steps: DataFrame, end: date, grain: str) -> DataFrame:
    """Running headcount on every reporting date from the first step to ``end``.

    The window has no partition key, as its input is bounded by the calendar.
    """
    last = _point(F.lit(end).cast("date"), grain)
    by_date = Window.orderBy("as_of_date")
    running = steps.where(F.col("as_of_date") <= last).select(
        "as_of_date",
        "terminations",
        F.sum("change").over(by_date.rowsBetween(Window.unboundedPreceding, 0)).alias("active_headcount"),
        F.lead("as_of_date").over(by_date).alias("next_date"),
    )
    if grain == "month":
        until = F.coalesce(F.add_months(F.trunc("next_date", "MM"), -1), F.trunc(last, "MM"))
        dates = F.sequence(F.trunc("as_of_date", "MM").cast("date"), until, F.expr("INTERVAL 1 MONTH"))
    else:
        until = F.coalesce(F.date_sub("next_date", 1), last)
        dates = F.sequence(F.col("as_of_date"), until, F.expr("INTERVAL 1 DAY"))
    filled = running.select("*", F.explode(dates).alias("day"))
    return filled.select(
        _point(F.col("day"), grain).alias("as_of_date"),
        "active_headcount",
        F.when(_point(F.col("day"), grain) == F.col("as_of_date"), F.col("terminations"))
        .otherwise(0)
        .alias("terminations"),
    )


def headcount(
    employees: DataFrame,
    *,
    as_of: date,
    start: date | None = None,
    end: date | None = None,
    department: str | None = None,
    grain: str = "month",
) -> DataFrame:
    """(as_of_date, active_headcount) per month end or day, dates with nobody included.

    An employee counts on a date when hired by then and not yet left. The
    range runs from the first hire of any department, or ``start``, to ``end``
    or ``as_of``.
    """
    people = real_employees(employees)
    if start is None:
        weight: Column | int = 1
        if department is not None:
            weight = F.when(F.col("department_name") == department, 1).otherwise(0)
        steps = _sum_steps(people, _presence(grain, weight))
    else:
        if department is not None:
            people = people.where(F.col("department_name") == department)
        first = _point(F.lit(start).cast("date"), grain)
        seed = employees.sparkSession.range(1).select(
            _step(F.lit(start).cast("date"), grain, 0).alias("step")
        ).select("step.*")
        early = _sum_steps(people, _presence(grain, 1)).withColumn(
            "as_of_date", F.greatest("as_of_date", first)
        )
        steps = _merge_steps(early.unionByName(seed))
    return _fill(steps, end or as_of, grain).select("as_of_date", "active_headcount").orderBy("as_of_date")


def headcount_on(employees: DataFrame, day: date) -> DataFrame:
    """One row: the headcount on one date."""
    on = F.lit(day).cast("date")
    active = (F.col("hire_date") <= on) & (F.col("term_date").isNull() | (F.col("term_date") > on))
    return real_employees(employees).agg(F.count_if(active).alias("active_headcount"))


def turnover_rate(employees: DataFrame, *, as_of: date) -> DataFrame:
    """Month-end headcount, terminations in the month and their percentage of the headcount."""
    left = F.when(F.col("term_date").isNotNull(), _step(F.col("term_date"), "month", 0, terminations=1))
    steps = _sum_steps(real_employees(employees), [*_presence("month", 1), left])
    # Terminations before the first hire lie outside the range.
    first = F.min(F.when(F.col("starts"), F.col("as_of_date"))).over(Window.partitionBy())
    inside = steps.withColumn("first_date", first).where(F.col("as_of_date") >= F.col("first_date"))
    return (
        _fill(inside, as_of, "month")
        .withColumn("turnover_rate_percentage", percentage(F.col("terminations"), F.col("active_headcount")))
        .select("as_of_date", "active_headcount", "terminations", "turnover_rate_percentage")
        .orderBy("as_of_date")
    )
