"""Checks on the curated tables: metrics, diagnostics, results and the gate."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import percentage
from shiftledger.operators.constraints import duplicate_keys
from shiftledger.rules import Rules
from shiftledger.schemas import CHECK_RESULTS

ID = "client_employee_id"
CRITICAL, WARNING = "critical", "warning"
SHOWN_DETAILS = 5

# Check names and severities.
DUPLICATE_IDS = "curated_employee_no_duplicate_ids"
ORPHANS = "curated_timesheet_orphan_employee_refs"
TERM_BEFORE_HIRE = "curated_employee_hire_before_term"
PUNCH_ORDER = "curated_timesheet_punch_out_after_in"
NO_HIRE_DATE = "curated_employee_null_hire_date_real_employees"
MISSING_SCHEDULE = "curated_timesheet_missing_schedule_percentage"
PLACEHOLDERS = "curated_employee_placeholder_ratio_percentage"

SEVERITY = {
    DUPLICATE_IDS: CRITICAL,
    ORPHANS: CRITICAL,
    TERM_BEFORE_HIRE: CRITICAL,
    PUNCH_ORDER: CRITICAL,
    NO_HIRE_DATE: WARNING,
    MISSING_SCHEDULE: WARNING,
    PLACEHOLDERS: WARNING,
}


class QualityGateError(Exception):
    """At least one critical check failed."""


def _limit(check: str, rules: Rules) -> float:
    if check == MISSING_SCHEDULE:
        return rules.missing_schedule_limit
    if check == PLACEHOLDERS:
        return rules.placeholder_limit
    return rules.zero_tolerance


def _term_before_hire() -> Column:
    return F.col("term_date") < F.col("hire_date")


def _punches_reversed() -> Column:
    return F.col("punch_out_datetime") <= F.col("punch_in_datetime")


def _real_without_hire_date() -> Column:
    return ~F.col("is_placeholder") & F.col("hire_date").isNull()


def employee_metrics(employees: DataFrame) -> DataFrame:
    """One row with the metric of each employee check."""
    return employees.agg(
        (F.count(F.lit(1)) - F.count_distinct(ID)).alias(DUPLICATE_IDS),
        F.count_if(_term_before_hire()).alias(TERM_BEFORE_HIRE),
        F.count_if(_real_without_hire_date()).alias(NO_HIRE_DATE),
        percentage(F.count_if("is_placeholder"), F.count(F.lit(1))).alias(PLACEHOLDERS),
    )


def timesheet_metrics(timesheets: DataFrame, employees: DataFrame) -> DataFrame:
    """One row with the metric of each timesheet check, from one pass over the timesheets.

    Rows are counted per id before the join, so it sees each id once.
    """
    known = employees.select(ID).distinct().withColumn("is_known", F.lit(True))
    per_id = timesheets.groupBy(ID).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_punches_reversed()).alias("reversed"),
        F.count_if(F.col("is_late_arrival").isNull()).alias("unscheduled"),
    )
    zero = F.lit(0)
    return per_id.join(known, ID, "left").agg(
        F.coalesce(F.sum(F.when(F.col("is_known").isNull(), F.col("rows"))), zero).alias(ORPHANS),
        F.coalesce(F.sum("reversed"), zero).alias(PUNCH_ORDER),
        percentage(F.sum("unscheduled"), F.coalesce(F.sum("rows"), zero)).alias(MISSING_SCHEDULE),
    )


def _as_rows(metrics: DataFrame, rules: Rules) -> DataFrame:
    rows = [
        F.struct(
            F.lit(list(SEVERITY).index(check)).alias("place"),
            F.lit(check).alias("check_name"),
            F.lit(SEVERITY[check]).alias("severity"),
            F.lit(float(_limit(check, rules))).alias("max_allowed"),
            F.col(check).cast("double").alias("metric_value"),
        )
        for check in metrics.columns
    ]
    return metrics.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def check_metrics(employees: DataFrame, timesheets: DataFrame, rules: Rules) -> DataFrame:
    """(check_name, severity, passed, metric_value), seven rows. No value means not passed."""
    rows = _as_rows(employee_metrics(employees), rules).unionByName(
        _as_rows(timesheet_metrics(timesheets, employees), rules)
    )
    passed = F.coalesce(F.col("metric_value") <= F.col("max_allowed"), F.lit(False))
    return rows.orderBy("place").select("check_name", "severity", passed.alias("passed"), "metric_value")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])


def check_details(
    check: str, employees: DataFrame, timesheets: DataFrame, *, limit: int = SHOWN_DETAILS
) -> DataFrame | None:
    """The first findings of a check by id, one text each; None where there is nothing to list."""
    column = F.col
    if check == DUPLICATE_IDS:
        found, text = duplicate_keys(employees, [ID], nulls_distinct=False), _text(column(ID), ": ", column("rows"), " duplicates")
    elif check == ORPHANS:
        counted = timesheets.groupBy(ID).agg(F.count(F.lit(1)).alias("rows"))
        found = counted.join(employees.select(ID), ID, "left_anti")
        text = _text(column(ID), ": ", column("rows"), " orphan rows")
    elif check == TERM_BEFORE_HIRE:
        found = employees.where(_term_before_hire())
        text = _text(column(ID), ": hired ", column("hire_date"), " term ", column("term_date"))
    elif check == PUNCH_ORDER:
        found = timesheets.where(_punches_reversed())
        text = _text(column(ID), ": in=", column("punch_in_datetime"), " out=", column("punch_out_datetime"))
    elif check == NO_HIRE_DATE:
        found = employees.where(_real_without_hire_date())
        name = [F.coalesce(column(part), F.lit("?")) for part in ("first_name", "last_name")]
        text = _text(column(ID), ": ", name[0], " ", name[1])
    else:
        return None
    return found.select(ID, text.alias("detail")).orderBy(ID, "detail").limit(limit).select("detail")


def run_checks(
    employees: DataFrame, timesheets: DataFrame, rules: Rules, run_id: str | None = None, *, shown: int = SHOWN_DETAILS
) -> DataFrame:
    """Evaluates all checks and, for failed ones, lists the first findings."""
    run_id = run_id or uuid.uuid4().hex
    metrics = check_metrics(employees, timesheets, rules).collect()
    details = _details_of([row["check_name"] for row in metrics if not row["passed"]], employees, timesheets, shown)
    results = [
        (run_id, rules.stamp, row["check_name"], row["severity"], row["passed"], row["metric_value"],
         details.get(row["check_name"]))
        for row in metrics
    ]
    return employees.sparkSession.createDataFrame(results, CHECK_RESULTS)


def _details_of(checks: Sequence[str], employees: DataFrame, timesheets: DataFrame, shown: int) -> dict[str, str]:
    """The first findings of several checks, joined per check, from one job."""
    listed = [
        found.withColumn("check_name", F.lit(check))
        for check in checks
        if (found := check_details(check, employees, timesheets, limit=shown)) is not None
    ]
    if not listed:
        return {}
    texts: dict[str, list[str]] = {}
    for row in reduce(DataFrame.unionByName, listed).collect():
        texts.setdefault(row["check_name"], []).append(str(row["detail"]))
    return {check: "; ".join(found) for check, found in texts.items()}


def failed_critical(results: DataFrame) -> DataFrame:
    return results.where((F.col("severity") == CRITICAL) & ~F.col("passed"))


def gate(results: DataFrame) -> None:
    """Raises when a critical check failed; call it after the results are stored."""
    failed = [row["check_name"] for row in failed_critical(results).select("check_name").collect()]
    if failed:
        raise QualityGateError("critical checks failed: " + ", ".join(failed))


def write_json(results: DataFrame, path: str) -> None:
    """The results of one run as JSON lines in one file."""
    columns = ["check_name", "severity", "passed", "metric_value", "details"]
    results.select(*columns).coalesce(1).write.option("ignoreNullFields", False).json(path)
