"""Quality-check and report queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shiftledger.plans import quality, report
from shiftledger.registry import query
from shiftledger.registry.bridge import (
    RULES,
    employees,
    inconsistent_employees,
    inconsistent_timesheets,
    percent,
    raw_employees,
    raw_timesheets,
    sql,
    staged_employees,
    staged_timesheets,
    timesheets,
)
from shiftledger.registry.curation import PAIRED
from shiftledger.session import new_folder
from shiftledger.sources import Layers

ID = "client_employee_id"


def _paired(spark, sf):
    """Inconsistent employees of whom every two share an id."""
    return inconsistent_employees(spark, sf).withColumn(ID, F.expr(f"cast(cast({ID} as bigint) div 2 as string)"))


PAIRED_EMP = f"paired as ({PAIRED} from emp_bad)"

# Value of each check, and its first findings, in SQL.
VALUES = {
    quality.DUPLICATE_IDS: "select count(*) - count(distinct client_employee_id) as v from paired",
    quality.ORPHANS: "select count(*) as v from ts_bad where client_employee_id not in (select client_employee_id from paired)",
    quality.TERM_BEFORE_HIRE: "select count(*) as v from paired where term_date < hire_date",
    quality.PUNCH_ORDER: "select count(*) as v from ts_bad where punch_out_datetime <= punch_in_datetime",
    quality.NO_HIRE_DATE: "select count(*) as v from paired where not is_placeholder and hire_date is null",
    quality.MISSING_SCHEDULE: f"select {percent('count(*) filter (where is_late_arrival is null)', 'count(*)')} as v from ts_bad",
    quality.PLACEHOLDERS: f"select {percent('count(*) filter (where is_placeholder)', 'count(*)')} as v from paired",
}
FINDINGS = {
    quality.DUPLICATE_IDS: """select client_employee_id, client_employee_id || ': ' || count(*) || ' duplicates' as detail
        from paired group by client_employee_id having count(*) > 1""",
    quality.ORPHANS: """select client_employee_id, client_employee_id || ': ' || count(*) || ' orphan rows' as detail
        from ts_bad where client_employee_id not in (select client_employee_id from paired) group by 1""",
    quality.TERM_BEFORE_HIRE: """select client_employee_id, client_employee_id || ': hired ' || hire_date || ' term ' || term_date as detail
        from paired where term_date < hire_date""",
    quality.PUNCH_ORDER: """select client_employee_id,
        client_employee_id || ': in=' || punch_in_datetime || ' out=' || punch_out_datetime as detail
        from ts_bad where punch_out_datetime <= punch_in_datetime""",
    quality.NO_HIRE_DATE: """select client_employee_id,
        client_employee_id || ': ' || coalesce(first_name, '?') || ' ' || coalesce(last_name, '?') as detail
        from paired where not is_placeholder and hire_date is null""",
}
FIRST = "order by client_employee_id, detail limit 5"

SLUGS = {
    quality.DUPLICATE_IDS: "qc1{}_duplicate_ids",
    quality.ORPHANS: "qc2{}_orphans",
    quality.TERM_BEFORE_HIRE: "qc3{}_term_before_hire",
    quality.PUNCH_ORDER: "qc4{}_punch_order",
    quality.NO_HIRE_DATE: "qc5{}_no_hire_date",
    quality.MISSING_SCHEDULE: "qc6{}_missing_schedule",
    quality.PLACEHOLDERS: "qc7{}_placeholders",
}
ON_TIMESHEETS = (quality.ORPHANS, quality.PUNCH_ORDER, quality.MISSING_SCHEDULE)


def _metric(check):
    @query(SLUGS[check].format(""), sql("emp_bad ts_bad", f"""
        {PAIRED_EMP}, value as ({VALUES[check]}) select cast(v as double) as metric_value from value"""))
    def _(spark, sf):
        people = _paired(spark, sf)
        if check in ON_TIMESHEETS:
            metrics = quality.timesheet_metrics(inconsistent_timesheets(spark, sf), people)
        else:
            metrics = quality.employee_metrics(people)
        return metrics.select(F.col(check).cast("double").alias("metric_value"))


def _details(check):
    @query(SLUGS[check].format("d"), sql("emp_bad ts_bad", f"""
        {PAIRED_EMP}, found as ({FINDINGS[check]}) select detail from found {FIRST}"""))
    def _(spark, sf):
        return quality.check_details(check, _paired(spark, sf), inconsistent_timesheets(spark, sf))


for _check in SLUGS:
    _metric(_check)
    if _check in FINDINGS:
        _details(_check)


def _results_sql(limits: dict[str, float]) -> str:
    rows = []
    for check, value in VALUES.items():
        details = "cast(null as varchar)"
        if check in FINDINGS:
            details = f"""case when v <= {limits[check]} then null else (
                select string_agg(detail, '; ' order by client_employee_id, detail)
                from (select * from ({FINDINGS[check]}) {FIRST})) end"""
        rows.append(f"""select '{check}' as check_name, '{quality.SEVERITY[check]}' as severity,
            coalesce(v <= {limits[check]}, false) as passed, cast(v as double) as metric_value, {details} as details
            from ({value})""")
    return " union all ".join(rows)


_LIMITS = {check: 0 for check in VALUES} | {quality.MISSING_SCHEDULE: 10, quality.PLACEHOLDERS: 50}
_RESULT_COLUMNS = ["check_name", "severity", "passed", "metric_value", "details"]


def _results(spark, sf, run_id="run", rules=RULES):
    return quality.run_checks(_paired(spark, sf), inconsistent_timesheets(spark, sf), rules, run_id)


@query("qc8_check_results", sql("emp_bad ts_bad", f"{PAIRED_EMP}, results as ({_results_sql(_LIMITS)}) select * from results"))
def _(spark, sf):
    return _results(spark, sf).select(*_RESULT_COLUMNS)


@query("qc9_failed_critical", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)})
    select check_name from results where severity = 'critical' and not passed"""))
def _(spark, sf):
    return quality.failed_critical(_results(spark, sf)).select("check_name")


@query("snk7_stored_check_results", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)})
    select run_id, check_name, passed, metric_value from results, (values ('first'), ('second')) runs(run_id)"""))
def _(spark, sf):
    layers = Layers(spark, new_folder(spark, "checks"))
    for run_id in ("first", "second"):
        layers.append(_results(spark, sf, run_id), "quality.check_results")
    return layers.read("quality.check_results").select("run_id", "check_name", "passed", "metric_value")


@query("snk8_results_json", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)}) select * from results"""))
def _(spark, sf):
    results = _results(spark, sf)
    path = f"{new_folder(spark, 'results')}.json"
    quality.write_json(results, path)
    return spark.read.schema(results.select(*_RESULT_COLUMNS).schema).json(path)


# --- report ----------------------------------------------------------------------------

_COUNTS = """
    counts as (
        select 'raw.employee_raw' as label, count(*) as rows from raw_emp
        union all select 'raw.timesheet_raw', count(*) from raw_ts
        union all select 'staging.employee_staging', count(*) from staff
        union all select 'staging.timesheet_staging', count(*) from punches
        union all select 'curated.employee', count(*) from emp
        union all select 'curated.timesheet', count(*) from ts
        union all select 'curated.employee (active)', count(*) from emp where active_status
        union all select 'curated.employee (placeholder)', count(*) from emp where is_placeholder)"""
_COUNT_VIEWS = "raw_emp raw_ts staff punches emp ts"


def _counts(spark, sf):
    return report.row_counts({
        "raw.employee_raw": raw_employees(spark, sf),
        "raw.timesheet_raw": raw_timesheets(spark, sf),
        "staging.employee_staging": staged_employees(spark, sf),
        "staging.timesheet_staging": staged_timesheets(spark, sf),
        "curated.employee": employees(spark, sf),
        "curated.timesheet": timesheets(spark, sf),
    })


@query("r1_row_counts", sql(_COUNT_VIEWS, f"{_COUNTS} select * from counts"))
def _(spark, sf):
    return _counts(spark, sf)


def _two_runs(spark, sf):
    """Results of a run on consistent data, and of a later one on inconsistent data."""
    earlier = RULES.__class__(as_of=RULES.as_of, run_at=datetime(2001, 12, 1))
    first = quality.run_checks(employees(spark, sf), timesheets(spark, sf), earlier, "first")
    return first.unionByName(_results(spark, sf, "second"))


@query("r2_latest_results", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)}) select * from results"""))
def _(spark, sf):
    return report.latest_results(_two_runs(spark, sf))


@query("r2_two_runs_one_day", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)}) select * from results"""))
def _(spark, sf):
    """Two runs with one stamp: the later one has the larger run id."""
    good = quality.run_checks(employees(spark, sf), timesheets(spark, sf), RULES, "00000001-z")
    return report.latest_results(_results(spark, sf, "00000002-a").unionByName(good))


@query("r3_passed_of_total", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)})
    select count(*) filter (where passed) as passed, count(*) as total from results"""))
def _(spark, sf):
    return report.passed_of_total(_results(spark, sf))


_SHOWN_COUNTS = """select split_part(label, '.', 1) as layer, substr(label, strpos(label, '.') + 1) as "table",
    format('{:,}', rows) as rows from counts"""


@query("r4_count_lines", sql(_COUNT_VIEWS, f"{_COUNTS} {_SHOWN_COUNTS}"))
def _(spark, sf):
    return report.count_lines(_counts(spark, sf))


@query("r4_check_lines", sql("emp_bad ts_bad", f"""
    {PAIRED_EMP}, results as ({_results_sql(_LIMITS)})
    select check_name, severity, case when passed then 'PASS' else 'FAIL' end as result,
        coalesce(cast(metric_value as varchar), '-') as value, coalesce(details, '-') as details from results"""))
def _(spark, sf):
    return report.check_lines(_results(spark, sf))


@query("snk9_report_count_lines", sql(_COUNT_VIEWS, f"""
    {_COUNTS}, shown as ({_SHOWN_COUNTS})
    select '| ' || layer || ' | ' || "table" || ' | ' || rows || ' |' as line from shown"""))
def _(spark, sf):
    folder = new_folder(spark, "report")
    paths = report.write_report(spark, _counts(spark, sf), _results(spark, sf), folder, RULES.stamp)
    lines = spark.read.text(paths["md"]).select(F.col("value").alias("line"))
    return lines.where(F.col("line").rlike(r"^\| (raw|staging|curated) "))
