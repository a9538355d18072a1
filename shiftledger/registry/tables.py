"""Layer-table queries: append, upsert, insert-if-absent, reload and scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shiftledger.operators import insert_absent, upsert
from shiftledger.plans import clean, curate, refresh
from shiftledger.registry import query
from shiftledger.registry.bridge import (
    FLAGS_SQL,
    RULES,
    employees,
    inconsistent_employees,
    raw_timesheets,
    sql,
    staged_employees,
    staged_timesheets,
)
from shiftledger.schemas import AUDIT_FIELDS
from shiftledger.session import new_folder
from shiftledger.sources import Layers

ID = "client_employee_id"
BEFORE = datetime(2001, 6, 1)
_RAW = ["client_employee_id", "department_name", "hours_worked", "punch_apply_date", "punch_in_datetime"]


def _raw_with_lineage(spark, sf):
    return raw_timesheets(spark, sf).withColumns({
        "source_file": F.lit("punches.csv"),
        "loaded_at": F.lit(RULES.stamp).cast("timestamp"),
        "source_offset": F.lit(0).cast("long"),
        "source_row": F.lit(0).cast("long"),
    })


@query("snk1_append_raw", sql("raw_ts", f"""
    select {", ".join(_RAW)}, count(*) * 2 as n from raw_ts group by all"""))
def _(spark, sf):
    layers = Layers(spark, new_folder(spark, "raw"))
    for _ in range(2):
        layers.append(_raw_with_lineage(spark, sf), "raw.timesheet_raw")
    # Equal rows are brought together before they are counted: nearly all differ, so a task that counted what it scans
    # would hold all of that, and a stored file of this text has some ten million rows in 128 MB.
    return layers.read("raw.timesheet_raw").repartition(*_RAW).groupBy(*_RAW).agg(F.count(F.lit(1)).alias("n"))


@query("src11_table_scan", sql("punches", """
    select * replace (cast(hours_worked as double) as hours_worked) from punches"""))
def _(spark, sf):
    layers = Layers(spark, new_folder(spark, "staging"))
    punches = staged_timesheets(spark, sf)
    layers.replace(punches.withColumn("source_file", F.lit("punches.csv")), "staging.timesheet_staging")
    scanned = layers.read("staging.timesheet_staging").select(*punches.columns)
    return scanned.withColumn("hours_worked", F.col("hours_worked").cast("double"))


# Incoming records: every third has a new id, the others write over what is
# there, in part with an empty department.
_INCOMING_ID = "case when cast(client_employee_id as bigint) % 3 = 0 then concat('N', client_employee_id) else client_employee_id end"
_INCOMING_DEPARTMENT = "case when cast(client_employee_id as bigint) % 5 = 0 then null else 'new ' || department_name end"


def _incoming(df):
    return df.withColumns({
        "department_name": F.expr(_INCOMING_DEPARTMENT),
        ID: F.expr(_INCOMING_ID),
    })


def _audited(df):
    return df.withColumns({name: F.lit(BEFORE).cast(kind) for name, kind in AUDIT_FIELDS.items()})


def _upsert_sql(view: str, columns: str) -> str:
    return sql(view, f"""
        incoming as (select * replace ({_INCOMING_ID} as client_employee_id, {_INCOMING_DEPARTMENT} as department_name) from {view}),
        merged as (
            select {columns}, timestamp '2002-01-01 06:30:00' as updated_at,
                case when client_employee_id in (select client_employee_id from {view}) then timestamp '2001-06-01'
                    else timestamp '2002-01-01 06:30:00' end as created_at from incoming
            union all
            select {columns}, timestamp '2001-06-01', timestamp '2001-06-01' from {view}
            where client_employee_id not in (select client_employee_id from incoming))
        select * from merged""")


def _upserted(df):
    return upsert(_audited(df), _incoming(df), ID, RULES.stamp)


def _without_zone(df):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in AUDIT_FIELDS})


_STAFF = "client_employee_id, first_name, last_name, department_name, hire_date, term_date, active_status"


@query("snk2_upsert_staging_employees", _upsert_sql("staff", _STAFF))
def _(spark, sf):
    merged = _upserted(staged_employees(spark, sf))
    return _without_zone(merged).select(*_STAFF.split(", "), *AUDIT_FIELDS)


_EMP = "client_employee_id, full_name, department_name, tenure_days, is_placeholder"


@query("snk3_upsert_curated_employees", _upsert_sql("emp", _EMP))
def _(spark, sf):
    merged = _upserted(employees(spark, sf))
    return _without_zone(merged).select(*_EMP.split(", "), *AUDIT_FIELDS)


@query("snk3_touched_folders", sql("emp", f"""
    incoming as (select * replace ('changed' as department_name) from emp where client_employee_id like '%7')
    select client_employee_id, full_name, tenure_days, coalesce(i.department_name, e.department_name) as department_name,
        case when i.client_employee_id is not null then 'second' else 'first' end as written
    from emp e left join (select client_employee_id, department_name from incoming) i using (client_employee_id)"""))
def _(spark, sf):
    """A load of some employees merged into the folders of their keys; the other folders stay as they were written."""
    layers = Layers(spark, new_folder(spark, "curated"), folders=64)
    people = employees(spark, sf)
    layers.replace(_audited(people), "curated.employee")
    changed = people.where(F.col(ID).endswith("7")).withColumn("department_name", F.lit("changed"))
    refresh.merge(layers, changed, "curated.employee", RULES, "fail")
    written = F.when(F.col("updated_at") > F.lit(BEFORE).cast("timestamp"), "second").otherwise("first")
    return layers.read("curated.employee").select(ID, "full_name", "tenure_days", "department_name", written.alias("written"))


@query("snk4_insert_placeholders", sql("punches staff", """
    select client_employee_id, first_name, last_name from staff
    union all select distinct client_employee_id, 'Unknown', 'Unknown' from punches
    where client_employee_id not in (select client_employee_id from staff)"""))
def _(spark, sf):
    people = staged_employees(spark, sf)
    made = clean.placeholders(staged_timesheets(spark, sf), people)
    return people.unionByName(made, allowMissingColumns=True).select(ID, "first_name", "last_name")


# The curated table as an earlier load left it: punches before 1998.
_KEY = ", ".join(curate.PUNCH_KEY)
_EARLIER = f"earlier as (select distinct {_KEY} from punches where punch_apply_date < date '1998-01-01')"


def _earlier(staged):
    return staged.where(F.col("punch_apply_date") < F.lit("1998-01-01").cast("date"))


def _additions(spark, sf, *, null_safe):
    staged = staged_timesheets(spark, sf)
    current = curate.curate_timesheets(_earlier(staged), RULES)
    fresh = curate.curate_timesheets(staged, RULES)
    return insert_absent(current, fresh, curate.PUNCH_KEY, null_safe=null_safe, unique=True).select(*curate.PUNCH_KEY)


@query("snk5_insert_absent_punches", sql("punches", f"""
    {_EARLIER}, incoming as (select distinct {_KEY} from punches)
    select * from incoming i where not exists (
        select 1 from earlier e where e.client_employee_id = i.client_employee_id
        and e.punch_in_datetime = i.punch_in_datetime and e.punch_out_datetime = i.punch_out_datetime)"""))
def _(spark, sf):
    return _additions(spark, sf, null_safe=False)


@query("snk5_insert_absent_punches_null_safe", sql("punches", f"""
    {_EARLIER}, incoming as (select distinct {_KEY} from punches)
    select * from incoming i where not exists (
        select 1 from earlier e where e.client_employee_id = i.client_employee_id
        and e.punch_in_datetime is not distinct from i.punch_in_datetime
        and e.punch_out_datetime is not distinct from i.punch_out_datetime)"""))
def _(spark, sf):
    return _additions(spark, sf, null_safe=True)


@query("snk5_monthly_punches", sql("punches", f"""
    flagged as (select *, {FLAGS_SQL} from punches)
    select cast(date_trunc('month', punch_apply_date) as date) as month, count(*) as punches,
        count(*) filter (where is_late_arrival) as late from flagged group by 1"""))
def _(spark, sf):
    layers = Layers(spark, new_folder(spark, "curated"))
    flagged = curate.with_attendance_flags(staged_timesheets(spark, sf), RULES)
    layers.append(flagged, "curated.timesheet")
    stored = layers.read("curated.timesheet")
    return stored.groupBy("month").agg(
        F.count(F.lit(1)).alias("punches"), F.count_if("is_late_arrival").alias("late")
    )


@query("snk3_upsert_with_quarantine", sql("emp emp_bad", """
    select client_employee_id, e.hire_date, case when coalesce(b.term_date < b.hire_date or b.tenure_days < 0, false)
        then e.term_date else b.term_date end as term_date
    from emp e join emp_bad b using (client_employee_id)"""))
def _(spark, sf):
    """Updates of which some are bad: the stored rows of those stay."""
    layers = Layers(spark, new_folder(spark, "curated"))
    layers.replace(employees(spark, sf), "curated.employee")
    for _ in range(2):  # the second run changes nothing
        refresh.merge(layers, inconsistent_employees(spark, sf), "curated.employee", RULES, "quarantine")
    return layers.read("curated.employee").select(ID, "hire_date", "term_date")


@query("snk5_repeated_load", sql("punches", f"""
    keys as (select distinct {_KEY} from punches)
    select client_employee_id, count(*) as punches from keys group by 1"""))
def _(spark, sf):
    """The same staged punches, some without a punch time, curated twice."""
    layers = Layers(spark, new_folder(spark, "curated"))
    punches = staged_timesheets(spark, sf).withColumn("source_file", F.lit("punches.csv"))
    layers.replace(punches, "staging.timesheet_staging")
    known = clean.placeholders(punches, staged_employees(spark, sf).limit(0))
    layers.replace(curate.curate_employees(known, RULES), "curated.employee")
    for _ in range(2):
        refresh.load_timesheets(layers, RULES)
    return layers.read("curated.timesheet").groupBy(ID).agg(F.count(F.lit(1)).alias("punches"))


@query("snk6_reload_staging", sql("punches", """
    select client_employee_id, count(*) as punches, cast(sum(hours_worked) as double) as hours from punches group by 1"""))
def _(spark, sf):
    layers = Layers(spark, new_folder(spark, "staging"))
    punches = staged_timesheets(spark, sf).withColumn("source_file", F.lit("punches.csv"))
    layers.replace(_earlier(punches), "staging.timesheet_staging")
    layers.replace(punches, "staging.timesheet_staging")
    return layers.read("staging.timesheet_staging").groupBy(ID).agg(
        F.count(F.lit(1)).alias("punches"), F.sum("hours_worked").cast("double").alias("hours")
    )
