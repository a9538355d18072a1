"""Cleaning, curation and constraint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftledger.functions import is_junk_id, parse_date, parse_flag, parse_number, parse_timestamp, strip_text
from shiftledger.operators import constraints, enforce, missing_keys
from shiftledger.plans import clean, curate
from shiftledger.registry import query
from shiftledger.registry.bridge import (
    FLAGS_SQL,
    PUNCHES,
    RULES,
    employees,
    inconsistent_employees,
    inconsistent_timesheets,
    raw_employees,
    raw_timesheets,
    sql,
    staged_employees,
    staged_timesheets,
    table,
    timesheets,
)
from shiftledger.schemas import CURATED_TIMESHEET_FIELDS, EMPLOYEE_FIELDS, TIMESHEET_FIELDS

ID = "client_employee_id"

# SQL spelling of the cleaning steps.
STRIPPED = "nullif(trim({}, ' ' || chr(9)), '')"
AS_DATE = "cast(try_strptime({}, ['%Y-%m-%d', '%-m/%-d/%Y']) as date)"
AS_TIMESTAMP = "try_strptime({}, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M', '%Y-%m-%d %H:%M'])"
AS_NUMBER = "cast(try_cast({} as decimal(18,4)) as double)"
AS_FLAG = (
    "case when lower(trim({0})) in ('1', 'true', 'y', 'yes') then true"
    " when lower(trim({0})) in ('0', 'false', 'n', 'no') then false end"
)
JUNK = (
    "({0} is null or {0} in ('999999', '999951', 'TEST2', 'CMCRN-3')"
    " or (length({0}) >= 4 and regexp_matches({0}, '^[0-9]+$') and {0} = repeat({0}[1], length({0}))))"
)
STRIPPED_ID = STRIPPED.format(ID)


def as_doubles(df, *names):
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- cleaning ----------------------------------------------------------------------


@query("cln1_strip_text", sql("raw_ts", f"""
    select {STRIPPED_ID} as client_employee_id, {STRIPPED.format("home_department_name")} as home_department_name
    from raw_ts"""))
def _(spark, sf):
    raw = raw_timesheets(spark, sf)
    return raw.select(*[strip_text(F.col(name)).alias(name) for name in (ID, "home_department_name")])


@query("cln2_parse_date", sql("raw_ts", f"""
    select punch_apply_date as given, {AS_DATE.format("punch_apply_date")} as parsed, count(*) as n
    from raw_ts group by all"""))
def _(spark, sf):
    text = F.col("punch_apply_date")
    return raw_timesheets(spark, sf).groupBy(text.alias("given"), parse_date(text).alias("parsed")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("cln3_parse_timestamp", sql("raw_ts", f"""
    select {AS_TIMESTAMP.format("punch_in_datetime")} as punch_in, {AS_TIMESTAMP.format("punch_out_datetime")} as punch_out,
        {AS_TIMESTAMP.format("scheduled_start_datetime")} as scheduled_start from raw_ts"""))
def _(spark, sf):
    return raw_timesheets(spark, sf).select(
        parse_timestamp(F.col("punch_in_datetime")).alias("punch_in"),
        parse_timestamp(F.col("punch_out_datetime")).alias("punch_out"),
        parse_timestamp(F.col("scheduled_start_datetime")).alias("scheduled_start"),
    )


# The same day written in eight ways, with the time that each says.
_WRITTEN = {
    "concat(date_format(l_shipdate, 'MM/dd/yyyy'), ' 08:05 AM')": "interval '485' minute",
    "concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T08:00:00Z')": "interval '480' minute",
    "concat(date_format(l_shipdate, 'yyyy-MM-dd'), ' 08:00:00+05:30')": "interval '150' minute",
    "date_format(l_shipdate, 'yyyyMMdd')": "interval '0' minute",
    "date_format(l_shipdate, 'd-MMM-yyyy')": "interval '0' minute",
    "date_format(l_shipdate, 'M/d/yy')": "interval '0' minute",
    "concat(date_format(l_shipdate, 'MMM d, yyyy'), ' 12:30 pm')": "interval '750' minute",
    "concat(date_format(l_shipdate, 'yyyyMMdd'), 'T2359')": "interval '1439' minute",
}
_TEXT = "case " + " ".join(f"when l_orderkey % 8 = {n} then {text}" for n, text in enumerate(_WRITTEN)) + " end"
_TIME = "case " + " ".join(f"when l_orderkey % 8 = {n} then {time}" for n, time in enumerate(_WRITTEN.values())) + " end"


@query("cln2_formats", f"""
    select l_orderkey, l_linenumber, cast(cast(l_shipdate as date) + {_TIME} as date) as day from lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").withColumn("given", F.expr(_TEXT)).select(
        "l_orderkey", "l_linenumber", parse_date(F.col("given"), RULES.date_formats).alias("day")
    )


@query("cln3_formats", f"select l_orderkey, l_linenumber, cast(l_shipdate as date) + {_TIME} as at_time from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").withColumn("given", F.expr(_TEXT)).select(
        "l_orderkey", "l_linenumber", parse_timestamp(F.col("given"), RULES.date_formats).alias("at_time")
    )


@query("cln4_parse_number", sql("raw_ts", f"""
    select hours_worked as given, {AS_NUMBER.format("hours_worked")} as parsed, count(*) as n from raw_ts group by all"""))
def _(spark, sf):
    text = F.col("hours_worked")
    parsed = parse_number(text).cast("double")
    return raw_timesheets(spark, sf).groupBy(text.alias("given"), parsed.alias("parsed")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("cln5_parse_flag", sql("raw_emp", f"""
    select is_per_deim as given, {AS_FLAG.format("is_per_deim")} as parsed, count(*) as n from raw_emp group by all"""))
def _(spark, sf):
    text = F.col("is_per_deim")
    return raw_employees(spark, sf).groupBy(text.alias("given"), parse_flag(text).alias("parsed")).agg(
        F.count(F.lit(1)).alias("n")
    )


_CLEAN_EMPLOYEES = f"""
    typed as (select {STRIPPED_ID} as client_employee_id, {STRIPPED.format("first_name")} as first_name,
        {STRIPPED.format("last_name")} as last_name, job_code, {AS_DATE.format("hire_date")} as hire_date,
        {AS_DATE.format("term_date")} as term_date, {AS_NUMBER.format("years_of_experience")} as years_of_experience,
        {AS_FLAG.format("is_per_deim")} as is_per_deim, loaded_at, source_file from raw_emp),
    latest as (select *, term_date is null as active_status from typed where client_employee_id is not null
        qualify row_number() over (partition by client_employee_id order by loaded_at desc, source_file desc) = 1)"""


def _clean_employees(spark, sf):
    return clean.clean_employees(raw_employees(spark, sf), RULES)


@query("cln6_active_status", sql("raw_emp", f"""
    {_CLEAN_EMPLOYEES} select active_status, term_date, count(*) as n from latest group by all"""))
def _(spark, sf):
    return _clean_employees(spark, sf).groupBy("active_status", "term_date").agg(F.count(F.lit(1)).alias("n"))


@query("cln7_latest_per_employee", sql("raw_emp", f"""
    {_CLEAN_EMPLOYEES} select client_employee_id, first_name, last_name, job_code, hire_date, term_date,
        years_of_experience, is_per_deim, active_status from latest"""))
def _(spark, sf):
    kept = _clean_employees(spark, sf).select(
        ID, "first_name", "last_name", "job_code", "hire_date", "term_date", "years_of_experience", "is_per_deim",
        "active_status",
    )
    return as_doubles(kept, "years_of_experience")


@query("cln8_employees_without_id", sql("raw_emp", f"""
    {_CLEAN_EMPLOYEES}
    select 'read' as part, count(*) as rows, count(*) filter (where client_employee_id is null) as without_id from typed
    union all select 'kept', count(*), 0 from latest"""))
def _(spark, sf):
    kept = _clean_employees(spark, sf).agg(
        F.lit("kept").alias("part"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ID).isNull()).alias("without_id")
    )
    read = clean.typed(raw_employees(spark, sf), EMPLOYEE_FIELDS).agg(
        F.lit("read").alias("part"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ID).isNull()).alias("without_id")
    )
    return read.unionByName(kept)


@query("cln9_punches_without_id", sql("raw_ts", f"""
    select count(*) as rows_without_id from raw_ts where {STRIPPED.format("case when client_employee_id <> '[NULL]' then client_employee_id end")} is null"""))
def _(spark, sf):
    # The null marker is dealt with at intake; here the column still holds it.
    raw = raw_timesheets(spark, sf).withColumn(ID, F.when(F.col(ID) != "[NULL]", F.col(ID)))
    dropped = clean.junk_summary(raw, RULES).where(F.col(ID).isNull())
    return dropped.select(F.col("rows").alias("rows_without_id"))


@query("cln10_junk_ids", sql("raw_ts", f"""
    ids as (select {STRIPPED_ID} as client_employee_id from raw_ts)
    select client_employee_id, {JUNK.format(ID)} as is_junk, count(*) as n from ids group by all"""))
def _(spark, sf):
    ids = raw_timesheets(spark, sf).select(strip_text(F.col(ID)).alias(ID))
    return ids.groupBy(ID, is_junk_id(F.col(ID), RULES.junk_ids).alias("is_junk")).agg(F.count(F.lit(1)).alias("n"))


@query("cln11_junk_summary", sql("raw_ts", f"""
    ids as (select {STRIPPED_ID} as client_employee_id from raw_ts)
    select client_employee_id, count(*) as rows from ids where {JUNK.format(ID)} group by 1"""))
def _(spark, sf):
    return clean.junk_summary(raw_timesheets(spark, sf), RULES)


@query("cln12_unknown_employee_ids", sql("punches staff", """
    select distinct client_employee_id from punches
    where client_employee_id not in (select client_employee_id from staff)"""))
def _(spark, sf):
    return missing_keys(staged_timesheets(spark, sf), staged_employees(spark, sf), ID)


@query("cln13_placeholders", sql("punches staff", """
    select distinct client_employee_id, 'Unknown' as first_name, 'Unknown' as last_name, cast(null as boolean) as active_status
    from punches where client_employee_id not in (select client_employee_id from staff)"""))
def _(spark, sf):
    made = clean.placeholders(staged_timesheets(spark, sf), staged_employees(spark, sf))
    return made.select(ID, "first_name", "last_name", "active_status")


_TYPED_PUNCHES = ", ".join(
    f"{{}} as {name}".format(
        STRIPPED.format(name) if kind.typeName() == "string"
        else AS_DATE.format(name) if kind.typeName() == "date"
        else AS_NUMBER.format(name) if kind.typeName() == "decimal"
        else AS_TIMESTAMP.format(name)
    )
    for name, kind in TIMESHEET_FIELDS.items()
)


@query("cln14_clean_timesheets", sql("raw_ts", f"""
    typed as (select {_TYPED_PUNCHES} from raw_ts) select * from typed where not {JUNK.format(ID)}"""))
def _(spark, sf):
    return as_doubles(clean.clean_timesheets(raw_timesheets(spark, sf), RULES), "hours_worked")


@query("cln15_absent_columns", sql("raw_ts", f"""
    typed as (select {STRIPPED_ID} as client_employee_id, {AS_NUMBER.format("hours_worked")} as hours_worked from raw_ts)
    select client_employee_id, hours_worked, cast(null as varchar) as department_name,
        cast(null as date) as punch_apply_date from typed where not {JUNK.format(ID)}"""))
def _(spark, sf):
    narrow = raw_timesheets(spark, sf).select(ID, "hours_worked")
    kept = clean.clean_timesheets(narrow, RULES)
    return as_doubles(kept.select(ID, "hours_worked", "department_name", "punch_apply_date"), "hours_worked")


# --- curation ------------------------------------------------------------------------


def _employee_column(slug, column):
    @query(slug, sql("emp", f"select client_employee_id, {column} from emp"))
    def _(spark, sf):
        return employees(spark, sf).select(ID, column)


_employee_column("cur1_is_placeholder", "is_placeholder")
_employee_column("cur2_full_name", "full_name")
_employee_column("cur3_tenure_days", "tenure_days")

_PUNCH_KEY = ", ".join(curate.PUNCH_KEY)
_REST = [name for name in PUNCHES if name not in curate.PUNCH_KEY]
_CURATED = ", ".join(CURATED_TIMESHEET_FIELDS).replace("hours_worked", "cast(hours_worked as double) as hours_worked")
_DEDUPED = f"""select * from punches qualify row_number() over (partition by {_PUNCH_KEY}
    order by {", ".join(f"{name} asc nulls first" for name in _REST)}) = 1"""


@query("cur4_dedup_timesheets", sql("punches", f"""
    deduped as ({_DEDUPED}) select * replace (cast(hours_worked as double) as hours_worked) from deduped"""))
def _(spark, sf):
    return as_doubles(curate.dedup_timesheets(staged_timesheets(spark, sf)), "hours_worked")


def _flag_column(slug, flag):
    @query(slug, sql("ts", f"""
        select client_employee_id, punch_in_datetime, punch_out_datetime, scheduled_start_datetime, {flag} from ts"""))
    def _(spark, sf):
        return timesheets(spark, sf).select(*curate.PUNCH_KEY, "scheduled_start_datetime", flag)


_flag_column("cur5_late_arrival", "is_late_arrival")
_flag_column("cur6_early_departure", "is_early_departure")
_flag_column("cur7_overtime", "is_overtime")


@query("cur8_curated_timesheets", sql("punches", f"""
    deduped as ({_DEDUPED}),
    flagged as (select *, {FLAGS_SQL} from deduped)
    select {_CURATED} from flagged"""))
def _(spark, sf):
    return as_doubles(curate.curate_timesheets(staged_timesheets(spark, sf), RULES), "hours_worked")


# --- constraints -----------------------------------------------------------------------


def _paired_ids(df):
    """Two neighbouring ids become one, so that every key occurs twice."""
    return df.withColumn(ID, F.expr(f"cast(cast({ID} as bigint) div 2 as string)"))


PAIRED = "select * replace (cast(cast(client_employee_id as bigint) // 2 as varchar) as client_employee_id)"


@query("con1_primary_key", sql("emp", f"""
    paired as ({PAIRED} from emp)
    select client_employee_id, count(*) as rows from paired group by 1 having count(*) > 1"""))
def _(spark, sf):
    return constraints.duplicate_keys(_paired_ids(employees(spark, sf)), [ID], nulls_distinct=False)


@query("con2_foreign_key", sql("ts emp", """
    select client_employee_id, count(*) as rows from ts
    where client_employee_id not in (select client_employee_id from emp) group by 1"""))
def _(spark, sf):
    return constraints.orphan_keys(timesheets(spark, sf), employees(spark, sf), ID)


@query("con3_unique_punch", sql("ts", f"""
    select {_PUNCH_KEY}, count(*) as rows from ts
    where punch_in_datetime is not null and punch_out_datetime is not null group by all having count(*) > 1
    union all select null, null, null, count(*) from ts"""))
def _(spark, sf):
    rows = timesheets(spark, sf)
    # Also the number of rows looked at, as duplicates are rare.
    total = rows.select(*[F.lit(None).alias(name) for name in curate.PUNCH_KEY]).groupBy(*curate.PUNCH_KEY).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return constraints.duplicate_keys(rows, curate.PUNCH_KEY).unionAll(total)


def _broken_employees(spark, sf):
    return inconsistent_employees(spark, sf).withColumn(
        "years_of_experience", F.expr("cast(tenure_days % 40 - 1 as decimal(18,4))")
    )


def _broken_timesheets(spark, sf):
    rows = inconsistent_timesheets(spark, sf)
    return rows.withColumn("hours_worked", F.col("hours_worked") - 2).withColumn(
        "punch_apply_date", F.when(F.col("department_id") != "4", F.col("punch_apply_date"))
    )


BROKEN_EMP = "broken as (select *, tenure_days % 40 - 1 as years_of_experience from emp_bad)"
BROKEN_TS = """broken as (select * replace (hours_worked - 2 as hours_worked,
    case when department_id <> '4' then punch_apply_date end as punch_apply_date) from ts_bad)"""


def _rule_count(slug, view, broken, build, rule, violation):
    @query(slug, sql(view, f"""
        {broken} select '{rule.name}' as rule, count(*) filter (where {violation}) as rows from broken"""))
    def _(spark, sf):
        return constraints.broken_counts(build(spark, sf), [rule])


_EMP = ("emp_bad", BROKEN_EMP, _broken_employees)
_TS = ("ts_bad", BROKEN_TS, _broken_timesheets)
_rule_count("con4_not_null", *_TS, constraints.required("punch_apply_date")[0], "punch_apply_date is null")
_rule_count("con5_hours_not_negative", *_TS, constraints.HOURS_NOT_NEGATIVE, "hours_worked < 0")
_rule_count("con6_tenure_not_negative", *_EMP, constraints.TENURE_NOT_NEGATIVE, "tenure_days < 0")
_rule_count("con7_term_after_hire", *_EMP, constraints.TERM_AFTER_HIRE, "term_date < hire_date")
_rule_count("con8_experience_not_negative", *_EMP, constraints.EXPERIENCE_NOT_NEGATIVE, "years_of_experience < 0")
_rule_count("con9_punches_ordered", *_TS, constraints.PUNCHES_ORDERED, "punch_out_datetime <= punch_in_datetime")


@query("con_quarantine_timesheets", sql("ts_bad", f"""
    {BROKEN_TS},
    named as (select client_employee_id, punch_in_datetime, punch_out_datetime, concat_ws(',',
        case when punch_apply_date is null then 'punch_apply_date_not_null' end,
        case when hours_worked < 0 then 'hours_worked_not_negative' end,
        case when punch_out_datetime <= punch_in_datetime then 'punch_out_after_punch_in' end) as broken_rules from broken)
    select * from named where broken_rules <> ''"""))
def _(spark, sf):
    rules = constraints.ROW_RULES["curated.timesheet"]
    _, bad = enforce(_broken_timesheets(spark, sf), rules, on_violation="quarantine")
    return bad.select(*curate.PUNCH_KEY, F.array_join("broken_rules", ",").alias("broken_rules"))


@query("con_accepted_employees", sql("emp_bad", f"""
    {BROKEN_EMP} select client_employee_id, hire_date, term_date, tenure_days from broken
    where coalesce(tenure_days >= 0, true) and coalesce(term_date >= hire_date, true)
        and coalesce(years_of_experience >= 0, true)"""))
def _(spark, sf):
    rules = constraints.ROW_RULES["curated.employee"]
    good, _ = enforce(_broken_employees(spark, sf), rules, on_violation="quarantine")
    return good.select(ID, "hire_date", "term_date", "tenure_days")
