"""The given tables seen as employees and timesheets, in Spark and as SQL views.

Every order is an employee record and every line item a punch. Some values are
made missing, malformed or inconsistent by key arithmetic; no row is left out.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.plans.curate import curate_employees, with_attendance_flags
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_TIMESHEET_FIELDS, EMPLOYEE_FIELDS, TIMESHEET_FIELDS

AS_OF = date(2002, 1, 1)
RULES = Rules(as_of=AS_OF, run_at=datetime(2002, 1, 1, 6, 30))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- employees -----------------------------------------------------------------

STAFF = {
    "client_employee_id": "cast(o_orderkey as {text})",
    "first_name": "case when o_orderkey % 97 = 0 then 'Unknown' when o_orderkey % 31 = 0 then null else c_mktsegment end",
    "middle_name": "case when o_orderkey % 7 = 0 then '' when o_orderkey % 3 = 0 then o_orderstatus end",
    "last_name": "case when o_orderkey % 97 = 0 then 'Unknown' else c_name end",
    "department_name": "case when o_orderkey % 53 = 0 then null else o_orderpriority end",
    "hire_date": "case when o_orderkey % 97 = 0 or o_orderkey % 101 = 0 then null else cast(o_orderdate as date) end",
    "term_date": (
        "case when o_orderkey % 97 <> 0 and o_orderstatus = 'F'"
        " then cast(o_orderdate + interval '1' day * cast(o_custkey % 400 as int) as date) end"
    ),
    "active_status": "case when o_orderkey % 97 = 0 then null else o_orderstatus <> 'F' end",
}

EARLY_TERM = (
    "case when o_orderkey % 97 <> 0 and o_orderstatus = 'F'"
    " then cast(o_orderdate + interval '1' day * cast(o_custkey % 400 - 20 as int) as date) end"
)


def _staff_sql(term: str = STAFF["term_date"]) -> str:
    columns = {**STAFF, "term_date": term}
    listed = ", ".join(f"{text.format(text='varchar')} as {name}" for name, text in columns.items())
    return f"select {listed} from orders join customer on o_custkey = c_custkey"


def staged_employees(spark: SparkSession, folder: str, *, term: str = STAFF["term_date"]) -> DataFrame:
    columns = {**STAFF, "term_date": term}
    people = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return people.select(*[
        (F.expr(columns[name].format(text="string")) if name in columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in EMPLOYEE_FIELDS.items()
    ])


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return curate_employees(staged_employees(spark, folder), RULES)


def inconsistent_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Some left before they were hired."""
    return curate_employees(staged_employees(spark, folder, term=EARLY_TERM), RULES)


def _curated_employee_sql(source: str) -> str:
    return f"""select *,
        coalesce(first_name = 'Unknown', false) and coalesce(last_name = 'Unknown', false) as is_placeholder,
        nullif(concat_ws(' ', nullif(first_name, ''), nullif(middle_name, ''), nullif(last_name, '')), '') as full_name,
        date_diff('day', hire_date, coalesce(term_date, date '2002-01-01')) as tenure_days
        from {source}"""


# --- timesheets ----------------------------------------------------------------

PUNCHES = {
    "client_employee_id": "case when l_partkey % 41 = 0 then concat('T', cast(l_suppkey as {text})) else cast(l_suppkey as {text}) end",
    "department_id": "cast(l_partkey % 9 as {text})",
    "department_name": "concat(l_linestatus, '-', l_returnflag)",
    "home_department_id": "cast(l_suppkey % 9 as {text})",
    "home_department_name": "concat('H', l_linestatus)",
    "pay_code": "case l_linenumber when 1 then 'REG' when 2 then 'OT' else 'PTO' end",
    "punch_in_comment": "case when l_partkey % 13 = 0 then 'late bus' end",
    "punch_out_comment": "case when l_partkey % 17 = 0 then 'left | early' end",
    "hours_worked": "case when l_linenumber = 7 then null else cast(l_quantity as decimal(18,4)) * cast(0.25 as decimal(3,2)) end",
    "punch_apply_date": "cast(l_shipdate as date)",
    "punch_in_datetime": "case when l_partkey % 50 = 0 then null else l_shipdate + interval '1' minute * cast(540 + l_partkey % 41 - 20 as int) end",
    "punch_out_datetime": "case when l_partkey % 47 = 0 then null else l_shipdate + interval '1' minute * cast(1020 + l_orderkey % 61 - 30 as int) end",
    "scheduled_start_datetime": "case when l_returnflag = 'N' then null else l_shipdate + interval '9' hour end",
    "scheduled_end_datetime": "case when l_returnflag = 'N' then null else l_shipdate + interval '17' hour end",
}

REVERSED_PUNCH_OUT = (
    "l_shipdate + interval '1' minute * cast(1020 + l_orderkey % 61 - 30"
    " - case when l_partkey % 70 = 0 then 540 else 0 end as int)"
)


def _punches_sql(punch_out: str = PUNCHES["punch_out_datetime"]) -> str:
    columns = {**PUNCHES, "punch_out_datetime": punch_out}
    listed = ", ".join(f"{text.format(text='varchar')} as {name}" for name, text in columns.items())
    return f"select {listed} from lineitem"


def staged_timesheets(
    spark: SparkSession, folder: str, *, punch_out: str = PUNCHES["punch_out_datetime"]
) -> DataFrame:
    columns = {**PUNCHES, "punch_out_datetime": punch_out}
    return table(spark, folder, "lineitem").select(*[
        F.expr(columns[name].format(text="string")).cast(kind).alias(name) for name, kind in TIMESHEET_FIELDS.items()
    ])


def timesheets(spark: SparkSession, folder: str) -> DataFrame:
    return with_attendance_flags(staged_timesheets(spark, folder), RULES).select(*CURATED_TIMESHEET_FIELDS)


def inconsistent_timesheets(spark: SparkSession, folder: str) -> DataFrame:
    """Some punches end before they begin."""
    staged = staged_timesheets(spark, folder, punch_out=REVERSED_PUNCH_OUT)
    return with_attendance_flags(staged, RULES).select(*CURATED_TIMESHEET_FIELDS)


FLAGS_SQL = """
    case when scheduled_start_datetime is not null and scheduled_end_datetime is not null and punch_in_datetime is not null
        then punch_in_datetime > scheduled_start_datetime + interval 5 minute end as is_late_arrival,
    case when scheduled_start_datetime is not null and scheduled_end_datetime is not null and punch_out_datetime is not null
        then punch_out_datetime < scheduled_end_datetime - interval 5 minute end as is_early_departure,
    case when scheduled_start_datetime is not null and scheduled_end_datetime is not null
            and punch_in_datetime is not null and punch_out_datetime is not null
        then epoch(punch_out_datetime) - epoch(punch_in_datetime)
            > epoch(scheduled_end_datetime) - epoch(scheduled_start_datetime) + 300 end as is_overtime"""


# --- raw text ------------------------------------------------------------------

# Raw punches: null markers, blanks, junk ids, unreadable numbers and dates, two date styles.
RAW_PUNCHES = {
    "client_employee_id": (
        "case when l_partkey % 97 = 0 then 'TEST2' when l_partkey % 89 = 0 then '  '"
        " when l_partkey % 83 = 0 then '1111' when l_partkey % 79 = 0 then '[NULL]'"
        " when l_partkey % 73 = 0 then concat('{tab}', cast(l_suppkey as {text}), ' ')"
        " else cast(l_suppkey as {text}) end"
    ),
    "department_id": "case when l_partkey % 23 = 0 then 'N/A' else cast(l_partkey % 9 as {text}) end",
    "department_name": "case when l_partkey % 19 = 0 then concat('Ward \"', l_returnflag, '\" | ', l_linestatus) else l_linestatus end",
    "home_department_id": "cast(l_suppkey % 9 as {text})",
    "home_department_name": "concat(' H', l_linestatus)",
    "pay_code": "case l_linenumber when 1 then 'Y' when 2 then 'no' when 3 then '1' when 4 then 'FALSE' when 5 then 'maybe' when 6 then 'NULL' else 'n' end",
    "punch_in_comment": "case when l_partkey % 13 = 0 then 'late \"bus\"' end",
    "punch_out_comment": "case when l_partkey % 17 = 0 then 'left | early' end",
    "hours_worked": (
        "case when l_partkey % 61 = 0 then 'abc' when l_partkey % 59 = 0 then '[NULL]'"
        " when l_partkey % 57 = 0 then concat(cast(cast(l_quantity as int) as {text}), '.25')"
        " else cast(cast(l_quantity as int) as {text}) end"
    ),
    "punch_apply_date": (
        "case when l_partkey % 53 = 0 then 'not-a-date' when l_partkey % 11 = 0 then '2001'"
        " when l_partkey % 10 = 0 then {us_date} else cast(cast(l_shipdate as date) as {text}) end"
    ),
    "punch_in_datetime": (
        "case when l_partkey % 53 = 0 then '2001-02-30 09:00:00'"
        " else concat(cast(cast(l_shipdate as date) as {text}), case when l_partkey % 2 = 0 then 'T' else ' ' end, '09:07') end"
    ),
    "punch_out_datetime": "concat(cast(cast(l_shipdate as date) as {text}), ' 17:03:30')",
    "scheduled_start_datetime": "case when l_returnflag = 'N' then 'nan' else concat(cast(cast(l_shipdate as date) as {text}), ' 9:00') end",
    "scheduled_end_datetime": "case when l_returnflag = 'N' then '' else concat(cast(cast(l_shipdate as date) as {text}), ' 17:00') end",
}

_SPARK_WORDS = {"text": "string", "us_date": "date_format(l_shipdate, 'M/d/yyyy')", "tab": "\\t"}
_SQL_WORDS = {"text": "varchar", "us_date": "strftime(l_shipdate, '%-m/%-d/%Y')", "tab": "\t"}


def raw_timesheets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*[
        F.expr(text.format(**_SPARK_WORDS)).alias(name) for name, text in RAW_PUNCHES.items()
    ])


RAW_STAFF = {
    "client_employee_id": "case when o_orderkey % 89 = 0 then '' else concat(' ', cast(o_custkey as {text})) end",
    "first_name": "concat('  ', o_orderpriority, '{tab}')",
    "last_name": "case when o_orderkey % 31 = 0 then '   ' else o_orderstatus end",
    "job_code": "cast(o_orderkey as {text})",
    "hire_date": "case when o_orderkey % 53 = 0 then 'invalid-date' else cast(cast(o_orderdate as date) as {text}) end",
    "term_date": "case when o_orderstatus = 'F' then {us_date} when o_orderkey % 7 = 0 then 'soon' end",
    "years_of_experience": "case when o_orderkey % 29 = 0 then 'many' else cast(o_orderkey % 40 as {text}) end",
    "is_per_deim": (
        "case o_orderkey % 8 when 0 then 'Y' when 1 then 'no' when 2 then '1' when 3 then 'FALSE'"
        " when 4 then 'maybe' when 5 then '' when 6 then ' Yes ' end"
    ),
    "active_status": "'ignored'",
}

_SPARK_STAFF_WORDS = {**_SPARK_WORDS, "us_date": "date_format(o_orderdate, 'M/d/yyyy')"}
_SQL_STAFF_WORDS = {**_SQL_WORDS, "us_date": "strftime(o_orderdate, '%-m/%-d/%Y')"}


def raw_employees(spark: SparkSession, folder: str) -> DataFrame:
    """One raw row per order; the load stamp follows the order date."""
    return table(spark, folder, "orders").select(
        *[F.expr(text.format(**_SPARK_STAFF_WORDS)).alias(name) for name, text in RAW_STAFF.items()],
        F.col("o_orderdate").alias("loaded_at"),
        F.concat(F.lit("file-"), F.col("o_orderkey").cast("string")).alias("source_file"),
    )


# --- SQL views -----------------------------------------------------------------


def _listed(columns: dict[str, str], words: dict[str, str]) -> str:
    return ", ".join(f"{text.format(**words)} as {name}" for name, text in columns.items())


VIEWS = {
    "staff": _staff_sql(),
    "staff_bad": _staff_sql(EARLY_TERM),
    "emp": _curated_employee_sql("staff"),
    "emp_bad": _curated_employee_sql("staff_bad"),
    "punches": _punches_sql(),
    "punches_bad": _punches_sql(REVERSED_PUNCH_OUT),
    "ts": f"select *, {FLAGS_SQL} from punches",
    "ts_bad": f"select *, {FLAGS_SQL} from punches_bad",
    "raw_ts": f"select {_listed(RAW_PUNCHES, _SQL_WORDS)} from lineitem",
    "raw_emp": (
        f"select {_listed(RAW_STAFF, _SQL_STAFF_WORDS)}, o_orderdate as loaded_at,"
        " concat('file-', cast(o_orderkey as varchar)) as source_file from orders"
    ),
}

NEEDS = {
    "emp": ("staff",), "emp_bad": ("staff_bad",), "ts": ("punches",), "ts_bad": ("punches_bad",),
}


def sql(views: str, body: str) -> str:
    """The SQL of a query over some of the views; ``body`` may begin with further ones."""
    names: list[str] = []
    for view in views.split():
        names += [name for name in (*NEEDS.get(view, ()), view) if name not in names]
    listed = ",\n".join(f"{name} as ({VIEWS[name]})" for name in names)
    comma = "" if body.lstrip().lower().startswith("select") else ","
    return f"with {listed}{comma}\n{body.strip()}"


def percent(part: str, whole: str) -> str:
    """A percentage with two digits, rounded half up on whole numbers."""
    return f"((20000 * {part} + {whole}) // (2 * nullif({whole}, 0))) / 100.0"


def mean_hours(hours: str, parts: str) -> str:
    units = f"cast({hours} * 10000 as hugeint)"
    return f"((2 * {units} + 100 * {parts}) // (200 * nullif({parts}, 0))) / 100.0"


def mean_years(days: str, parts: str) -> str:
    return f"((20000 * {days} + 36525 * {parts}) // (2 * 36525 * nullif({parts}, 0))) / 100.0"
