"""Intake queries: the given tables written as delimited files by Spark, then read back."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import without_null_tokens
from shiftledger.plans.clean import clean_employees
from shiftledger.plans.formats import column_formats
from shiftledger.plans.refresh import load_employees, load_raw, load_timesheets, stage_timesheets
from shiftledger.registry import query
from shiftledger.registry.curation import AS_TIMESTAMP, JUNK, STRIPPED_ID
from shiftledger.registry.bridge import RAW_STAFF, RULES, raw_employees, raw_timesheets, sql, table
from shiftledger.schemas import EMPLOYEE_FIELDS, TIMESHEET_FIELDS
from shiftledger.session import new_folder
from shiftledger.sources import Layers, read_delimited

EMPLOYEE_COLUMNS = list(EMPLOYEE_FIELDS)
TIMESHEET_COLUMNS = list(TIMESHEET_FIELDS)

# Null markers that occur in the raw text.
_WITHOUT_MARKERS = "case when {0} not in ('[NULL]', 'NULL', 'N/A', 'nan', '') then {0} end as {0}"


def _read_sql(columns) -> str:
    return ", ".join(_WITHOUT_MARKERS.format(name) for name in columns)


def _write(df: DataFrame, folder: str) -> None:
    (
        df.write.mode("append")
        .option("header", True)
        .option("sep", RULES.delimiter)
        .option("quote", RULES.quote)
        .option("escape", RULES.quote)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def _timesheet_files(spark, sf, label) -> str:
    folder = new_folder(spark, label)
    _write(raw_timesheets(spark, sf), folder)
    return folder


@query("src1_delimited_text", sql("raw_ts", f"select {_read_sql(TIMESHEET_COLUMNS)} from raw_ts"))
def _(spark, sf):
    folder = _timesheet_files(spark, sf, "text")
    return read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows.select(*TIMESHEET_COLUMNS)


_COMMENT = "case when l_partkey % 3 = 0 then concat('first line', chr(10), 'second | \"line\"') else 'one line' end"


@query("src1_quoted_line_breaks", f"""
    select cast(l_suppkey as varchar) as client_employee_id, {_COMMENT} as punch_in_comment,
        cast(l_linenumber as varchar) as pay_code from lineitem""")
def _(spark, sf):
    folder = new_folder(spark, "breaks")
    columns = ["client_employee_id", "punch_in_comment", "pay_code"]
    _write(
        table(spark, sf, "lineitem").select(
            F.col("l_suppkey").cast("string").alias(columns[0]),
            F.expr(_COMMENT).alias(columns[1]),
            F.col("l_linenumber").cast("string").alias(columns[2]),
        ),
        folder,
    )
    return read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows.select(*columns)


@query("src2_employee_folder", sql("raw_emp", f"select {_read_sql(RAW_STAFF)} from raw_emp"))
def _(spark, sf):
    folder = new_folder(spark, "employees")
    raw = raw_employees(spark, sf).select(*RAW_STAFF)
    _write(raw, folder)
    # Files with other endings stay unread.
    raw.select("client_employee_id").write.mode("append").text(folder)
    return read_delimited(spark, folder, EMPLOYEE_COLUMNS, RULES).rows.select(*RAW_STAFF)


@query("src3_timesheet_folder", sql("raw_ts", f"""
    raw as (select {_read_sql(TIMESHEET_COLUMNS)} from raw_ts)
    select pay_code, department_name, count(*) as n, count(hours_worked) as with_hours from raw group by 1, 2"""))
def _(spark, sf):
    folder = _timesheet_files(spark, sf, "timesheets")
    rows = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows
    return rows.groupBy("pay_code", "department_name").agg(
        F.count(F.lit(1)).alias("n"), F.count("hours_worked").alias("with_hours")
    )


@query("src4_nested_prefix", sql("raw_ts", f"select {_read_sql(TIMESHEET_COLUMNS)} from raw_ts"))
def _(spark, sf):
    folder = new_folder(spark, "prefix")
    raw = raw_timesheets(spark, sf)
    late = F.coalesce(F.col("hours_worked") > "3", F.lit(False))
    _write(raw.where(late), f"{folder}/2024/late shift+night")
    _write(raw.where(~late), f"{folder}/2024/early")
    return read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES, recursive=True).rows.select(*TIMESHEET_COLUMNS)


@query("src5_null_markers", sql("raw_ts", f"""
    select department_id as given, case when department_id not in ('N/A', '') then department_id end as kept, count(*) as n
    from raw_ts group by all"""))
def _(spark, sf):
    given = F.col("department_id")
    return raw_timesheets(spark, sf).groupBy(
        given.alias("given"), without_null_tokens(given, RULES.null_tokens).alias("kept")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("src6_source_file", sql("raw_ts", """
    select pay_code, true as is_file_name, count(*) as n from raw_ts where pay_code <> 'NULL' group by 1
    union all select null, true, count(*) from raw_ts where pay_code = 'NULL'"""))
def _(spark, sf):
    folder = _timesheet_files(spark, sf, "names")
    rows = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows
    is_file_name = F.col("source_file").rlike(r"^part-[^/]*\.csv$")
    return rows.groupBy("pay_code", is_file_name.alias("is_file_name")).agg(F.count(F.lit(1)).alias("n"))


@query("src7_load_stamp", sql("raw_ts", """
    select timestamp '2002-01-01 06:30:00' as loaded_at, count(*) as n from raw_ts"""))
def _(spark, sf):
    folder = _timesheet_files(spark, sf, "stamp")
    rows = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows
    return rows.groupBy(F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at")).agg(F.count(F.lit(1)).alias("n"))


@query("src8_refused_files", """
    select l_returnflag as pay_code, count(*) as n from lineitem where l_returnflag <> 'R' group by 1
    union all select 'a line has more fields than the header', null""")
def _(spark, sf):
    """The lines of one return flag have a field more than the header."""
    folder = new_folder(spark, "refused")
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("client_employee_id"), F.col("l_returnflag").alias("pay_code")
    )
    bad = F.col("pay_code") == "R"
    _write(items.where(~bad), folder)
    too_long = items.where(bad).withColumn("pay_code", F.concat("pay_code", F.lit(f"{RULES.delimiter}extra")))
    # Written without quoting, so that the delimiter in the value starts another field.
    unquoted = too_long.write.mode("append").option("header", True).option("sep", RULES.delimiter)
    unquoted.option("quote", "\u0000").csv(folder)
    intake = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES)
    kept = intake.rows.groupBy("pay_code").agg(F.count(F.lit(1)).alias("n"))
    reasons = intake.rejects.select(F.col("reason").alias("pay_code"), F.lit(None).cast("long").alias("n"))
    return kept.unionByName(reasons.distinct())


_SURPLUS = 20_000  # columns beside the known ones


@query("src8_wide_files", """
    select s_suppkey % 3 as kind, cast(s_suppkey as varchar) as client_employee_id from supplier where s_suppkey % 3 <> 1
    union all select 1, 'a line has more fields than the header'""")
def _(spark, sf):
    """A wide good file, a wide file in which one line is too long, and a narrow good file."""
    folder = new_folder(spark, "wide")
    wide = RULES.delimiter.join(["client_employee_id", *(f"c{n}" for n in range(_SURPLUS))])
    people = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), (F.col("s_suppkey") % 3).alias("kind"))
    rest = F.lit(RULES.delimiter * _SURPLUS)
    for kind, header, line in (
        (0, wide, F.concat("id", rest)), (1, wide, F.concat("id", rest, F.lit(f"{RULES.delimiter}x"))),
        (2, "client_employee_id", F.col("id")),
    ):
        lines = people.where(F.col("kind") == kind).select(line.alias("value"))
        spark.createDataFrame([(header,)], "value string").unionByName(lines).coalesce(1).write.mode("append").text(folder)
    found = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES, pattern="*.txt")
    kept = found.rows.select((F.col("client_employee_id").cast("long") % 3).alias("kind"), "client_employee_id")
    return kept.unionByName(found.rejects.select(F.lit(1).cast("long").alias("kind"), F.col("reason").alias("client_employee_id")))


_LONG = "replace(text, chr(10), ' \"\"quoted | \" ')"


@query("src1_long_quoted_fields", f"""
    select cast(doc_id as varchar) as client_employee_id, {_LONG} as punch_in_comment, lang as pay_code from documents""")
def _(spark, sf):
    """Whole documents as quoted comments, with quotes and delimiters where their lines ended."""
    folder = new_folder(spark, "long")
    columns = ["client_employee_id", "punch_in_comment", "pay_code"]
    _write(
        table(spark, sf, "documents").select(
            F.col("doc_id").cast("string").alias(columns[0]), F.expr(_LONG).alias(columns[1]), F.col("lang").alias(columns[2])
        ),
        folder,
    )
    return read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows.select(*columns)


@query("src9_no_matching_files", """
    select l_returnflag as pay_code, count(*) as lines_written, 0 as rows_read from lineitem group by 1""")
def _(spark, sf):
    folder = new_folder(spark, "empty")
    items = table(spark, sf, "lineitem").select("l_returnflag")
    items.write.text(folder)
    read = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows
    found = read.groupBy("pay_code").agg(F.count(F.lit(1)).alias("n"))
    written = items.groupBy(F.col("l_returnflag").alias("pay_code")).agg(F.count(F.lit(1)).alias("lines_written"))
    return written.join(found, "pay_code", "left").select(
        "pay_code", "lines_written", F.coalesce("n", F.lit(0)).alias("rows_read")
    )


@query("src10_columns_by_name", """
    select cast(l_suppkey as varchar) as client_employee_id, cast(l_linenumber as varchar) as pay_code,
        case when l_returnflag = 'A' then null else l_linestatus end as department_name from lineitem""")
def _(spark, sf):
    """Files in three layouts: other order, a missing column, a column the table lacks."""
    folder = new_folder(spark, "layouts")
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("client_employee_id"),
        F.col("l_linenumber").cast("string").alias("pay_code"),
        F.col("l_linestatus").alias("department_name"),
        "l_returnflag",
    )
    layouts = {
        "A": ["client_employee_id", "pay_code"],
        "N": ["department_name", "client_employee_id", "pay_code"],
        "R": ["pay_code", "department_name", "l_returnflag", "client_employee_id"],
    }
    for flag, columns in layouts.items():
        _write(items.where(F.col("l_returnflag") == flag).select(*columns), folder)
    rows = read_delimited(spark, folder, TIMESHEET_COLUMNS, RULES).rows
    return rows.select("client_employee_id", "pay_code", "department_name")


def _loads(spark, sf, mode) -> DataFrame:
    """Two loads of a growing folder: punches of some flags, then those of the others too."""
    folder = new_folder(spark, "growing")
    layers = Layers(spark, new_folder(spark, "raw"))
    raw = raw_timesheets(spark, sf)
    scheduled = F.col("scheduled_start_datetime") != "nan"
    for part in (raw.where(scheduled), raw.where(~scheduled)):
        _write(part, folder)
        load_raw(layers, "raw.timesheet_raw", folder, TIMESHEET_COLUMNS, RULES, mode=mode, recursive=False)
    return layers.read("raw.timesheet_raw").groupBy("home_department_id").agg(F.count(F.lit(1)).alias("n"))


@query("src12_new_files_only", sql("raw_ts", "select home_department_id, count(*) as n from raw_ts group by 1"))
def _(spark, sf):
    return _loads(spark, sf, "new_files")


@query("src12_append_all_files", sql("raw_ts", """
    select home_department_id, cast(sum(case when scheduled_start_datetime <> 'nan' then 2 else 1 end) as bigint) as n
    from raw_ts group by 1"""))
def _(spark, sf):
    return _loads(spark, sf, "append")


@query("src12_resumed_load", sql("raw_ts", f"""
    raw as (select {_read_sql(TIMESHEET_COLUMNS)} from raw_ts),
    typed as (select {STRIPPED_ID} as client_employee_id, {AS_TIMESTAMP.format("punch_in_datetime")} as punch_in,
        {AS_TIMESTAMP.format("punch_out_datetime")} as punch_out from raw)
    select client_employee_id, count(*) as punches from (select distinct * from typed where not {JUNK.format("client_employee_id")})
    group by 1"""))
def _(spark, sf):
    """Runs that stop after raw, after staging and after the curated employees, each resumed by the next."""
    folder, root = new_folder(spark, "resumed"), new_folder(spark, "layers")
    raw = raw_timesheets(spark, sf).withColumn("punch_apply_date", F.substring("punch_out_datetime", 1, 10))
    scheduled = F.col("scheduled_start_datetime") != "nan"
    only = {"only_this_load": True}

    def next_run(part):
        layers = Layers(spark, root)
        if part is not None:
            _write(part, folder)
        load_raw(layers, "raw.timesheet_raw", folder, TIMESHEET_COLUMNS, RULES, mode="new_files", recursive=False)
        return layers

    next_run(raw.where(scheduled))
    stage_timesheets(next_run(raw.where(~scheduled)), RULES, **only)
    layers = next_run(None)
    stage_timesheets(layers, RULES, **only)
    load_employees(layers, RULES)
    layers = next_run(None)
    if stage_timesheets(layers, RULES, **only):
        load_timesheets(layers, RULES)
    if stage_timesheets(next_run(None), RULES, **only):
        raise RuntimeError("a load that is curated is still pending")
    return layers.read("curated.timesheet").groupBy("client_employee_id").agg(F.count(F.lit(1)).alias("punches"))


@query("src12_same_name_in_folders", """
    select l_linestatus || '/punches.csv' as source, count(*) as n from lineitem group by 1""")
def _(spark, sf):
    """Files of one name in several folders are different files."""
    folder = new_folder(spark, "folders")
    layers = Layers(spark, new_folder(spark, "raw"))
    items = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("client_employee_id"), "l_linestatus")
    for row in items.select("l_linestatus").distinct().orderBy("l_linestatus").collect():
        _write(items.where(F.col("l_linestatus") == row["l_linestatus"]).drop("l_linestatus"), f"{folder}/{row['l_linestatus']}/punches.csv")
        load_raw(layers, "raw.timesheet_raw", folder, TIMESHEET_COLUMNS, RULES, mode="new_files", recursive=True)
    parts = F.split("source_path", "/")
    rows = layers.read("raw.timesheet_raw").withColumn("source", F.concat_ws("/", F.element_at(parts, -3), F.element_at(parts, -2)))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


_DAYS = {0: "d/M/yyyy", 1: "M/d/yyyy", 2: "yyyy-MM-dd"}


def _dated_files(spark, sf) -> Layers:
    """Employees in three files, each with another way to write dates; the end dates are of the first days of a month."""
    folder, layers = new_folder(spark, "dated"), Layers(spark, new_folder(spark, "layers"))
    orders = table(spark, sf, "orders")
    for part, shape in _DAYS.items():
        early = F.date_add(F.trunc("o_orderdate", "MM"), (F.col("o_orderkey") % 12).cast("int"))
        _write(
            orders.where(F.col("o_orderkey") % 3 == part).select(
                F.col("o_orderkey").cast("string").alias("client_employee_id"), F.date_format("o_orderdate", shape).alias("hire_date"),
                F.date_format(early, shape).alias("term_date"), F.lit(str(part)).alias("first_name"),
            ).coalesce(1),
            folder,
        )
    load_raw(layers, "raw.employee_raw", folder, EMPLOYEE_COLUMNS, RULES, mode="append", recursive=False)
    return layers


@query("cln2_format_by_file", """
    select cast(o_orderkey as varchar) as client_employee_id, cast(o_orderdate as date) as hire_date from orders""")
def _(spark, sf):
    people = clean_employees(_dated_files(spark, sf).read("raw.employee_raw"), RULES)
    return people.select("client_employee_id", "hire_date")


@query("cln2_ambiguous_columns", """
    select cast(o_orderkey % 3 as varchar) as file, name as "column", count(*) as texts,
        o_orderkey % 3 < 2 and name = 'term_date' as ambiguous,
        case when o_orderkey % 3 = 2 then 'not slashed' when o_orderkey % 3 = 0 and name = 'hire_date' then 'day first'
            else 'month first' end as format
    from orders, (values ('hire_date'), ('term_date')) as names(name) group by all""")
def _(spark, sf):
    raw = _dated_files(spark, sf).read("raw.employee_raw")
    told = column_formats(raw, EMPLOYEE_FIELDS).where(F.col("texts") > 0)
    files = raw.select("source_path", F.col("first_name").alias("file")).distinct()
    return told.join(files, "source_path").select("file", "column", "texts", "ambiguous", "format")
