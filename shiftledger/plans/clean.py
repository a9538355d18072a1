"""Raw text rows to typed staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions import (
    is_junk_id,
    parse_date,
    parse_flag,
    parse_number,
    parse_timestamp,
    strip_text,
)
from shiftledger.operators import first_per_key, missing_keys
from shiftledger.plans.formats import DAY_FIRST, month_first, with_day_first
from shiftledger.rules import Rules
from shiftledger.schemas import EMPLOYEE_FIELDS, LINEAGE_FIELDS, TIMESHEET_FIELDS

ID = "client_employee_id"

_PARSERS = {
    T.StringType(): strip_text,
    T.DateType(): parse_date,
    T.TimestampNTZType(): parse_timestamp,
    T.BooleanType(): parse_flag,
}


def typed(raw: DataFrame, fields: dict[str, T.DataType], formats: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """The listed columns parsed by type (dates and times also by ``formats``), and the lineage columns that are there.

    A column the input lacks becomes a typed NULL. Columns that ``with_day_first`` found are read day first.
    """

    def parsed(name: str, kind: T.DataType) -> Column:
        if name not in raw.columns:
            return F.lit(None).cast(kind).alias(name)
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            text = month_first(F.col(name), name) if DAY_FIRST in raw.columns else F.col(name)
            return _PARSERS[kind](text, formats).alias(name)
        return _PARSERS.get(kind, parse_number)(F.col(name)).alias(name)

    lineage = [F.col(name) for name in LINEAGE_FIELDS if name in raw.columns]
    return raw.select(*[parsed(name, kind) for name, kind in fields.items()], *lineage)


def newest_first(df: DataFrame) -> list[Column]:
    """Latest load, in it the last file by name and then by path, in that the first row."""
    order = {
        "loaded_at": F.desc("loaded_at"),
        "source_file": F.desc("source_file"),
        "source_path": F.desc("source_path"),
        "source_offset": F.asc("source_offset"),
        "source_row": F.asc("source_row"),
    }
    return [column for name, column in order.items() if name in df.columns]


def arrival_order(df: DataFrame) -> list[Column]:
    """The order in which loads appended the rows."""
    names = ("loaded_at", "source_file", "source_path", "source_offset", "source_row")
    return [F.asc(name) for name in names if name in df.columns]


def clean_employees(raw: DataFrame, rules: Rules) -> DataFrame:
    """Typed employees, one row per id, the most recently loaded.

    ``active_status`` follows from the parsed end date, whatever the file says.
    Only the rows kept are parsed, dates the way round that the whole column of their file tells.
    """
    rows = raw.withColumn(ID, strip_text(F.col(ID))).where(F.col(ID).isNotNull())
    latest = first_per_key(rows, [ID], newest_first(rows))
    kept = typed(with_day_first(latest, raw, EMPLOYEE_FIELDS), EMPLOYEE_FIELDS, rules.date_formats)
    return kept.withColumn("active_status", F.col("term_date").isNull()).select(*EMPLOYEE_FIELDS)


def clean_timesheets(raw: DataFrame, rules: Rules) -> DataFrame:
    """Typed timesheet rows with a usable employee id.

    The ids are judged as they came: a filter on parsed columns would parse them twice. Dates are read the way round that
    the whole column of their file tells.
    """
    rows = raw.where(~is_junk_id(F.col(ID), rules.junk_ids))
    return typed(with_day_first(rows, raw, TIMESHEET_FIELDS), TIMESHEET_FIELDS, rules.date_formats)


def unreadable_texts(raw: DataFrame, fields: dict[str, T.DataType], rules: Rules) -> DataFrame:
    """:func:`unreadable` of raw rows, each read as the cleaning reads it."""
    return unreadable(raw, typed(with_day_first(raw, raw, fields), fields, rules.date_formats), fields)


def unreadable(raw: DataFrame, parsed: DataFrame, fields: dict[str, T.DataType], key: str = ID) -> DataFrame:
    """(column, texts, values): per typed column the texts given and the values read from them.

    ``raw`` and ``parsed`` have the same rows; texts without a value became NULL.
    """
    names = [n for n, kind in fields.items() if not isinstance(kind, T.StringType) and n in raw.columns and n != key]
    given = raw.agg(*[F.count(strip_text(F.col(n))).alias(n) for n in names])
    read = parsed.agg(*[F.count(n).alias(n) for n in names])
    listed = lambda frame, label: frame.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(n).alias(label)) for n in names
    ])).alias("one")).select("one.*")
    return listed(given, "texts").join(listed(read, "values"), "column")


def junk_summary(raw: DataFrame, rules: Rules) -> DataFrame:
    """(client_employee_id, rows) of what :func:`clean_timesheets` leaves out, sorted.

    Rows without an id form the NULL group.
    """
    ids = raw.select(strip_text(F.col(ID)).alias(ID))
    return (
        ids.where(is_junk_id(F.col(ID), rules.junk_ids))
        .groupBy(ID)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.asc_nulls_last(ID))
    )


def placeholders(timesheets: DataFrame, employees: DataFrame) -> DataFrame:
    """An employee named Unknown for every timesheet id without an employee."""
    known = {
        "first_name": F.lit("Unknown"),
        "last_name": F.lit("Unknown"),
    }
    return missing_keys(timesheets, employees, ID).select(
        ID,
        *[
            known.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in EMPLOYEE_FIELDS.items()
            if name != ID
        ],
    )
