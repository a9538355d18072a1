"""Which way round a file writes its dates, told from whole columns.

``03/04/2024`` is read month first. A file whose column also holds ``13/04/2024`` and no second number above 12
means days first, so all of that column is read so, in that file alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions import strip_text

FILE = "source_path"
DAY_FIRST = "_day_first"
SLASHED = r"^\s*(\d{1,2})/(\d{1,2})/\d"


def date_columns(raw: DataFrame, fields: dict[str, T.DataType]) -> list[str]:
    return [n for n, kind in fields.items() if isinstance(kind, (T.DateType, T.TimestampNTZType)) and n in raw.columns]


def column_formats(raw: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    """(source_path, column, texts, slashed, format, ambiguous) per file and date column, in one pass.

    ``format`` is ``day first``, ``month first``, ``mixed`` (no way round reads all of the column, so each cell is read month
    first or not at all) or ``not slashed``. ``ambiguous`` columns could be read either way round: no number is above 12.
    """
    names = date_columns(raw, fields)

    def number(name: str, place: int) -> Column:
        text = F.col(name)
        return F.when(F.contains(text, F.lit("/")), F.regexp_extract(text, SLASHED, place)).try_cast("int")

    per_file = raw.groupBy(FILE).agg(*[
        F.struct(
            F.lit(n).alias("column"), F.count(strip_text(F.col(n))).alias("texts"), F.count(number(n, 1)).alias("slashed"),
            F.max(number(n, 1)).alias("first"), F.max(number(n, 2)).alias("second"),
        ).alias(n)
        for n in names
    ])
    each = per_file.select(FILE, F.explode(F.array(*names)).alias("one")).select(FILE, "one.*")
    first, second = F.col("first") > 12, F.col("second") > 12
    return each.select(
        FILE, "column", "texts", "slashed",
        F.when(F.col("slashed") == 0, "not slashed").when(first & second, "mixed").when(first, "day first").otherwise("month first")
        .alias("format"),
        ((F.col("slashed") > 0) & ~first & ~second).alias("ambiguous"),
    )


def with_day_first(rows: DataFrame, raw: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    """``rows`` with the date columns that their file writes day first; ``raw`` has all rows of these files.

    Rows without a file are left as they are. What is broadcast has a row for some of the files, whose listing
    the driver held at intake.
    """
    if FILE not in raw.columns or not date_columns(raw, fields):
        return rows
    turned = column_formats(raw, fields).where(F.col("format") == "day first")
    by_file = turned.groupBy(FILE).agg(F.collect_set("column").alias(DAY_FIRST))
    return rows.join(F.broadcast(by_file), FILE, "left")


def month_first(text: Column, name: str) -> Column:
    """The text with day and month changed over if its file writes the column day first."""
    turned = F.regexp_replace(text, r"^(\s*)(\d{1,2})/(\d{1,2})(?=/)", "$1$3/$2")
    return F.when(F.array_contains(F.col(DAY_FIRST), name), turned).otherwise(text)
