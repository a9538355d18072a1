from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftledger.functions import (
    is_junk_id,
    parse_date,
    parse_flag,
    parse_number,
    parse_timestamp,
    percentage,
    rounded_ratio,
    strip_text,
    without_null_tokens,
)
from shiftledger.plans.clean import typed, unreadable
from shiftledger.rules import DATE_FORMATS, KNOWN_JUNK_IDS, READER_NULL_TOKENS, Rules
from shiftledger.schemas import TIMESHEET_FIELDS


def evaluate(spark, values, function, kind="string"):
    rows = spark.createDataFrame([(at, value) for at, value in enumerate(values)], f"place int, value {kind}")
    return [row["out"] for row in rows.select("place", function(F.col("value")).alias("out")).orderBy("place").collect()]


def test_junk_ids(spark):
    junk = ["999999", "TEST2", "CMCRN-3", "1111", None, " 999951 ", "  ", "\t22222\n"]
    usable = ["101075-101012", "00025", "12345", "00457", "111", "TEST", "TEST22", "1112"]
    assert evaluate(spark, junk, lambda c: is_junk_id(c, KNOWN_JUNK_IDS)) == [True] * len(junk)
    assert evaluate(spark, usable, lambda c: is_junk_id(c, KNOWN_JUNK_IDS)) == [False] * len(usable)


def test_flags(spark):
    texts = ["1", "true", "yes", "y", " YES ", "0", "false", "no", "n", "No", "", None, "maybe", "t", "f"]
    assert evaluate(spark, texts, parse_flag) == [True] * 5 + [False] * 5 + [None] * 5


def test_strip(spark):
    texts = [" Alice ", "\t\n x y \x0b", " em ", "   ", "", None]
    assert evaluate(spark, texts, strip_text) == ["Alice", "x y", "em", None, None, None]


def test_null_tokens(spark):
    texts = ["[NULL]", "", "NULL", "N/A", "nan", "None", "none", " NULL", "x", None]
    tokens = Rules(as_of=date(2024, 1, 1)).null_tokens
    assert evaluate(spark, texts, lambda c: without_null_tokens(c, tokens)) == [None] * 6 + ["none", " NULL", "x", None]
    assert "[NULL]" not in READER_NULL_TOKENS


def test_timestamps(spark):
    texts = [
        "2020-01-15 09:06:07", "2020-1-5 9:06", "2020-01-15T09:06:01.5", "2020-01-15", " 2020-01-15 ",
        "1/5/2020", "01/05/2020 9:06", "1/5/2020 23:59:59",
        "2020", "2020-02-30", "2020-01-15 25:00", "13/13/2020", "invalid-date", "2020-01-15 09:06:07Z", "", None,
    ]
    assert evaluate(spark, texts, parse_timestamp) == [
        datetime(2020, 1, 15, 9, 6, 7), datetime(2020, 1, 5, 9, 6), datetime(2020, 1, 15, 9, 6, 1, 500000),
        datetime(2020, 1, 15), datetime(2020, 1, 15),
        datetime(2020, 1, 5), datetime(2020, 1, 5, 9, 6), datetime(2020, 1, 5, 23, 59, 59),
    ] + [None] * 8


def test_timestamps_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        gap = evaluate(spark, ["2020-03-08 02:30:00"], parse_timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert gap == [datetime(2020, 3, 8, 2, 30)]


def test_dates(spark):
    assert evaluate(spark, ["2020-01-15 09:06", "1/5/2020", "bad"], parse_date) == [date(2020, 1, 15), date(2020, 1, 5), None]


def test_numbers(spark):
    texts = ["8", " 7.25 ", "-1.00005", "1e2", "abc", "1d", "inf", "", None]
    assert evaluate(spark, texts, parse_number) == [
        Decimal("8.0000"), Decimal("7.2500"), Decimal("-1.0001"), Decimal("100.0000"), None, None, None, None, None,
    ]


@pytest.mark.parametrize("total, parts, expected", [
    (1, 8, 0.13), (1005, 1000, 1.01), (-1005, 1000, -1.01), (2, 3, 0.67), (0, 5, 0.0), (5, 0, None),
])
def test_rounded_ratio(spark, total, parts, expected):
    row = spark.range(1).select(rounded_ratio(F.lit(total), F.lit(parts)).alias("out")).first()
    assert row["out"] == expected


def test_percentage(spark):
    row = spark.range(1).select(percentage(F.lit(1), F.lit(3)).alias("a"), percentage(F.lit(1), F.lit(0)).alias("b")).first()
    assert (row["a"], row["b"]) == (33.33, None)


def test_rules_from_config():
    config = {
        "file_format": {"delimiter": ";", "quote_char": "'", "null_values": ["-"], "encoding": "latin-1"},
        "business_rules": {"grace_period_minutes": 7},
        "quality_checks": {"placeholder_ratio_percentage_threshold": 60},
    }
    rules = Rules.from_config(config, date(2024, 1, 1))
    assert (rules.delimiter, rules.quote, rules.encoding, rules.grace_minutes) == (";", "'", "latin-1", 7)
    assert rules.placeholder_limit == 60 and rules.missing_schedule_limit == 10
    assert "-" in rules.null_tokens and "[NULL]" not in rules.null_tokens
    assert Rules(as_of=date(2024, 1, 1)).grace_minutes == 5


def test_other_date_formats(spark):
    cases = {
        "01/15/2024 08:05 AM": datetime(2024, 1, 15, 8, 5), "2024-01-15T08:00:00Z": datetime(2024, 1, 15, 8),
        "2024-01-15 08:00:00+00:00": datetime(2024, 1, 15, 8), "20240115": datetime(2024, 1, 15),
        "15-Jan-2024": datetime(2024, 1, 15), "1/5/24": datetime(2024, 1, 5), "1/5/70": datetime(1970, 1, 5),
        "2024-01-15 08:00:00-0530": datetime(2024, 1, 15, 13, 30), "January 5, 2024 12:05 am": datetime(2024, 1, 5, 0, 5),
        "20240115T235959": datetime(2024, 1, 15, 23, 59, 59), " 5 May 2024 ": datetime(2024, 5, 5), "2024": None,
        "13/45/2024": None, "2024-02-30 9:00": None, "15-Foo-2024": None, "2024-01-15 13:00 PM": None, "": None, None: None,
        "2024-1-5 7:05": datetime(2024, 1, 5, 7, 5),
    }
    assert evaluate(spark, list(cases), lambda c: parse_timestamp(c, DATE_FORMATS)) == list(cases.values())
    days = [value and value.date() for value in cases.values()]
    assert evaluate(spark, list(cases), lambda c: parse_date(c, DATE_FORMATS)) == days
    own = ((r"(\d{2})\.(\d{2})\.(\d{4})", "$3-$2-$1"),)
    assert evaluate(spark, ["15.01.2024", "20240115"], lambda c: parse_date(c, own)) == [date(2024, 1, 15), None]


def test_unreadable_texts_are_counted(spark):
    raw = spark.createDataFrame(
        [("1", "8", "2024-01-02"), ("2", "x", "soon"), ("3", " ", None)], "client_employee_id string, hours_worked string, punch_apply_date string"
    )
    found = unreadable(raw, typed(raw, TIMESHEET_FIELDS, DATE_FORMATS), TIMESHEET_FIELDS).collect()
    assert {tuple(row) for row in found} == {("hours_worked", 2, 1), ("punch_apply_date", 2, 1)}
