from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftledger.plans import attendance, clean, curate, headcount, hours, lookup, people, quality
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE_FIELDS, CURATED_TIMESHEET_FIELDS, TIMESHEET_FIELDS, struct

RULES = Rules(as_of=date(2024, 5, 1))


def employees(spark, *given):
    kinds = CURATED_EMPLOYEE_FIELDS
    full = [tuple({**dict.fromkeys(kinds), "is_placeholder": False, **row}.values()) for row in given]
    return spark.createDataFrame(full, struct(kinds))


def punches(spark, *given, kinds=CURATED_TIMESHEET_FIELDS):
    full = []
    for row in given:
        hours_worked = row.get("hours_worked")
        exact = {"hours_worked": None if hours_worked is None else Decimal(hours_worked)}
        full.append(tuple({**dict.fromkeys(kinds), **row, **exact}.values()))
    return spark.createDataFrame(full, struct(kinds))


def rows(df):
    return [tuple(row) for row in df.collect()]


def at(clock, day="2026-01-01"):
    return datetime.fromisoformat(f"{day} {clock}") if clock else None


# --- cleaning and curation -------------------------------------------------------------


def test_clean_employees(spark):
    raw = spark.createDataFrame([
        ("E001", " Alice ", "Smith", "2020-01-15", None, datetime(2026, 1, 2)),
        ("E001", " Alice", "Smith", "2020-01-15", None, datetime(2026, 1, 1)),
        ("E002", "Bob", "Jones", "invalid-date", None, datetime(2026, 1, 1)),
        ("  ", "No", "Id", None, None, datetime(2026, 1, 1)),
    ], "client_employee_id string, first_name string, last_name string, hire_date string, term_date string, loaded_at timestamp")
    cleaned = clean.clean_employees(raw, RULES).orderBy("client_employee_id")
    assert rows(cleaned.select("client_employee_id", "first_name", "hire_date", "active_status")) == [
        ("E001", "Alice", date(2020, 1, 15), True), ("E002", "Bob", None, True),
    ]


def test_later_file_of_a_load_wins_then_the_first_row(spark):
    raw = spark.createDataFrame(
        [("E1", name, datetime(2026, 1, 1), file, 0, row) for name, file, row in
         [("a", "x.csv", 0), ("b", "y.csv", 7), ("c", "y.csv", 8)]],
        "client_employee_id string, first_name string, loaded_at timestamp, source_file string, source_offset long, source_row long",
    )
    assert clean.clean_employees(raw, RULES).first()["first_name"] == "b"


def test_first_arrival_of_a_punch_stays(spark):
    staged = punches(spark, *[{"client_employee_id": "E1", "pay_code": code} for code in ("late", "early")], kinds=TIMESHEET_FIELDS)
    order = F.when(F.col("pay_code") == "late", 9).otherwise(1)
    staged = staged.withColumns({"source_file": F.lit("f"), "source_offset": order, "source_row": F.lit(0)})
    assert curate.dedup_timesheets(staged).first()["pay_code"] == "early"


@pytest.mark.parametrize("punch, expected", [
    (("09:00", "17:00", "09:06", "17:00"), (True, False, False)),
    (("09:00", "17:00", "08:55", "16:50"), (False, True, False)),
    (("09:00", "17:00", "09:05", "16:55"), (False, False, False)),
    (("09:00", "17:00", "09:00", "17:06"), (False, False, True)),
    (("09:00", "17:00", "09:00", "17:05"), (False, False, False)),
    (("09:00", "17:00", None, "16:00"), (None, True, None)),
    (("09:00", "17:00", "09:30", None), (True, None, None)),
    ((None, None, "09:00", "17:00"), (None, None, None)),
    (("09:00", None, "09:30", "17:00"), (None, None, None)),
])
def test_attendance_flags(spark, punch, expected):
    names = ("scheduled_start_datetime", "scheduled_end_datetime", "punch_in_datetime", "punch_out_datetime")
    staged = punches(spark, {"client_employee_id": "E1", **dict(zip(names, map(at, punch)))}, kinds=TIMESHEET_FIELDS)
    flagged = curate.curate_timesheets(staged, RULES)
    assert rows(flagged.select("is_late_arrival", "is_early_departure", "is_overtime")) == [expected]


@pytest.mark.parametrize("names, expected", [
    (("John", None, "Doe"), "John Doe"), (("John", "M", "Doe"), "John M Doe"), ((None, None, "Doe"), "Doe"),
    ((None, None, None), None), (("", "", "Doe"), "Doe"),
])
def test_full_name(spark, names, expected):
    frame = spark.createDataFrame([names], "first_name string, middle_name string, last_name string")
    assert frame.select(curate.full_name()).first()[0] == expected


# --- headcount and turnover ------------------------------------------------------------

STAFF = [
    {"client_employee_id": "1", "hire_date": date(2023, 1, 31), "term_date": None, "department_name": "A"},
    {"client_employee_id": "2", "hire_date": date(2023, 2, 1), "term_date": date(2023, 4, 30), "department_name": "B"},
    {"client_employee_id": "3", "hire_date": date(2023, 6, 10), "term_date": date(2023, 6, 1), "department_name": "A"},
    {"client_employee_id": "4", "hire_date": None, "term_date": date(2022, 12, 1), "department_name": None},
    {"client_employee_id": "5", "hire_date": date(2023, 9, 1), "term_date": date(2023, 9, 1), "department_name": "B"},
    {"client_employee_id": "6", "hire_date": date(2030, 1, 1), "term_date": None, "department_name": "B"},
    {"client_employee_id": "7", "hire_date": date(2023, 3, 3), "term_date": None, "is_placeholder": True},
]


def month_end(day):
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def counted(day, department=None):
    return sum(
        1 for row in STAFF
        if not row.get("is_placeholder") and row["hire_date"] and row["hire_date"] <= day
        and (row["term_date"] is None or row["term_date"] > day)
        and department in (None, row["department_name"])
    )


def month_ends(first, last):
    found, day = [], month_end(first)
    while day <= month_end(last):
        found.append(day)
        day = month_end(day + timedelta(days=1))
    return found


@pytest.mark.parametrize("start, end, department", [
    (None, None, None), (None, None, "B"), (None, None, "nobody"), (date(2023, 3, 15), None, None),
    (date(2022, 5, 1), date(2023, 5, 2), "B"), (date(2023, 12, 1), date(2023, 6, 1), None), (None, date(2022, 1, 1), None),
])
def test_headcount_equals_range_predicate(spark, start, end, department):
    found = rows(headcount.headcount(
        employees(spark, *STAFF), as_of=RULES.as_of, start=start, end=end, department=department
    ))
    dates = month_ends(start or date(2023, 1, 31), end or RULES.as_of)
    assert found == [(day, counted(day, department)) for day in dates]


def test_daily_headcount(spark):
    end = date(2023, 10, 2)
    found = rows(headcount.headcount(employees(spark, *STAFF), as_of=end, grain="day"))
    days = [date(2023, 1, 31) + timedelta(days=n) for n in range((end - date(2023, 1, 31)).days + 1)]
    assert found == [(day, counted(day)) for day in days]


def test_headcount_of_nobody(spark):
    nobody = employees(spark)
    assert rows(headcount.headcount(nobody, as_of=RULES.as_of)) == []
    assert rows(headcount.headcount(nobody, as_of=date(2023, 2, 1), start=date(2023, 1, 1))) == [
        (date(2023, 1, 31), 0), (date(2023, 2, 28), 0),
    ]
    assert rows(headcount.turnover_rate(nobody, as_of=RULES.as_of)) == []
    assert rows(people.turnover_series(nobody)) == []


def test_turnover_rate(spark):
    found = rows(headcount.turnover_rate(employees(spark, *STAFF), as_of=RULES.as_of))
    terms = [row["term_date"] for row in STAFF if row["term_date"] and not row.get("is_placeholder")]
    expected = []
    for day in month_ends(date(2023, 1, 31), RULES.as_of):
        left, heads = sum(month_end(term) == day for term in terms), counted(day)
        expected.append((day, heads, left, round(100 * left / heads, 2) if heads else None))
    assert found == expected
    assert (date(2023, 4, 30), 1, 1, 100.0) in found


def test_rate_is_null_when_nobody_is_left(spark):
    gone = employees(spark, {"client_employee_id": "1", "hire_date": date(2024, 1, 2), "term_date": date(2024, 2, 2)})
    found = rows(headcount.turnover_rate(gone, as_of=date(2024, 3, 1)))
    assert found == [(date(2024, 1, 31), 1, 0, 0.0), (date(2024, 2, 29), 0, 1, None), (date(2024, 3, 31), 0, 0, None)]


def test_no_join_or_python_in_headcount_plans(spark):
    for frame in (
        headcount.headcount(employees(spark, *STAFF), as_of=RULES.as_of),
        headcount.turnover_rate(employees(spark, *STAFF), as_of=RULES.as_of),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Cartesian" not in plan and "Python" not in plan


# --- other KPIs ------------------------------------------------------------------------


def test_tenure_puts_missing_department_in_its_own_group(spark):
    staff = employees(
        spark,
        {"client_employee_id": "1", "department_name": "12-Long name of a ward that goes on", "tenure_days": 731, "active_status": True},
        {"client_employee_id": "2", "department_name": None, "tenure_days": 100, "active_status": False},
        {"client_employee_id": "3", "department_name": None, "tenure_days": None},
    )
    assert rows(people.tenure_by_department(staff)) == [
        ("12-Long name of a ward that goes on", 1, 2.0), (None, 1, 0.27),
    ]
    assert rows(people.tenure_by_status(staff))[1] == (None, 0, None, 1, 0.27)
    assert rows(people.tenure_leaders(staff))[0][1] == "Long name of a ward that goe…"


def test_rolling_hours_skip_days_without_work(spark):
    days = [date(2024, 1, 1) + timedelta(days=3 * n) for n in range(40)]
    sheet = punches(spark, *[
        {"client_employee_id": "E1", "punch_apply_date": day, "hours_worked": n} for n, day in enumerate(days)
    ], {"client_employee_id": "E2", "punch_apply_date": days[0], "hours_worked": None})
    history = rows(hours.rolling_hours(sheet).select("punch_apply_date", "rolling_avg_hours_7day", "rolling_avg_hours_30day"))
    for n, (day, week, month) in enumerate(history):
        assert (day, week, month) == (days[n], round(sum(range(max(0, n - 6), n + 1)) / min(7, n + 1), 2),
                                      round(sum(range(max(0, n - 29), n + 1)) / min(30, n + 1), 2))
    assert rows(hours.rolling_snapshot(sheet)) == [("E1", *history[-1])]


def test_rolling_history_is_ordered_by_one_exchange_for_window_and_sort(spark):
    sheet = punches(spark, {"client_employee_id": "E1", "punch_apply_date": date(2024, 1, 1), "hours_worked": 1})
    plan = hours.rolling_hours(sheet)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "rangepartitioning(client_employee_id" in plan


def test_hours_average_per_punch_and_per_week(spark):
    sheet = punches(
        spark,
        {"client_employee_id": "E1", "punch_apply_date": date(2024, 1, 7), "hours_worked": 4},
        {"client_employee_id": "E1", "punch_apply_date": date(2024, 1, 8), "hours_worked": 3},
        {"client_employee_id": "E1", "punch_apply_date": date(2024, 1, 8), "hours_worked": 6},
    )
    assert rows(hours.hours_per_day_by_employee(sheet)) == [("E1", 2, 4.33)]
    assert rows(hours.hours_per_week_by_employee(sheet)) == [("E1", 2, 6.5)]
    assert rows(hours.hours_summary(sheet, end=date(2024, 1, 7))) == [(4.0, 4.0)]
    assert rows(hours.hours_summary(sheet, employee_id="E2")) == [(None, None)]


def test_attendance_on_no_rows(spark):
    assert rows(attendance.summary(punches(spark))) == [(None, None, None)]
    assert rows(attendance.by_employee(punches(spark), "overtime")) == []


def test_lookup_limits(spark):
    staff = employees(spark, *STAFF)
    assert [row[0] for row in rows(lookup.list_employees(staff, limit=2, offset=1))] == ["2", "3"]
    assert rows(lookup.departments(staff)) == [("A",), ("B",)]
    with pytest.raises(ValueError):
        lookup.list_employees(staff, limit=-1)
    with pytest.raises(ValueError):
        lookup.search_employees(staff, limit=-1)


def test_pages_joined_are_the_whole_list(spark):
    staff = employees(spark, *STAFF)
    ids = [row[0] for row in rows(lookup.list_employees(staff, limit=None))]
    assert [row[0] for row in rows(lookup.list_employees(staff, after=ids[0], limit=None))] == ids[1:]
    sheet = punches(spark, *[
        {"client_employee_id": who, "punch_apply_date": day, "punch_in_datetime": at, "pay_code": code}
        for who in (None, "E1", "E2") for day in (None, date(2024, 1, 1), date(2024, 2, 9))
        for at in (None, datetime(2024, 1, 1, 8)) for code in (None, "REG", "REG")
    ])
    whole = lookup.list_timesheets(sheet, limit=None).collect()
    for size in (1, 4, 7):
        pages, page = [], lookup.list_timesheets(sheet, limit=size).collect()
        while page:
            pages += page
            page = lookup.list_timesheets(sheet, after=page[-1], seen=pages.count(page[-1]), limit=size).collect()
        assert pages == whole
        if size == 7:  # without copies nothing is skipped by number
            once = sheet.distinct()
            first = lookup.list_timesheets(once, limit=size).collect()
            assert first + lookup.list_timesheets(once, after=first[-1], limit=None).collect() == lookup.list_timesheets(once, limit=None).collect()


def test_a_page_has_no_offset_in_its_plan(spark, capsys):
    sheet = punches(spark, {"client_employee_id": "E1", "punch_apply_date": date(2024, 1, 1)})
    lookup.list_timesheets(sheet, after=sheet.first(), limit=5).explain(True)
    plan = capsys.readouterr().out
    assert "Offset" not in plan and "offset=" not in plan and "<= 2024-01-01" in plan


# --- checks ----------------------------------------------------------------------------


def test_checks_on_empty_tables(spark):
    found = {row["check_name"]: (row["passed"], row["metric_value"])
             for row in quality.check_metrics(employees(spark), punches(spark), RULES).collect()}
    assert found.pop(quality.MISSING_SCHEDULE) == (False, None)
    assert found.pop(quality.PLACEHOLDERS) == (False, None)
    assert set(found.values()) == {(True, 0.0)}


def test_checks_with_findings_and_gate(spark):
    staff = employees(
        spark,
        {"client_employee_id": "1", "hire_date": date(2024, 1, 2), "term_date": date(2024, 1, 1)},
        {"client_employee_id": "1", "hire_date": None, "first_name": "Ann"},
    )
    sheet = punches(
        spark,
        {"client_employee_id": "9", "punch_in_datetime": at("10:00"), "punch_out_datetime": at("09:00")},
        {"client_employee_id": None},
    )
    results = quality.run_checks(staff, sheet, RULES)
    found = {row["check_name"]: (row["passed"], row["metric_value"], row["details"]) for row in results.collect()}
    assert found == {
        quality.DUPLICATE_IDS: (False, 1.0, "1: 2 duplicates"),
        quality.ORPHANS: (False, 2.0, "None; 9: 1 orphan rows"),
        quality.TERM_BEFORE_HIRE: (False, 1.0, "1: hired 2024-01-02 term 2024-01-01"),
        quality.PUNCH_ORDER: (False, 1.0, "9: in=2026-01-01 10:00:00 out=2026-01-01 09:00:00"),
        quality.NO_HIRE_DATE: (False, 1.0, "1: Ann ?"),
        quality.MISSING_SCHEDULE: (False, 100.0, None),
        quality.PLACEHOLDERS: (True, 0.0, None),
    }
    with pytest.raises(quality.QualityGateError, match=quality.ORPHANS):
        quality.gate(results)
    quality.gate(results.where(F.col("severity") == "warning"))
