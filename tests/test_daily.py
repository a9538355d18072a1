"""Daily sums kept beside the punches."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftledger.plans import attendance, daily, hours
from shiftledger.schemas import CURATED_TIMESHEET
from shiftledger.session import new_folder
from shiftledger.sources import Layers


def punches(spark, *given):
    """(employee, day, hour of the punch, hours, late)"""
    made = [
        tuple({
            "client_employee_id": who, "punch_apply_date": day, "punch_in_datetime": at and datetime(2024, 1, 1, at),
            "hours_worked": None if worked is None else Decimal(worked), "is_late_arrival": late,
        }.get(name) for name in CURATED_TIMESHEET.fieldNames())
        for who, day, at, worked, late in given
    ]
    return spark.createDataFrame(made, CURATED_TIMESHEET)


ONE, TWO = date(2024, 1, 1), date(2024, 2, 9)
FIRST = [("E1", ONE, 8, "4.5", True), ("E1", ONE, 13, "3.25", False), ("E2", TWO, 8, None, None), ("E9", ONE, 8, "2", True)]
SECOND = [("E1", ONE, 18, "1.3333", True), ("E2", TWO, 9, "8", False), ("E2", TWO, 10, "7", None), ("E3", TWO, None, None, True)]


def told(frame):
    return sorted(map(repr, frame.collect()))


def added_up(layers):
    kept = layers.read(daily.TABLE).drop("month")
    keys = ["client_employee_id", "punch_apply_date"]
    return kept.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in kept.columns if c not in keys])


def equal(layers):
    whole = daily.daily_sums(layers.read(daily.SOURCE))
    return sorted(map(str, map(tuple, added_up(layers).collect()))) == sorted(map(str, map(tuple, whole.collect())))


def test_a_load_adds_its_own_sums(spark):
    layers = Layers(spark, new_folder(spark, "daily"))
    daily.update(layers)
    assert layers.read(daily.TABLE).isEmpty()
    layers.append(punches(spark, *FIRST), daily.SOURCE)
    daily.update(layers)
    before = layers._live_paths(daily.TABLE)
    layers.append(punches(spark, *SECOND), daily.SOURCE)
    layers.append(punches(spark, ("E4", TWO, 8, "1", None)), daily.SOURCE)  # two loads that no update followed
    daily.update(layers)
    after = layers._live_paths(daily.TABLE)
    daily.update(layers)
    assert after == layers._live_paths(daily.TABLE) and after[:1] == before and len(after) == 2
    assert layers.read(daily.TABLE, after=layers.position(daily.SOURCE)).count() == 4  # of the later loads only
    assert equal(layers)
    sheet, kept = layers.read(daily.SOURCE), layers.read(daily.TABLE)
    assert told(daily.hours_per_day_by_employee(kept)) == told(hours.hours_per_day_by_employee(sheet))
    for scope in ({}, {"employee_id": "E1"}, {"start": TWO}, {"end": ONE}, {"employee_id": "none"}):
        assert told(daily.hours_summary(kept, **scope)) == told(hours.hours_summary(sheet, **scope))
        assert told(daily.attendance_summary(kept, **scope)) == told(attendance.summary(sheet, **scope))
    assert told(daily.attendance_by_employee(kept, "late_arrival")) == told(attendance.by_employee(sheet, "late_arrival"))
    for kpi in (hours.hours_per_week_by_employee, hours.hours_per_week, hours.rolling_hours, hours.rolling_snapshot, hours.rolling_top):
        assert told(kpi(daily.per_day(kept))) == told(kpi(sheet)), kpi


def test_replaced_punches_are_summed_anew(spark):
    layers = Layers(spark, new_folder(spark, "daily"))
    layers.append(punches(spark, *FIRST), daily.SOURCE)
    daily.update(layers)
    layers.replace(punches(spark, *SECOND), daily.SOURCE)
    daily.update(layers)
    assert equal(layers) and added_up(layers).count() == 3
    layers.replace(punches(spark), daily.SOURCE)
    daily.update(layers)
    assert layers.read(daily.TABLE).isEmpty()


def test_months_select_folders(spark, capsys):
    layers = Layers(spark, new_folder(spark, "daily"))
    layers.append(punches(spark, *FIRST, *SECOND), daily.SOURCE)
    daily.update(layers)
    assert any(name.startswith("month=2024-02") for name in os.listdir(layers._live_paths(daily.TABLE)[0]))
    daily.hours_summary(layers.read(daily.TABLE), start=TWO).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(month#" in plan and "is_late_arrival" not in plan


def test_a_stopped_update_is_made_up_for(spark, monkeypatch):
    layers = Layers(spark, new_folder(spark, "daily"))
    layers.append(punches(spark, *FIRST), daily.SOURCE)
    with monkeypatch.context() as patched:
        patched.setattr(layers, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            daily.update(layers)
    assert layers.read(daily.TABLE).isEmpty()
    daily.update(layers)
    assert equal(layers)
