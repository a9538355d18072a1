"""What keeps the work per row, per shuffle and per task small."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from shiftledger.functions import parse_timestamp
from shiftledger.operators import insert_absent
from shiftledger.plans import daily, edits, refresh
from shiftledger.registry import QUERIES, load
from shiftledger.rules import Rules
from shiftledger.sources import Layers, delimited

RULES = Rules(as_of=date(2024, 6, 1), run_at=datetime(2024, 6, 1, 8))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_date_is_matched_against_its_shape_once(spark):
    texts = spark.createDataFrame([("03/04/2024 08:05 PM",), ("5-Mar-2024",), ("20240305T0805",)], "t string")
    read = texts.select(parse_timestamp(F.col("t"), RULES.date_formats).alias("at"))
    assert [str(row["at"]) for row in read.collect()] == ["2024-03-04 20:05:00", "2024-03-05 00:00:00", "2024-03-05 08:05:00"]
    assert plan(read.where("t is not null")).count("[AP]M") <= 2  # 18 and more when each part was cut out anew


def test_names_without_escapes_are_not_decoded(spark):
    rows = spark.createDataFrame([("a+b.csv",), ("a%20b+%25.csv",)], "uri string")
    read = rows.select(delimited._decoded(F.col("uri")).alias("name"))
    assert [row["name"] for row in read.collect()] == ["a+b.csv", "a b+%.csv"]
    assert "CASE WHEN" in plan(read)


def test_absent_rows_are_shuffled_once(spark):
    at = datetime(2024, 1, 1)
    held = spark.createDataFrame([("a", at, None), ("b", None, None)], "k string, i timestamp, o timestamp")
    rows = [("a", at, None, 1), ("a", None, at, 2), ("a", None, at, 3), ("b", None, None, 4), (None, None, None, 5), (None, None, None, 6)]
    incoming = spark.createDataFrame(rows, "k string, i timestamp, o timestamp, n int")
    keys = ("k", "i", "o")
    absent = insert_absent(held.hint("merge"), incoming, keys, null_safe=True, order=[F.asc("n")])
    assert absent.columns == incoming.columns
    assert sorted(row["n"] for row in absent.collect()) == [2, 5]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        absent = insert_absent(held, incoming, keys, null_safe=True, order=[F.asc("n")])
        assert plan(absent).count("Exchange hashpartitioning") == 2  # one of each side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _layers(spark, tmp_path, ids) -> Layers:
    layers = Layers(spark, str(tmp_path / "layers"))
    add_raw(layers, ids)
    return layers


def add_raw(layers, ids) -> None:
    rows = [(name, f"2024-05-01 0{n % 9}:00", "2024-05-01 17:00", "2024-05-01", "f.csv") for n, name in enumerate(ids)]
    columns = "client_employee_id string, punch_in_datetime string, punch_out_datetime string, punch_apply_date string, source_file string"
    layers.append(layers.spark.createDataFrame(rows, columns), "raw.timesheet_raw")


def test_a_resumed_run_keeps_what_is_staged(spark, tmp_path):
    layers, staged = _layers(spark, tmp_path, ["E1", "E2"]), "staging.timesheet_staging"
    assert refresh.stage_timesheets(layers, RULES, only_this_load=True)
    first = layers.position(staged)
    later = Rules(as_of=RULES.as_of, run_at=datetime(2024, 6, 1, 9))
    assert refresh.stage_timesheets(layers, later, only_this_load=True)
    assert layers.position(staged) == first
    # Other rules, other treatment of bad rows, new raw rows or a run over everything stage anew.
    strict = Rules(as_of=RULES.as_of, run_at=RULES.run_at, junk_ids=("E1",))
    refresh.stage_timesheets(layers, strict, only_this_load=True)
    assert [row[0] for row in layers.read(staged).select("client_employee_id").collect()] == ["E2"]
    for options in ({"on_violation": "quarantine", "only_this_load": True}, {}):
        before = layers.position(staged)
        refresh.stage_timesheets(layers, RULES, **options)
        assert layers.position(staged) > before
    add_raw(layers, ["E3"])
    refresh.stage_timesheets(layers, RULES, only_this_load=True)
    assert layers.read(staged).count() == 3
    refresh.load_employees(layers, RULES)
    refresh.load_timesheets(layers, RULES)
    assert layers.read("curated.timesheet").count() == 3
    assert not refresh.stage_timesheets(layers, RULES, only_this_load=True)


def test_known_employees_need_no_look_at_the_new_punches(spark, tmp_path, monkeypatch):
    layers = _layers(spark, tmp_path, ["E1", "E2"])
    refresh.stage_timesheets(layers, RULES)
    refresh.load_employees(layers, RULES)
    monkeypatch.setattr(refresh, "orphan_keys", lambda *_: 1 / 0)
    refresh.load_timesheets(layers, RULES)
    assert layers.read("curated.timesheet").count() == 2


def test_daily_sums_are_added_up_after_the_shuffle(spark):
    day = date(2024, 1, 1)
    names = "client_employee_id string, punch_apply_date date, hours_worked decimal(18,4)"
    flags = "is_late_arrival boolean, is_early_departure boolean, is_overtime boolean"
    sheet = spark.createDataFrame([("E1", day, None, True, None, False)] * 3, f"{names}, {flags}")
    sums = daily.daily_sums(sheet)
    assert [row["late_arrival_flagged"] for row in sums.collect()] == [3]
    for df in (sums, daily.per_day(sums.localCheckpoint())):
        assert "REPARTITION_BY_NUM" in plan(df)  # adaptive execution joins no such partitions
        below = plan(df).split("Exchange hashpartitioning", 1)[1]
        assert "HashAggregate" not in below.split("== Initial")[0]


def test_raw_rows_are_counted_after_the_shuffle(spark, data_folder):
    load()
    text = plan(QUERIES["snk1_append_raw"](spark, data_folder))
    assert "HashAggregate" not in text.split("Exchange hashpartitioning", 1)[1]


def test_stored_changes_are_worked_out_once(spark, tmp_path):
    layers, seen = Layers(spark, str(tmp_path / "layers")), spark.sparkContext.accumulator(0)

    def counted(n):
        seen.add(1)
        return n

    number = F.udf(counted, "long")
    layers.replace(spark.createDataFrame([("E1", "Ann", False)], "client_employee_id string, first_name string, is_placeholder boolean"), edits.PEOPLE)
    changes = spark.createDataFrame([("E1", 1), ("E9", 2)], "client_employee_id string, n long").select(
        "client_employee_id", F.lit("update").alias("op"), number("n").alias("seq"), F.create_map(F.lit("last_name"), F.lit("Bo")).alias("fields"))
    refused = edits.store_changes(layers, changes, RULES)
    assert [(row["client_employee_id"], row["reason"]) for row in refused.collect()] == [("E9", "id not found")]
    assert [(r["first_name"], r["last_name"]) for r in layers.read(edits.PEOPLE).collect()] == [("Ann", "Bo")]
    assert seen.value == 2
