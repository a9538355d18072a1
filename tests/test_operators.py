import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shiftledger.operators import ConstraintViolation, Rule, apply_changes, enforce, first_per_key, insert_absent, upsert
from shiftledger.operators.changes import BAD_OPERATION, BAD_VALUE, CONFLICT, NO_FIELDS, NOT_FOUND
from shiftledger.operators.constraints import duplicate_keys, orphan_keys
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE

RULES = Rules(as_of=date(2024, 5, 1), run_at=datetime(2024, 5, 1, 12))
PUNCHES = "id string, punch_in int, punch_out int, note string"


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]


def test_first_per_key_is_total_and_treats_nulls_as_equal(spark):
    df = spark.createDataFrame(
        [("a", 1, None, "z"), ("a", 1, None, "y"), ("a", 1, 2, "x"), (None, None, None, "q"), (None, None, None, "p")],
        PUNCHES,
    )
    kept = first_per_key(df, ["id", "punch_in", "punch_out"], [])
    assert rows(kept) == [(None, None, None, "p"), ("a", 1, None, "y"), ("a", 1, 2, "x")]


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id").repartition(4)
    plan = first_per_key(df, ["key"], [F.desc("id")])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_upsert_overwrites_with_nulls_and_keeps_creation(spark):
    kinds = "id string, name string, created_at timestamp, updated_at timestamp"
    then = datetime(2020, 1, 1)
    current = spark.createDataFrame([("a", "old", then, then), ("b", "keep", then, then)], kinds)
    incoming = spark.createDataFrame([("a", None), ("c", "new")], "id string, name string")
    now = RULES.stamp
    assert rows(upsert(current, incoming, "id", now), "id") == [
        ("a", None, then, now), ("b", "keep", then, then), ("c", "new", now, now),
    ]


def test_insert_absent_lets_null_keys_pass(spark):
    current = spark.createDataFrame([("a", 1, 2, "held"), ("a", 1, None, "held")], PUNCHES)
    incoming = spark.createDataFrame(
        [("a", 1, 2, "again"), ("a", 1, None, "again"), ("b", 1, 2, "second"), ("b", 1, 2, "first")], PUNCHES
    )
    keys = ["id", "punch_in", "punch_out"]
    assert rows(insert_absent(current, incoming, keys)) == [("a", 1, None, "again"), ("b", 1, 2, "first")]
    assert rows(insert_absent(current, incoming, keys, null_safe=True)) == [("b", 1, 2, "first")]
    once = incoming.where(F.col("note") != "second")
    assert rows(insert_absent(current, once, keys, unique=True)) == [("a", 1, None, "again"), ("b", 1, 2, "first")]
    assert rows(insert_absent(current, once, keys, unique=True, null_safe=True)) == [("b", 1, 2, "first")]


def test_insert_of_deduplicated_rows_shuffles_them_once(spark):
    keys = ["id", "punch_in", "punch_out"]
    incoming = spark.createDataFrame([("a", 1, 2, "x"), ("a", None, 2, "y")], PUNCHES)
    current = spark.createDataFrame([("a", 1, 2, "held")], PUNCHES)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        added = insert_absent(current, first_per_key(incoming, keys, []), keys, unique=True)
        plan = added._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_enforce(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 2), (-1, -5)], "low int, high int")
    rules = [Rule("ordered", "low <= high"), Rule("positive", "high > 0")]
    good, bad = enforce(df, rules, on_violation="quarantine")
    assert rows(good) == [(None, 2), (1, 2)]
    assert rows(bad, "low") == [(-1, -5, ["ordered", "positive"]), (3, 2, ["ordered"])]
    with pytest.raises(ConstraintViolation) as error:
        enforce(df, rules, table="t")
    assert error.value.counts == {"ordered": 2, "positive": 1}


def test_keyed_checks(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), (None, 1)], "id string, part int")
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(duplicate_keys(child, ["id", "part"])) == [("a", 1, 2)]
    assert rows(duplicate_keys(child, ["id", "part"], nulls_distinct=False)) == [("a", 1, 2), ("b", None, 2)]
    assert rows(orphan_keys(child, parent, "id")) == [("b", 2)]


# --- change sets ---------------------------------------------------------------------

CHANGES = "seq long, op string, client_employee_id string, fields map<string,string>"


def employee(**values):
    row = {field.name: None for field in CURATED_EMPLOYEE.fields}
    row.update(is_placeholder=False, active_status=True, created_at=datetime(2020, 1, 1), updated_at=datetime(2020, 1, 1))
    row.update(values)
    return tuple(row.values())


def replay(table, changes):
    """The changes one by one, as single edits."""
    refused = []
    for seq, op, key, fields in sorted(changes, key=lambda change: change[0]):
        fields = fields or {}
        held = table.get(key)
        if op not in ("create", "update", "delete"):
            refused.append((seq, BAD_OPERATION))
            continue
        if op != "delete" and fields.get("hire_date") == "bad":
            refused.append((seq, BAD_VALUE))
            continue

        def name(row):
            return " ".join(part for part in (row["first_name"], row["last_name"]) if part) or key

        def typed(field, text):
            if text is None:
                return None
            return date.fromisoformat(text) if field.endswith("_date") else text == "true" if field == "active_status" else text

        if op == "create":
            if held:
                refused.append((seq, CONFLICT))
                continue
            row = {"first_name": None, "last_name": None, "hire_date": None, "term_date": None, "active_status": True}
            row.update({field: typed(field, text) for field, text in fields.items()})
            row["full_name"] = name(row)
            row["tenure_days"] = (RULES.as_of - row["hire_date"]).days if row["hire_date"] else 0
            table[key] = row
        elif not held:
            refused.append((seq, NOT_FOUND))
        elif op == "delete":
            held.update(active_status=False, term_date=RULES.as_of)
        elif not fields:
            refused.append((seq, NO_FIELDS))
        else:
            held.update({field: typed(field, text) for field, text in fields.items()})
            if "first_name" in fields or "last_name" in fields:
                held["full_name"] = name(held)
    return table, refused


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_equal_single_edits(spark, seed):
    draw = random.Random(seed)
    start = {
        key: {
            "first_name": "F", "last_name": "L", "hire_date": date(2023, 1, 1), "term_date": None,
            "active_status": True, "full_name": "F M L", "tenure_days": 486,
        }
        for key in "ab"
    }
    texts = {
        "first_name": ["Ann", "", None], "last_name": ["Lee", None], "hire_date": ["2024-01-01", "bad", None],
        "active_status": ["true", "false"], "term_date": ["2024-02-02", None],
    }
    changes = []
    for seq in range(120):
        given = draw.sample(list(texts), draw.choice([0, 1, 1, 2, 3]))
        fields = {field: draw.choice(texts[field]) for field in given}
        op = draw.choice(["create", "update", "update", "delete", "other"])
        changes.append((seq, op, draw.choice("abcdefgh"), fields or draw.choice([None, {}])))
    draw.shuffle(changes)
    employees = spark.createDataFrame(
        [employee(client_employee_id=key, **values) for key, values in start.items()], CURATED_EMPLOYEE
    )
    after, refused = apply_changes(employees, spark.createDataFrame(changes, CHANGES), RULES)
    table, expected_refused = replay(start, changes)
    shown = ["first_name", "last_name", "hire_date", "term_date", "active_status", "full_name", "tenure_days"]
    found = {row["client_employee_id"]: {name: row[name] for name in shown} for row in after.collect()}
    assert found == table
    assert rows(refused.select("seq", "reason")) == sorted(expected_refused)


def test_change_flow(spark):
    nobody = spark.createDataFrame([], CURATED_EMPLOYEE)
    changes = spark.createDataFrame([
        (1, "create", "E1", {"first_name": "Test", "last_name": "User", "unknown": "x"}),
        (2, "create", "E1", {"first_name": "Again"}),
        (3, "update", "E1", {"first_name": "Updated"}),
        (4, "update", "E1", {"unknown": "x"}),
        (5, "delete", "E1", None),
        (6, "update", "E9", {"first_name": "Nobody"}),
    ], CHANGES)
    after, refused = apply_changes(nobody, changes, RULES)
    row = after.first()
    assert (row["full_name"], row["active_status"], row["term_date"], row["tenure_days"]) == ("Updated User", False, RULES.as_of, 0)
    assert row["created_at"] == row["updated_at"] == RULES.stamp
    assert rows(refused.select("seq", "reason")) == [(2, CONFLICT), (4, NO_FIELDS), (6, NOT_FOUND)]


def test_untouched_employees_keep_their_stamp(spark):
    employees = spark.createDataFrame([employee(client_employee_id="a"), employee(client_employee_id="b")], CURATED_EMPLOYEE)
    changes = spark.createDataFrame([(1, "update", "b", {"city": "Oslo"})], CHANGES)
    after, _ = apply_changes(employees, changes, RULES)
    assert rows(after.select("client_employee_id", "city", "updated_at")) == [
        ("a", None, datetime(2020, 1, 1)), ("b", "Oslo", RULES.stamp),
    ]
