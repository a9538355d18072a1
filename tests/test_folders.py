"""Upserts that read and write only the folders of their keys."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shiftledger.operators import upsert
from shiftledger.plans import edits
from shiftledger.plans.refresh import load_employees, merge
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE, STAGING_EMPLOYEE
from shiftledger.session import new_folder
from shiftledger.sources import Layers

ID, PEOPLE, STAGED = "client_employee_id", "curated.employee", "staging.employee_staging"
FIRST = Rules(as_of=date(2024, 5, 1), run_at=datetime(2024, 5, 1))
SECOND = Rules(as_of=date(2024, 5, 1), run_at=datetime(2024, 5, 1, 6))


def people(spark, ids, name="Ann", schema=CURATED_EMPLOYEE):
    rows = [
        tuple({
            ID: i, "first_name": name, "hire_date": date(2020, 1, 1), "active_status": True, "is_placeholder": False,
            "created_at": datetime(2024, 4, 1),
        }.get(f) for f in schema.fieldNames())
        for i in ids
    ]
    return spark.createDataFrame(rows, schema)


def told(df, *columns):
    return sorted(df.select(ID, *columns).collect(), key=str)


def folders_of(path):
    return sorted(int(name.split("=")[1]) for name in os.listdir(path) if name.startswith("part="))


def test_merge_equals_the_full_upsert_and_leaves_other_folders(spark):
    layers = Layers(spark, new_folder(spark, "hashed"), folders=16)
    layers.replace(people(spark, [f"E{i}" for i in range(200)]), PEOPLE)
    whole = layers.read(PEOPLE)
    incoming = people(spark, ["E3", "E4", "N1"], "Bob")
    want = told(upsert(whole, incoming, ID, SECOND.stamp), "first_name", "created_at", "updated_at")
    merge(layers, incoming, PEOPLE, SECOND, "fail")
    assert told(layers.read(PEOPLE), "first_name", "created_at", "updated_at") == want

    parts = layers.parts_of(incoming, PEOPLE)
    assert 0 < len(parts) <= 3
    first, last = layers._live(PEOPLE)
    assert folders_of(last[0]) == sorted(last[1]) == parts
    assert set(folders_of(first[0])) == set(range(16)) and first[1] == set(range(16)) - set(parts)


def test_the_scan_is_pruned(spark, capsys):
    layers = Layers(spark, new_folder(spark, "hashed"), folders=16)
    layers.replace(people(spark, [f"E{i}" for i in range(200)]), PEOPLE)
    parts = layers.parts_of(people(spark, ["E5"]), PEOPLE)
    read = layers.read(PEOPLE, parts=parts)
    read.explain("formatted")
    plan = capsys.readouterr().out
    assert "part#" in next(line for line in plan.splitlines() if "PartitionFilters" in line)
    whole = layers.read(PEOPLE)
    assert read.count() == whole.where(layers._part(PEOPLE) == parts[0]).count() > 0
    files = read.select(F.regexp_extract(F.input_file_name(), r"part=(\d+)", 1).cast("int").alias("part")).distinct().collect()
    assert [row["part"] for row in files] == parts


def test_many_loads_in_pieces(spark):
    """Appends, replaced folders and replaced tables in turn, against a plain dict."""
    layers, want = Layers(spark, new_folder(spark, "hashed"), folders=4), {}
    for step in range(8):
        ids = [f"E{(step * 5 + i * 3) % 17}" for i in range(3)]
        if step == 5:
            layers.replace(people(spark, ["E1", "E2"], "all"), PEOPLE)
            want = {"E1": "all", "E2": "all"}
        elif step % 3 == 2:
            new = [f"S{step}{i}" for i in range(3)]
            layers.append(people(spark, new, f"s{step}"), PEOPLE)
            want |= dict.fromkeys(new, f"s{step}")
        else:
            merge(layers, people(spark, sorted(set(ids)), f"s{step}"), PEOPLE, SECOND, "fail")
            want |= dict.fromkeys(ids, f"s{step}")
        assert {r[ID]: r["first_name"] for r in layers.read(PEOPLE).collect()} == want
        assert layers.read(PEOPLE).count() == len(want)
    old = layers.position(PEOPLE)
    layers.replace(people(spark, []), PEOPLE)
    assert layers.read(PEOPLE).count() == 0
    assert {r[ID]: r["first_name"] for r in layers.read(PEOPLE, upto=old).collect()} == want


def test_an_empty_load_consumes_its_source(spark):
    layers = Layers(spark, new_folder(spark, "hashed"))
    layers.replace(people(spark, ["E1"]), PEOPLE)
    merge(layers, people(spark, []), PEOPLE, SECOND, "fail", {"raw": 7})
    assert layers.consumed(PEOPLE, "raw") == 7 and layers.read(PEOPLE).count() == 1


def test_folders_are_fixed_for_a_root(spark):
    root = new_folder(spark, "hashed")
    Layers(spark, root, folders=4).replace(people(spark, ["E1"]), PEOPLE)
    with pytest.raises(ValueError):
        Layers(spark, root, folders=8).read(PEOPLE)
    with pytest.raises(ValueError):
        Layers(spark, root, folders=4).replace(people(spark, ["E1", "E2", "E3", "E4", "E5"]), PEOPLE, parts=[0])


def stage(layers, ids, name):
    incoming = people(layers.spark, ids, name, STAGING_EMPLOYEE)
    merge(layers, incoming, STAGED, SECOND, "fail")


def test_a_load_of_the_day_takes_changed_folders_only(spark):
    layers = Layers(spark, new_folder(spark, "hashed"), folders=16)
    stage(layers, [f"E{i}" for i in range(100)], "Ann")
    load_employees(layers, FIRST, only_this_load=True)
    stage(layers, ["E7", "E8"], "Bob")
    load_employees(layers, SECOND, only_this_load=True)
    parts = layers.parts_of(people(spark, ["E7", "E8"]), PEOPLE)
    assert sorted(layers._live(PEOPLE)[-1][1]) == parts
    names = {r[ID]: r["first_name"] for r in layers.read(PEOPLE).collect()}
    assert names == {f"E{i}": "Bob" if i in (7, 8) else "Ann" for i in range(100)}

    stage(layers, ["E9"], "Cy")  # on the next day all days of tenure have grown
    load_employees(layers, Rules(as_of=date(2024, 5, 2), run_at=datetime(2024, 5, 2)), only_this_load=True)
    assert len(layers._live(PEOPLE)) == 1
    assert {r["tenure_days"] for r in layers.read(PEOPLE).collect()} == {(date(2024, 5, 2) - date(2020, 1, 1)).days}


def test_edits_write_their_folders_and_keep_tenure_right(spark):
    layers = Layers(spark, new_folder(spark, "hashed"), folders=16)
    stage(layers, [f"E{i}" for i in range(60)], "Ann")
    load_employees(layers, FIRST, only_this_load=True)
    change = spark.createDataFrame(
        [("E3", "update", 1, {"first_name": "Dee"})], "client_employee_id string, op string, seq long, fields map<string,string>"
    )
    edits.store_changes(layers, change, Rules(as_of=date(2024, 5, 3), run_at=datetime(2024, 5, 3)))
    assert sorted(layers._live(PEOPLE)[-1][1]) == layers.parts_of(change, PEOPLE)
    stage(layers, ["E9"], "Cy")
    load_employees(layers, FIRST, only_this_load=True)  # the edit was as of another day, so all folders are loaded
    found = layers.read(PEOPLE)
    assert {r[ID]: r["first_name"] for r in found.where("client_employee_id in ('E3', 'E9', 'E10')").collect()} == {
        "E3": "Dee", "E9": "Cy", "E10": "Ann",
    }
    assert found.select("tenure_days").distinct().count() == 1


def test_a_lookup_skips_row_groups_without_the_id(spark):
    """An absent id lies between the least and the greatest, so only the Bloom filter can tell."""
    layers = Layers(spark, new_folder(spark, "bloomed"))
    day = F.lit(date(2024, 5, 1))
    ids = spark.range(0, 400_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias(ID), day.alias("punch_apply_date"))
    layers.append(ids, "curated.timesheet")
    held = layers.read("curated.timesheet")

    def scanned(wanted):
        found = held.where(F.col(ID) == wanted)
        found.collect()
        nodes = found._jdf.queryExecution().executedPlan().collectLeaves()
        return nodes.apply(0).metrics().apply("numOutputRows").value()

    assert scanned("8" * 64) == 0
    assert scanned(ids.first()[ID]) > 0
