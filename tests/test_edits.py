"""Stored change sets against loads that come before and after them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from shiftledger.operators import ConstraintViolation
from shiftledger.plans import edits
from shiftledger.plans.refresh import load_employees
from shiftledger.rules import Rules
from shiftledger.schemas import STAGING_EMPLOYEE
from shiftledger.session import new_folder
from shiftledger.sources import Layers

RULES = Rules(as_of=date(2024, 5, 1))
CHANGES = "seq long, op string, client_employee_id string, fields map<string,string>"


def load(layers, *people):
    staged = [{"client_employee_id": i, "first_name": f, "last_name": "Lee", "department_name": d, "hire_date": date(2020, 1, 5)}
              for i, f, d in people]
    rows = [tuple(p.get(n) for n in STAGING_EMPLOYEE.fieldNames()) for p in staged]
    layers.replace(layers.spark.createDataFrame(rows, STAGING_EMPLOYEE).withColumn("active_status", F.lit(True)), "staging.employee_staging")
    load_employees(layers, RULES)


def change(layers, *rows):
    return edits.store_changes(layers, layers.spark.createDataFrame(list(rows), CHANGES), RULES)


def people(layers, *columns):
    found = layers.read("curated.employee").select("client_employee_id", *columns).collect()
    return {row[0]: tuple(row)[1:] for row in found}


def test_edits_outlive_the_same_records(spark):
    layers = Layers(spark, new_folder(spark, "edits"))
    load(layers, ("E1", "Ann", "A"), ("E2", "Bob", "A"), ("E3", "Cy", "A"))
    refused = change(
        layers, (1, "delete", "E1", None), (2, "update", "E2", {"department_name": "B"}), (3, "create", "E3", {}),
        (4, "create", "N1", {"first_name": "New"}),
    )
    assert [(r.seq, r.reason) for r in refused.collect()] == [(3, "id already exists")]
    load(layers, ("E1", "Ann", "A"), ("E2", "Bob", "A"), ("E3", "Cy", "C"))
    columns = ("active_status", "term_date", "department_name", "full_name")
    assert people(layers, *columns) == {
        "E1": (False, date(2024, 5, 1), "A", "Ann Lee"), "E2": (True, None, "B", "Bob Lee"), "E3": (True, None, "C", "Cy Lee"),
        "N1": (True, None, None, "New"),
    }
    # A column that the load changes is the load's; the others stay edited.
    load(layers, ("E1", "Anna", "A"), ("E2", "Bob", "D"), ("E3", "Cy", "C"))
    assert people(layers, *columns)["E1"] == (False, date(2024, 5, 1), "A", "Anna Lee")
    assert people(layers, *columns)["E2"] == (True, None, "D", "Bob Lee")


def test_a_logged_set_is_applied_by_the_next_step(spark, monkeypatch):
    layers = Layers(spark, new_folder(spark, "edits"))
    load(layers, ("E1", "Ann", "A"))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        calls = iter([False])

        def killed(*_):
            if next(calls, True):
                raise RuntimeError

        patch.setattr(edits, "apply_stored", killed)
        change(layers, (1, "delete", "E1", None))
    assert people(layers, "active_status") == {"E1": (True,)}
    load(layers, ("E1", "Ann", "A"))
    assert people(layers, "active_status") == {"E1": (False,)}
    assert not edits.apply_stored(layers, RULES)


def test_a_set_that_breaks_a_rule_is_not_logged(spark):
    layers = Layers(spark, new_folder(spark, "edits"))
    load(layers, ("E1", "Ann", "A"))
    with pytest.raises(ConstraintViolation):
        change(layers, (1, "update", "E1", {"term_date": "2019-01-01"}))
    assert layers.position("changes.employee") == 0
