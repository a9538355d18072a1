"""Edits of employees that are kept: an ordered log in the layers, and loads that respect it.

A set of changes is first appended to ``changes.employee``, then applied to ``curated.employee`` by a commit that says
how far the log is consumed. A run that stops in between leaves the set pending, and the next step applies it.

A later load must not undo an edit merely by sending the old record again. So for an edited employee a load writes only the
columns in which it differs from what was loaded before; of edit and load, the last writer of a column wins.
"""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.operators import ConstraintViolation, apply_changes
from shiftledger.operators.changes import EDITABLE
from shiftledger.operators.constraints import ROW_RULES, is_broken
from shiftledger.plans.curate import curate_employees, full_name, is_placeholder, tenure_days
from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE_FIELDS, TABLES
from shiftledger.session import new_folder
from shiftledger.sources import Layers

ID = "client_employee_id"
LOG, PEOPLE, STAGED = "changes.employee", "curated.employee", "staging.employee_staging"
GIVEN = (ID, "op", "seq", "fields")
NAMES = ("first_name", "middle_name", "last_name")
AS_OF = "as_of"  # beside the positions of a commit: the day as of which all days of tenure are, 0 if they differ


def store_changes(layers: Layers, changes: DataFrame, rules: Rules) -> DataFrame:
    """Logs and applies a set of changes (see ``apply_changes``); returns the refused ones with ``reason``.

    A set after which an employee would break a rule of the table is refused whole, before it is logged. The set is
    worked out once, into the shared folder: the check, the log and the refusals each read it more than once, and a condition on
    a change would build its map of fields anew for every field it looks at.
    """
    apply_stored(layers, rules)
    folder = new_folder(layers.spark, "changes")
    changes.select(*[F.col(name).cast(TABLES[LOG][name].dataType).alias(name) for name in GIVEN]).write.parquet(folder)
    changes = layers.spark.read.parquet(folder)
    held = layers.read(PEOPLE, parts=layers.parts_of(changes, PEOPLE))
    after, _ = apply_changes(held, changes, rules)
    checks = ROW_RULES[PEOPLE]
    edited = after.join(changes.select(ID).distinct(), ID, "left_semi")
    counts = edited.agg(*[F.count_if(is_broken(rule)).alias(rule.name) for rule in checks]).first().asDict()
    broken = {name: rows for name, rows in counts.items() if rows}
    if broken:
        raise ConstraintViolation(PEOPLE, broken)
    before = layers.position(LOG)
    logged = changes.withColumns({
        "batch": F.lit(time.time_ns()), "as_of": F.lit(rules.as_of).cast("date"), "made_at": F.lit(rules.stamp).cast("timestamp"),
    })
    layers.append(logged, LOG)
    _, refused = apply_changes(held, layers.read(LOG, after=before), rules)  # reads the folders of now, whatever comes later
    apply_stored(layers, rules)
    return refused


def apply_stored(layers: Layers, rules: Rules) -> bool:
    """Applies the logged sets that are not in the table yet, in order; returns whether there were any."""
    upto = layers.position(LOG)
    after = layers.consumed(PEOPLE, LOG)
    if upto <= after:
        return False
    pending = layers.read(LOG, after=after, upto=upto)
    parts = layers.parts_of(pending, PEOPLE)
    people, consumed = layers.read(PEOPLE, parts=parts), {LOG: upto}
    sets = pending.select("batch", "as_of", F.col("made_at").cast("timestamp_ntz").alias("made_at")).distinct().orderBy("batch")
    for one in sets.collect():  # one, unless a run stopped before
        then = replace(rules, as_of=one["as_of"], run_at=one["made_at"])
        people, _ = apply_changes(people, pending.where(F.col("batch") == one["batch"]), then)
        if one["as_of"].toordinal() != layers.consumed(PEOPLE, AS_OF):
            consumed[AS_OF] = 0
    layers.replace(people, PEOPLE, consumed=consumed, parts=parts)
    return True


def with_edits(layers: Layers, loaded: DataFrame, rules: Rules) -> DataFrame:
    """Curated employees from a load, with the edits of earlier changes that the load does not touch.

    Only the employees of the log are compared with their earlier staging and with the stored table.
    """
    if not layers.position(LOG):
        return loaded
    edited = layers.read(LOG).select(ID).distinct()
    names = list(EDITABLE)
    earlier = curate_employees(layers.read(STAGED, upto=layers.consumed(PEOPLE, STAGED)), rules)
    stored = layers.read(PEOPLE).join(edited, ID, "left_semi").select(
        ID, F.struct(*names, "full_name", "is_placeholder").alias("_stored")
    )
    known = stored.join(earlier.select(ID, F.struct(*names).alias("_earlier")), ID)  # an id first loaded now is the load's

    def same(name: str) -> Column:
        return F.col("_earlier").isNotNull() & F.col(f"_earlier.{name}").eqNullSafe(F.col(name))

    same_names = same(NAMES[0]) & same(NAMES[1]) & same(NAMES[2])
    merged = loaded.join(known, ID, "left").select(
        ID, *[F.when(same(name), F.col(f"_stored.{name}")).otherwise(F.col(name)).alias(name) for name in names],
        F.col("_stored").alias("_stored"), same_names.alias("_same_names"),
        *[F.col(name).alias(f"_loaded_{name}") for name in ("full_name", "is_placeholder", "tenure_days")],
    )
    is_edited = F.col("_stored").isNotNull()

    def derived(name: str, new: Column) -> Column:
        kept = F.when(F.col("_same_names"), F.col(f"_stored.{name}")).otherwise(new) if name != "tenure_days" else new
        return F.when(is_edited, kept).otherwise(F.col(f"_loaded_{name}")).alias(name)

    return merged.select(
        ID, *names, derived("full_name", full_name()), derived("is_placeholder", is_placeholder()),
        derived("tenure_days", tenure_days(rules)),
    ).select(*CURATED_EMPLOYEE_FIELDS)
