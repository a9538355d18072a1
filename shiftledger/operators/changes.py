"""Row edits of the curated employee table as one batch over a table of changes.

``changes`` has ``op`` (create, update or delete), ``client_employee_id``,
``fields`` (map of column name to text, a NULL value sets NULL) and ``seq``
(unique per id). The batch gives what the edits give one by one in ``seq`` order:

* a create is refused when the id exists, an update or delete when it does not;
* a delete is soft, so an id that exists stays;
* hence the last writer wins per column, and only the first create of an id
  that the table lacks can succeed.

That turns the replay into aggregations with map-side combine over (id, column);
no list of changes is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.rules import Rules
from shiftledger.schemas import CURATED_EMPLOYEE_FIELDS, EMPLOYEE_FIELDS

ID = "client_employee_id"
EDITABLE = {name: kind for name, kind in EMPLOYEE_FIELDS.items() if name != ID}

CONFLICT = "id already exists"
NOT_FOUND = "id not found"
NO_FIELDS = "no fields to update"
BAD_VALUE = "field value has the wrong type"
BAD_OPERATION = "unknown operation"


def _given(fields: Column, name: str) -> Column:
    return F.try_element_at(fields, F.lit(name))


def _is_given(fields: Column, name: str) -> Column:
    return F.coalesce(F.map_contains_key(fields, F.lit(name)), F.lit(False))


def _display_name(first: Column, last: Column) -> Column:
    """First and last name without empty parts, else the id."""
    parts = F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))
    return F.coalesce(F.nullif(parts, F.lit("")), F.col(ID))


def _checked(changes: DataFrame) -> DataFrame:
    """The changes with known fields only, and why a change is malformed, NULL if it is not."""
    known = F.map_filter("fields", lambda name, _: name.isin(*EDITABLE))
    bad_value = F.lit(False)
    for name, kind in EDITABLE.items():
        if kind.typeName() != "string":
            given = _given(F.col("fields"), name)
            bad_value = bad_value | (given.isNotNull() & given.try_cast(kind).isNull())
    writes = F.col("op").isin("create", "update")
    error = (
        F.when(~F.coalesce(writes | (F.col("op") == "delete"), F.lit(False)), BAD_OPERATION)
        .when(writes & bad_value, BAD_VALUE)
        .when(F.col(ID).isNull(), NOT_FOUND)
    )
    return changes.withColumn("fields", known).withColumn("error", error)


def _latest_edits(sound: DataFrame, rules: Rules) -> DataFrame:
    """Per id the last update or delete of each column, as a map of at most one entry per column."""
    soft_delete = F.array(*[
        F.struct(F.lit(name).alias("key"), F.lit(value).alias("value"))
        for name, value in {"active_status": "false", "term_date": rules.as_of.isoformat()}.items()
    ])
    entries = F.when(F.col("op") == "update", F.map_entries("fields")).when(F.col("op") == "delete", soft_delete)
    edits = sound.select(ID, "seq", F.explode(entries).alias("entry"))
    latest = edits.groupBy(ID, F.col("entry.key").alias("key")).agg(
        F.max(F.struct("seq", F.col("entry.value").alias("value"))).alias("edit")
    )
    return latest.groupBy(ID).agg(F.map_from_entries(F.collect_list(F.struct("key", "edit"))).alias("edits"))


def apply_changes(
    employees: DataFrame, changes: DataFrame, rules: Rules
) -> tuple[DataFrame, DataFrame]:
    """(employee table after the changes, refused changes with ``reason``)."""
    today = F.lit(rules.as_of).cast("date")
    now = F.lit(rules.stamp).cast("timestamp")

    checked = _checked(changes)
    sound = checked.where(F.col("error").isNull())
    first_create = (
        sound.where(F.col("op") == "create")
        .groupBy(ID)
        .agg(F.min_by(F.struct("seq", "fields"), "seq").alias("create"))
    )
    batch = first_create.join(_latest_edits(sound, rules), ID, "full_outer")
    held = employees.withColumn("is_held", F.lit(True)).alias("held")
    in_table = F.col("is_held").isNotNull()
    is_created = ~in_table & F.col("create").isNotNull()
    # Edits count from the moment the id exists.
    since = F.when(~in_table, F.col("create.seq"))
    joined = held.join(batch, ID, "full_outer").withColumn(
        "edits", F.map_filter("edits", lambda _, edit: since.isNull() | (edit["seq"] > since))
    )

    def created_value(name: str) -> Column:
        value = _given(F.col("create.fields"), name).try_cast(EDITABLE[name])
        if name == "active_status":
            return F.when(_is_given(F.col("create.fields"), name), value).otherwise(True)
        return value

    def final_value(name: str) -> Column:
        edit = _given(F.col("edits"), name)
        return (
            F.when(edit.isNotNull(), edit["value"].try_cast(EDITABLE[name]))
            .when(in_table, F.col(f"held.{name}"))
            .otherwise(created_value(name))
        )

    final: dict[str, Column] = {name: final_value(name) for name in EDITABLE}
    renamed = _is_given(F.col("edits"), "first_name") | _is_given(F.col("edits"), "last_name")
    final["full_name"] = F.when(
        renamed | ~in_table, _display_name(final["first_name"], final["last_name"])
    ).otherwise(F.col("held.full_name"))
    final["tenure_days"] = F.when(in_table, F.col("held.tenure_days")).otherwise(
        F.coalesce(F.datediff(today, created_value("hire_date")), F.lit(0))
    )
    final["is_placeholder"] = F.when(in_table, F.col("held.is_placeholder")).otherwise(False)
    final["created_at"] = F.when(in_table, F.col("held.created_at")).otherwise(now)
    edited = F.coalesce(F.cardinality("edits") > 0, F.lit(False))
    final["updated_at"] = F.when(is_created | edited, now).otherwise(F.col("held.updated_at"))

    columns = [*CURATED_EMPLOYEE_FIELDS, "created_at", "updated_at"]
    table = joined.where(in_table | is_created).select(
        ID, *[final[name].alias(name) for name in columns if name != ID]
    )
    return table, _refused(employees, checked)


def _refused(employees: DataFrame, checked: DataFrame) -> DataFrame:
    """Each change that cannot be applied, with the reason."""
    sound_create = F.col("error").isNull() & (F.col("op") == "create")
    first_create = checked.groupBy(ID).agg(F.min(F.when(sound_create, F.col("seq"))).alias("first_create"))
    known = employees.select(ID).withColumn("is_held", F.lit(True))
    # One row per changed id, so the change side of the next join can be split when an id is hot.
    status = first_create.where(F.col(ID).isNotNull()).join(known, ID, "left")

    held = F.coalesce(F.col("is_held"), F.lit(False))
    exists_before = held | F.coalesce(F.col("seq") > F.col("first_create"), F.lit(False))
    no_fields = F.coalesce(F.cardinality("fields") <= 0, F.lit(True))
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when((F.col("op") == "create") & exists_before, CONFLICT)
        .when((F.col("op") != "create") & ~exists_before, NOT_FOUND)
        .when((F.col("op") == "update") & no_fields, NO_FIELDS)
    )
    return (
        checked.join(status, ID, "left")
        .select("seq", "op", ID, reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )
