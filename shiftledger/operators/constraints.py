"""Integrity rules as one-pass row predicates plus two keyed checks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN = "broken_rules"


class ConstraintViolation(Exception):
    """Rows break integrity rules and the load is refused."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.table, self.counts = table, counts
        listing = ", ".join(f"{name}: {rows}" for name, rows in sorted(counts.items()))
        super().__init__(f"{table}: {listing}")


class Rule(NamedTuple):
    """A row is good when the SQL predicate ``holds`` is true or unknown."""

    name: str
    holds: str


def required(*columns: str) -> list[Rule]:
    return [Rule(f"{name}_not_null", f"{name} IS NOT NULL") for name in columns]


HOURS_NOT_NEGATIVE = Rule("hours_worked_not_negative", "hours_worked >= 0")
TENURE_NOT_NEGATIVE = Rule("tenure_days_not_negative", "tenure_days >= 0")
EXPERIENCE_NOT_NEGATIVE = Rule("years_of_experience_not_negative", "years_of_experience >= 0")
TERM_AFTER_HIRE = Rule("term_date_not_before_hire_date", "term_date >= hire_date")
PUNCHES_ORDERED = Rule("punch_out_after_punch_in", "punch_out_datetime > punch_in_datetime")

ROW_RULES: dict[str, list[Rule]] = {
    "raw.employee_raw": required("source_file"),
    "raw.timesheet_raw": required("source_file"),
    "staging.employee_staging": required("client_employee_id"),
    "staging.timesheet_staging": [*required("client_employee_id", "source_file"), HOURS_NOT_NEGATIVE],
    "curated.employee": [
        *required("client_employee_id", "is_placeholder"),
        TENURE_NOT_NEGATIVE, TERM_AFTER_HIRE, EXPERIENCE_NOT_NEGATIVE,
    ],
    "curated.timesheet": [
        *required("client_employee_id", "punch_apply_date"), HOURS_NOT_NEGATIVE, PUNCHES_ORDERED,
    ],
}


def is_broken(rule: Rule) -> Column:
    return F.coalesce(~F.expr(rule.holds), F.lit(False))


def mark_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the names of the rules each row breaks, as an array."""
    names = [F.when(is_broken(rule), F.lit(rule.name)) for rule in rules]
    found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn(BROKEN, found)


def broken_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, rows) for every rule, in one pass; rules that hold show 0."""
    totals = df.agg(*[F.count_if(is_broken(rule)).alias(rule.name) for rule in rules])
    pairs = [F.struct(F.lit(rule.name).alias("rule"), F.col(rule.name).alias("rows")) for rule in rules]
    return totals.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.rule", "pair.rows")


def enforce(
    df: DataFrame, rules: Sequence[Rule], *, on_violation: str = "fail", table: str = "table"
) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``broken_rules``).

    ``fail`` counts first and raises when any row is bad; ``quarantine`` stays lazy.
    """
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_violation: {on_violation}")
    if on_violation == "fail":
        counts = {row["rule"]: row["rows"] for row in broken_counts(df, rules).collect() if row["rows"]}
        if counts:
            raise ConstraintViolation(table, counts)
    marked = mark_broken(df, rules)
    clean = F.size(BROKEN) == 0
    return marked.where(clean).drop(BROKEN), marked.where(~clean)


def duplicate_keys(df: DataFrame, keys: Sequence[str], *, nulls_distinct: bool = True) -> DataFrame:
    """Keys held by more than one row, with their row count.

    With ``nulls_distinct`` a key with a NULL part is never a duplicate (UNIQUE);
    a primary key also has to be checked with ``required``.
    """
    rows = df.dropna(subset=list(keys)) if nulls_distinct else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL child keys without a parent row, with their row count.

    Counting before the join keeps a hot key out of it.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")
