"""Parameterised row lookups on the curated tables. An unknown id gives no rows.

Long lists are paged by the last row of the page before (``after``): it becomes a predicate, so that a page reads
and sorts only what is left, while ``offset`` sorts all that it skips.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shiftledger.plans.headcount import real_employees
from shiftledger.plans.hours import DAY, in_range

ID = "client_employee_id"


def _page(df: DataFrame, limit: int | None, offset: int) -> DataFrame:
    """All rows from ``offset`` on, or ``limit`` of them."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    if offset < 0:
        raise ValueError("offset must not be negative")
    rows = df.offset(offset) if offset else df
    return rows if limit is None else rows.limit(limit)


def _beyond(last: Mapping[str, object], keys: Sequence[tuple[str, bool]], *, too: bool) -> Column:
    """Rows that come after ``last`` in the order of ``keys`` (name, descending), missing values first; or equal it, with ``too``."""
    beyond = F.lit(too)
    for name, descending in reversed(keys):
        value = last[name]
        if value is None:
            later, same = F.col(name).isNotNull(), F.col(name).isNull()
        else:
            later = F.col(name) < F.lit(value) if descending else F.col(name) > F.lit(value)
            # a plain comparison is never missing where the value is not: a missing one comes before it
            later, same = F.col(name).isNotNull() & later, F.col(name).eqNullSafe(F.lit(value))
        beyond = later | (same & beyond)
    return beyond


def departments(employees: DataFrame) -> DataFrame:
    named = real_employees(employees).where(F.col("department_name").isNotNull())
    return named.select("department_name").distinct().orderBy("department_name")


def search_employees(employees: DataFrame, query: str = "", *, limit: int | None = 50) -> DataFrame:
    """Employees whose id or name contains ``query``, in any case; % and _ act as wildcards."""
    pattern = f"%{query}%"
    hits = real_employees(employees).where(F.col(ID).ilike(pattern) | F.col("full_name").ilike(pattern))
    listed = hits.select(ID, "full_name", "department_name").orderBy(F.asc_nulls_last("full_name"), ID)
    return _page(listed, limit, 0)


def list_employees(
    employees: DataFrame,
    *,
    department: str | None = None,
    active: bool | None = None,
    after: str | None = None,
    limit: int | None = 50,
    offset: int = 0,
) -> DataFrame:
    """Employees by id; with ``after`` those whose id comes after that one, the last of the page before."""
    rows = employees if after is None else employees.where(F.col(ID) > after)
    if department is not None:
        rows = rows.where(F.col("department_name") == department)
    if active is not None:
        rows = rows.where(F.col("active_status") == active)
    return _page(rows.orderBy(ID), limit, offset)


def employee(employees: DataFrame, employee_id: str) -> DataFrame:
    return employees.where(F.col(ID) == employee_id)


def list_timesheets(
    timesheets: DataFrame,
    *,
    employee_id: str | None = None,
    start: date | None = None,
    end: date | None = None,
    after: Row | None = None,
    seen: int = 0,
    limit: int | None = 50,
    offset: int = 0,
) -> DataFrame:
    """Punches, latest day first; the punch times and all other columns settle ties.

    With ``after``, the last row of the page before as this function returned it, the list goes on behind that row; its day bounds
    the days read, so on a table with monthly folders also the folders. Only a table with rows equal in all columns needs
    ``seen``: how many rows equal to ``after`` the pages so far held, so that its other copies follow.
    """
    if after is not None and after[DAY] is not None:
        end = after[DAY] if end is None else min(end, after[DAY])
    rows = in_range(timesheets, employee_id=employee_id, start=start, end=end)
    ties = [ID, "punch_in_datetime", "punch_out_datetime"]
    rest = [name for name in rows.columns if name not in (*ties, DAY)]
    if after is not None:
        order = [(DAY, True), *[(name, False) for name in (*ties, *rest)]]
        rows = rows.where(_beyond(after.asDict(), order, too=seen > 0))
    return _page(rows.orderBy(F.desc_nulls_first(DAY), *ties, *rest), limit, offset + seen)


def timesheets_of(timesheets: DataFrame, employee_id: str, *, limit: int | None = None, **options) -> DataFrame:
    return list_timesheets(timesheets, employee_id=employee_id, limit=limit, **options)
