"""Lookup queries."""

from __future__ import annotations

from datetime import date

from shiftledger.plans import lookup
from shiftledger.registry import query
from shiftledger.registry.bridge import employees, sql, timesheets

EMPLOYEE = ["client_employee_id", "full_name", "department_name", "hire_date", "term_date", "active_status"]
PUNCH = ["client_employee_id", "punch_apply_date", "punch_in_datetime", "punch_out_datetime", "is_late_arrival"]
_EMPLOYEE, _PUNCH = ", ".join(EMPLOYEE), ", ".join(PUNCH)
_TIES = """punch_apply_date desc nulls first, client_employee_id nulls first, punch_in_datetime nulls first,
    punch_out_datetime nulls first, department_id nulls first, department_name nulls first, home_department_id nulls first,
    home_department_name nulls first, pay_code nulls first, hours_worked nulls first"""


@query("lq1_departments", sql("emp", """
    select distinct department_name from emp where not is_placeholder and department_name is not null"""))
def _(spark, sf):
    return lookup.departments(employees(spark, sf))


@query("lq2_search_employees", sql("emp", """
    select client_employee_id, full_name, department_name from emp
    where not is_placeholder and (client_employee_id ilike '%mach%' or full_name ilike '%mach%')
    order by full_name nulls last, client_employee_id limit 50"""))
def _(spark, sf):
    return lookup.search_employees(employees(spark, sf), "mach")


@query("lq3_list_employees", sql("emp", f"""
    select {_EMPLOYEE} from emp where department_name = '3-MEDIUM' and active_status
    order by client_employee_id limit 100 offset 20"""))
def _(spark, sf):
    rows = lookup.list_employees(employees(spark, sf), department="3-MEDIUM", active=True, limit=100, offset=20)
    return rows.select(*EMPLOYEE)


@query("lq3_next_page", sql("emp", f"""
    select {_EMPLOYEE} from emp where department_name = '3-MEDIUM' and active_status
    order by client_employee_id limit 100 offset 20"""))
def _(spark, sf):
    """The second page, sought by the last id of the first."""
    staff, scope = employees(spark, sf), {"department": "3-MEDIUM", "active": True}
    first = lookup.list_employees(staff, **scope, limit=20).collect()
    after = first[-1]["client_employee_id"] if first else None
    return lookup.list_employees(staff, **scope, after=after, limit=100).select(*EMPLOYEE)


@query("lq4_employee_by_id", sql("emp", f"select {_EMPLOYEE} from emp where client_employee_id = '73'"))
def _(spark, sf):
    return lookup.employee(employees(spark, sf), "73").select(*EMPLOYEE)


@query("lq5_list_timesheets", sql("ts", f"""
    select {_PUNCH} from ts where punch_apply_date >= date '1996-02-01' and punch_apply_date <= date '1999-03-31'
    order by {_TIES} limit 200 offset 50"""))
def _(spark, sf):
    rows = lookup.list_timesheets(
        timesheets(spark, sf), start=date(1996, 2, 1), end=date(1999, 3, 31), limit=200, offset=50
    )
    return rows.select(*PUNCH)


@query("lq5_next_page", sql("ts", f"""
    select {_PUNCH} from ts where punch_apply_date >= date '1996-02-01' and punch_apply_date <= date '1999-03-31'
    order by {_TIES} limit 200 offset 50"""))
def _(spark, sf):
    """The second page, sought by the last row of the first."""
    sheet, scope = timesheets(spark, sf), {"start": date(1996, 2, 1), "end": date(1999, 3, 31)}
    first = lookup.list_timesheets(sheet, **scope, limit=50).collect()
    same = sum(row == first[-1] for row in first)
    # one more than the page shows whether copies of its last row exist at all
    alike = lookup.list_timesheets(sheet, **scope, after=first[-1], seen=same, limit=1).collect() if first else []
    seen = same if alike and alike[0] == first[-1] else 0
    rows = lookup.list_timesheets(sheet, **scope, after=first[-1] if first else None, seen=seen, limit=200)
    return rows.select(*PUNCH)


@query("lq6_timesheets_of_employee", sql("ts", f"""
    select {_PUNCH} from ts where client_employee_id = '7'"""))
def _(spark, sf):
    return lookup.timesheets_of(timesheets(spark, sf), "7").select(*PUNCH)
