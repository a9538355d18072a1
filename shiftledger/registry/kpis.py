"""KPI queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from shiftledger.plans import attendance, daily, headcount, hours, people
from shiftledger.registry import ORACLES, query
from shiftledger.registry.bridge import (
    AS_OF,
    employees,
    inconsistent_employees,
    mean_hours,
    mean_years,
    percent,
    sql,
    timesheets,
)
from shiftledger.session import new_folder
from shiftledger.sources import Layers

# --- headcount and turnover ------------------------------------------------------


def _headcount_sql(views: str, dates: str, extra: str = "") -> str:
    source = views.split()[-1]
    return sql(views, f"""
        spine as ({dates})
        select s.as_of_date, count(e.client_employee_id) as active_headcount
        from spine s left join {source} e on not e.is_placeholder and e.hire_date <= s.as_of_date
            and (e.term_date is null or e.term_date > s.as_of_date) {extra}
        group by s.as_of_date""")


def _months(first: str, last: str = "timestamp '2002-01-01'") -> str:
    return f"""select last_day(cast(d as date)) as as_of_date from (
        select unnest(generate_series(date_trunc('month', {first}), {last}, interval 1 month)) as d)"""


_FIRST_HIRE = "cast((select min(hire_date) from {} where not is_placeholder) as timestamp)"


@query("k1_headcount_monthly", _headcount_sql("emp", _months(_FIRST_HIRE.format("emp"))))
def _(spark, sf):
    return headcount.headcount(employees(spark, sf), as_of=AS_OF)


@query("k1_headcount_with_terms_before_hires", _headcount_sql("emp_bad", _months(_FIRST_HIRE.format("emp_bad"))))
def _(spark, sf):
    return headcount.headcount(inconsistent_employees(spark, sf), as_of=AS_OF)


@query("k2_headcount_daily", _headcount_sql("emp", f"""
    select cast(d as date) as as_of_date from (
        select unnest(generate_series({_FIRST_HIRE.format("emp")}, timestamp '2002-01-01', interval 1 day)) as d)"""))
def _(spark, sf):
    return headcount.headcount(employees(spark, sf), as_of=AS_OF, grain="day")


@query("k3_headcount_on_date", sql("emp", """
    select count(*) as active_headcount from emp where not is_placeholder
    and hire_date <= date '1998-06-15' and (term_date is null or term_date > date '1998-06-15')"""))
def _(spark, sf):
    return headcount.headcount_on(employees(spark, sf), date(1998, 6, 15))


@query("k4_headcount_range_department", _headcount_sql(
    "emp", _months("timestamp '1996-03-10'", "timestamp '1998-11-01'"), "and e.department_name = '2-HIGH'"))
def _(spark, sf):
    return headcount.headcount(
        employees(spark, sf), as_of=AS_OF, start=date(1996, 3, 10), end=date(1998, 11, 20), department="2-HIGH"
    )


@query("k4_headcount_department", _headcount_sql(
    "emp", _months(_FIRST_HIRE.format("emp")), "and e.department_name = '5-LOW'"))
def _(spark, sf):
    return headcount.headcount(employees(spark, sf), as_of=AS_OF, department="5-LOW")


def _turnover_sql(grain: str, extra: str = "") -> str:
    return sql("emp", f"""
        select cast(date_trunc('{grain}', term_date) as date) as termination_{grain}, count(*) as terminations
        from emp where not is_placeholder and term_date is not null {extra} group by 1""")


@query("k5_terminations_monthly", _turnover_sql("month"))
def _(spark, sf):
    return people.turnover(employees(spark, sf))


@query("k6_terminations_quarterly", _turnover_sql("quarter"))
def _(spark, sf):
    return people.turnover(employees(spark, sf), grain="quarter")


@query("k7_turnover_rate_monthly", sql("emp", f"""
    spine as ({_months(_FIRST_HIRE.format("emp"))}),
    heads as (select s.as_of_date, count(e.client_employee_id) as active_headcount
        from spine s left join emp e on not e.is_placeholder and e.hire_date <= s.as_of_date
            and (e.term_date is null or e.term_date > s.as_of_date) group by s.as_of_date),
    terms as (select last_day(term_date) as as_of_date, count(*) as terminations
        from emp where not is_placeholder and term_date is not null group by 1)
    select h.as_of_date, h.active_headcount, coalesce(t.terminations, 0) as terminations,
        {percent("coalesce(t.terminations, 0)", "h.active_headcount")} as turnover_rate_percentage
    from heads h left join terms t on h.as_of_date = t.as_of_date"""))
def _(spark, sf):
    return headcount.turnover_rate(employees(spark, sf), as_of=AS_OF)


@query("k8_terminations_range", _turnover_sql(
    "month", "and term_date >= date '1996-02-10' and term_date <= date '1999-09-15'"))
def _(spark, sf):
    return people.turnover(employees(spark, sf), start=date(1996, 2, 10), end=date(1999, 9, 15))


@query("k9_terminations_series", sql("emp", """
    months as (select cast(date_trunc('month', term_date) as date) as m, count(*) as n
        from emp where not is_placeholder and term_date is not null group by 1),
    spine as (select cast(unnest(generate_series(
        cast((select min(m) from months) as timestamp), cast((select max(m) from months) as timestamp), interval 1 month)) as date) as m)
    select s.m as termination_month, strftime(s.m, '%b %Y') as month_label, coalesce(n, 0) as terminations
    from spine s left join months using (m)"""))
def _(spark, sf):
    return people.turnover_series(employees(spark, sf))


# --- tenure and attrition ----------------------------------------------------------


def _tenure_sql(extra: str = "") -> str:
    return sql("emp", f"""
        select department_name, count(*) as employee_count,
            {mean_years("sum(tenure_days)", "count(*)")} as avg_tenure_years
        from emp where not is_placeholder and tenure_days is not null {extra} group by department_name""")


@query("k10_tenure_by_department", _tenure_sql())
def _(spark, sf):
    return people.tenure_by_department(employees(spark, sf))


@query("k11_tenure_by_status", sql("emp", f"""
    agg as (select department_name,
        count(*) filter (where active_status) as active_count,
        sum(tenure_days) filter (where active_status) as active_days,
        count(*) filter (where not active_status) as terminated_count,
        sum(tenure_days) filter (where not active_status) as terminated_days
        from emp where not is_placeholder and tenure_days is not null group by department_name)
    select department_name, active_count, {mean_years("active_days", "active_count")} as avg_tenure_years_active,
        terminated_count, {mean_years("terminated_days", "terminated_count")} as avg_tenure_years_terminated from agg"""))
def _(spark, sf):
    return people.tenure_by_status(employees(spark, sf))


@query("k12_tenure_one_department", _tenure_sql("and department_name = '1-URGENT'"))
def _(spark, sf):
    return people.tenure_by_department(employees(spark, sf), department="1-URGENT")


@query("k13_tenure_leaders", sql("emp", f"""
    agg as (select department_name, {mean_years("sum(tenure_days)", "count(*)")} as avg_tenure_years
        from emp where not is_placeholder and tenure_days is not null group by department_name),
    top as (select department_name, avg_tenure_years,
        case when contains(department_name, '-') then substr(department_name, strpos(department_name, '-') + 1)
            else department_name end as bare
        from agg order by avg_tenure_years desc nulls first, department_name limit 12)
    select department_name, case when length(bare) > 30 then substr(bare, 1, 28) || '…' else bare end as short_label,
        avg_tenure_years from top"""))
def _(spark, sf):
    return people.tenure_leaders(employees(spark, sf))


def _attrition_sql(days: int, count: str, rate: str) -> str:
    return sql("emp", f"""
        agg as (select count(*) as n, count(*) filter (where term_date - hire_date <= {days}) as k
            from emp where not is_placeholder and hire_date is not null)
        select n as total_employees, k as {count}, {percent("k", "n")} as {rate} from agg""")


@query("k29_attrition_90_days", _attrition_sql(
    90, "left_within_90_days_count", "early_attrition_rate_90_day_percentage"))
def _(spark, sf):
    return people.early_attrition(employees(spark, sf))


@query("k30_attrition_6_months", _attrition_sql(
    182, "left_within_6_months_count", "early_attrition_rate_6_month_percentage"))
def _(spark, sf):
    return people.early_attrition(employees(spark, sf), days=people.SIX_MONTHS)


@query("k31_early_leavers", sql("emp", """
    select client_employee_id, full_name, department_name, hire_date, term_date,
        term_date - hire_date as days_employed,
        if(term_date - hire_date > 90, '6 months', '90 days') as attrition_bucket
    from emp where not is_placeholder and hire_date is not null and term_date is not null
        and term_date - hire_date <= 182"""))
def _(spark, sf):
    return people.early_leavers(employees(spark, sf))


@query("k32_attrition_hire_range", sql("emp", """
    select count(*) as total_employees,
        count(*) filter (where term_date - hire_date <= 90) as left_within_90_days,
        count(*) filter (where term_date - hire_date <= 182) as left_within_6_months
    from emp where not is_placeholder and hire_date >= date '1996-01-01' and hire_date <= date '1999-12-31'"""))
def _(spark, sf):
    return people.attrition_counts(employees(spark, sf), start=date(1996, 1, 1), end=date(1999, 12, 31))


# --- hours -----------------------------------------------------------------------

_WEEKS = """weekly as (select client_employee_id, date_trunc('week', punch_apply_date) as w,
    sum(hours_worked) as hours from ts where hours_worked is not null {} group by 1, 2)"""


@query("k14_hours_per_day_by_employee", sql("ts", f"""
    select client_employee_id, count(distinct punch_apply_date) as days_worked,
        {mean_hours("sum(hours_worked)", "count(*)")} as avg_hours_per_day
    from ts where hours_worked is not null group by client_employee_id"""))
def _(spark, sf):
    return hours.hours_per_day_by_employee(timesheets(spark, sf))


@query("k15_hours_per_week_by_employee", sql("ts", f"""
    {_WEEKS.format("")}
    select client_employee_id, count(*) as weeks_worked, {mean_hours("sum(hours)", "count(*)")} as avg_hours_per_week
    from weekly group by client_employee_id"""))
def _(spark, sf):
    return hours.hours_per_week_by_employee(timesheets(spark, sf))


@query("k16_hours_per_day", sql("ts", f"""
    select {mean_hours("sum(hours_worked)", "count(hours_worked)")} as overall_avg_hours_per_day from ts"""))
def _(spark, sf):
    return hours.hours_per_day(timesheets(spark, sf))


@query("k17_hours_per_week", sql("ts", f"""
    {_WEEKS.format("")}
    select {mean_hours("sum(hours)", "count(*)")} as overall_avg_hours_per_week from weekly"""))
def _(spark, sf):
    return hours.hours_per_week(timesheets(spark, sf))


def _summary_sql(extra: str) -> str:
    return sql("ts", f"""
        {_WEEKS.format(extra)},
        d as (select {mean_hours("sum(hours_worked)", "count(*)")} as overall_avg_hours_per_day
            from ts where hours_worked is not null {extra}),
        w as (select {mean_hours("sum(hours)", "count(*)")} as overall_avg_hours_per_week from weekly)
        select * from d, w""")


_ONE_EMPLOYEE = (
    "and client_employee_id = '7' and punch_apply_date >= date '1996-05-05' and punch_apply_date <= date '2000-08-20'"
)
_ONE_EMPLOYEE_ARGS = {"employee_id": "7", "start": date(1996, 5, 5), "end": date(2000, 8, 20)}


@query("k18_hours_summary", _summary_sql(""))
def _(spark, sf):
    return hours.hours_summary(timesheets(spark, sf))


@query("k18_hours_summary_filtered", _summary_sql(_ONE_EMPLOYEE))
def _(spark, sf):
    return hours.hours_summary(timesheets(spark, sf), **_ONE_EMPLOYEE_ARGS)


_DAYS = """daily as (select client_employee_id, punch_apply_date, sum(hours_worked) as daily_hours
    from ts where hours_worked is not null group by 1, 2)"""


def _rolling(days: int) -> str:
    frame = (
        "over (partition by client_employee_id order by punch_apply_date"
        f" rows between {days - 1} preceding and current row)"
    )
    return f"{mean_hours(f'sum(daily_hours) {frame}', f'count(*) {frame}')} as rolling_avg_hours_{days}day"


_ROLLING = f"{_DAYS}, rolling as (select *, {_rolling(7)}, {_rolling(30)} from daily)"
_SNAPSHOT = f"""{_ROLLING}
    select client_employee_id, punch_apply_date as as_of_date, rolling_avg_hours_7day, rolling_avg_hours_30day
    from rolling qualify row_number() over (partition by client_employee_id order by punch_apply_date desc) = 1"""


@query("k26_rolling_hours", sql("ts", f"""
    {_ROLLING}
    select client_employee_id, punch_apply_date, cast(daily_hours as double) as daily_hours,
        rolling_avg_hours_7day, rolling_avg_hours_30day from rolling"""))
def _(spark, sf):
    history = hours.rolling_hours(timesheets(spark, sf))
    return history.withColumn("daily_hours", history["daily_hours"].cast("double"))


@query("k27_rolling_snapshot", sql("ts", _SNAPSHOT))
def _(spark, sf):
    return hours.rolling_snapshot(timesheets(spark, sf))


@query("k28_rolling_top", sql("ts", f"{_SNAPSHOT} order by client_employee_id limit 15"))
def _(spark, sf):
    return hours.rolling_top(timesheets(spark, sf))


# --- attendance --------------------------------------------------------------------


def _by_employee_sql(measure: str) -> str:
    flag, count, _, rate = attendance.MEASURES[measure]
    return sql("ts", f"""
        select client_employee_id, count({flag}) as assessable_punches, count(*) filter (where {flag}) as {count},
            {percent(f"count(*) filter (where {flag})", f"count({flag})")} as {rate}_percentage
        from ts group by client_employee_id having count({flag}) > 0""")


def _overall_sql(measure: str) -> str:
    flag, _, count, rate = attendance.MEASURES[measure]
    return sql("ts", f"""
        select count({flag}) as total_assessable_punches, count(*) filter (where {flag}) as {count},
            {percent(f"count(*) filter (where {flag})", f"count({flag})")} as overall_{rate}_percentage from ts""")


for _place, _measure in ((19, "late_arrival"), (21, "early_departure"), (23, "overtime")):

    @query(f"k{_place}_{_measure}_by_employee", _by_employee_sql(_measure))
    def _(spark, sf, measure=_measure):
        return attendance.by_employee(timesheets(spark, sf), measure)

    @query(f"k{_place + 1}_{_measure}_overall", _overall_sql(_measure))
    def _(spark, sf, measure=_measure):
        return attendance.overall(timesheets(spark, sf), measure)


def _attendance_sql(extra: str = "") -> str:
    rates = [
        f"{percent(f'count(*) filter (where {flag})', f'count({flag})')} as {rate}"
        for flag, _, _, rate in attendance.MEASURES.values()
    ]
    return sql("ts", f"select {', '.join(rates)} from ts where true {extra}")


@query("k25_attendance_summary", _attendance_sql())
def _(spark, sf):
    return attendance.summary(timesheets(spark, sf))


@query("k25_attendance_summary_filtered", _attendance_sql(_ONE_EMPLOYEE))
def _(spark, sf):
    return attendance.summary(timesheets(spark, sf), **_ONE_EMPLOYEE_ARGS)


# --- from daily sums ---------------------------------------------------------------


def _daily(spark, sf):
    """The stored sums after two loads that share employees and days."""
    layers, sheet = Layers(spark, new_folder(spark, "daily")), timesheets(spark, sf)
    second = F.pmod(F.xxhash64("client_employee_id", "punch_in_datetime"), F.lit(3)) == 0
    for load in (sheet.where(~second), sheet.where(second)):
        layers.append(load, daily.SOURCE)
        daily.update(layers)
    return layers.read(daily.TABLE)


@query("k14_from_daily", ORACLES["k14_hours_per_day_by_employee"])
def _(spark, sf):
    return daily.hours_per_day_by_employee(_daily(spark, sf))


@query("k18_from_daily", ORACLES["k18_hours_summary"])
def _(spark, sf):
    return daily.hours_summary(_daily(spark, sf))


@query("k25_from_daily", ORACLES["k25_attendance_summary"])
def _(spark, sf):
    return daily.attendance_summary(_daily(spark, sf))


@query("k27_from_daily", ORACLES["k27_rolling_snapshot"])
def _(spark, sf):
    return hours.rolling_snapshot(daily.per_day(_daily(spark, sf)))
