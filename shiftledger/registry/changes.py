"""Change-set queries: customers are the employees, orders the edits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.operators import apply_changes
from shiftledger.plans.curate import curate_employees
from shiftledger.plans.edits import store_changes
from shiftledger.plans.refresh import load_employees
from shiftledger.registry import query
from shiftledger.registry.bridge import RULES, table
from shiftledger.registry.tables import BEFORE
from shiftledger.schemas import AUDIT_FIELDS, EMPLOYEE_FIELDS
from shiftledger.session import new_folder
from shiftledger.sources import Layers

ID = "client_employee_id"
SHOWN = [
    ID, "first_name", "last_name", "full_name", "department_name", "hire_date", "term_date", "tenure_days",
    "active_status", "is_placeholder",
]


def _staged(spark, sf) -> DataFrame:
    known = {
        ID: F.col("c_custkey").cast("string"),
        "first_name": F.col("c_mktsegment"),
        "middle_name": F.lit("M"),
        "last_name": F.col("c_name"),
        "department_name": F.concat(F.lit("D"), F.col("c_nationkey").cast("string")),
        "hire_date": F.lit("1994-03-01"),
        "active_status": F.lit(True),
    }
    return table(spark, sf, "customer").select(*[
        known.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in EMPLOYEE_FIELDS.items()
    ])


def _people(spark, sf) -> DataFrame:
    return curate_employees(_staged(spark, sf), RULES).withColumns(
        {name: F.lit(BEFORE).cast(kind) for name, kind in AUDIT_FIELDS.items()}
    )


_CHANGE_ID = "case when o_orderkey % 5 < 2 then concat('N', cast(o_custkey as {text})) else cast(o_custkey as {text}) end"
_OP = "case o_orderkey % 6 when 0 then 'create' when 1 then 'delete' when 2 then 'rename' else 'update' end"
# Which fields a change gives, by the last digit of its key.
_GIVES = {
    "first_name": "o_orderkey % 10 in (0, 3, 4, 6)",
    "last_name": "o_orderkey % 10 in (0, 5, 6)",
    "department_name": "o_orderkey % 10 in (3, 7, 8)",
    "hire_date": "o_orderkey % 10 in (0, 1, 2, 8)",
    "active_status": "o_orderkey % 10 in (7)",
}
_VALUE = {
    "first_name": "case when o_orderkey % 4 = 0 then null else o_orderpriority end",
    "last_name": "case when o_orderkey % 11 = 0 then '' else o_orderstatus end",
    "department_name": "concat('E', cast(o_orderkey % 30 as {text}))",
    "hire_date": "case when o_orderkey % 23 = 0 then 'someday' else cast(cast(o_orderdate as date) as {text}) end",
    "active_status": "case when o_orderkey % 2 = 0 then 'false' else 'true' end",
}


def _changes(spark, sf) -> DataFrame:
    entries = [
        F.when(F.expr(_GIVES[name]), F.struct(F.lit(name).alias("key"), F.expr(value.format(text="string")).alias("value")))
        for name, value in _VALUE.items()
    ]
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.expr(_OP).alias("op"),
        F.expr(_CHANGE_ID.format(text="string")).alias(ID),
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("fields"),
    )


def _gives(name: str) -> str:
    return f"({_GIVES[name]})"


_ANY = " or ".join(_gives(name) for name in _GIVES)
_SQL_VALUES = ", ".join(f"{value.format(text='varchar')} as v_{name}" for name, value in _VALUE.items())
_SQL_GIVES = ", ".join(f"{_gives(name)} as g_{name}" for name in _GIVES)
_VIEWS = f"""
    with people as (select cast(c_custkey as varchar) as id, c_mktsegment as first_name, c_name as last_name,
            concat_ws(' ', c_mktsegment, 'M', c_name) as full_name, 'D' || c_nationkey as department_name,
            date '1994-03-01' as hire_date, date '2002-01-01' - date '1994-03-01' as tenure_days from customer),
    changes as (select o_orderkey as seq, {_OP} as op, {_CHANGE_ID.format(text="varchar")} as id,
            ({_ANY}) as any_field, {_SQL_GIVES}, {_SQL_VALUES} from orders),
    formed as (select *, case when op = 'rename' then 'unknown operation'
            when op in ('create', 'update') and g_hire_date and v_hire_date = 'someday' then 'field value has the wrong type'
            end as form_error from changes),
    dated as (select *, min(case when form_error is null and op = 'create' then seq end) over (partition by id) as first_create,
            id in (select id from people) as held from formed),
    judged as (select *, case when form_error is not null then form_error
            when op = 'create' and (held or seq > first_create) then 'id already exists'
            when op <> 'create' and not held and (first_create is null or seq < first_create) then 'id not found'
            when op = 'update' and not any_field then 'no fields to update' end as reason from dated),
    done as (select *, (op = 'create') as c, (op = 'delete') as d from judged where reason is null),
    last as (select id, bool_or(c) as made,
            arg_max({{'v': case when c and not g_first_name then null else v_first_name end}}, seq) filter (where c or (not d and g_first_name)) as first_name,
            arg_max({{'v': case when c and not g_last_name then null else v_last_name end}}, seq) filter (where c or (not d and g_last_name)) as last_name,
            arg_max({{'v': case when c and not g_department_name then null else v_department_name end}}, seq)
                filter (where c or (not d and g_department_name)) as department_name,
            arg_max({{'v': case when c and not g_hire_date then null else try_cast(v_hire_date as date) end}}, seq)
                filter (where c or (not d and g_hire_date)) as hire_date,
            arg_max({{'v': case when d then false when c and not g_active_status then true else v_active_status = 'true' end}}, seq)
                filter (where c or d or g_active_status) as active_status,
            arg_max({{'v': case when d then date '2002-01-01' end}}, seq) filter (where c or d) as term_date,
            max(seq) filter (where not c and not d and (g_first_name or g_last_name)) as renamed,
            arg_max({{'v': case when g_hire_date then date '2002-01-01' - try_cast(v_hire_date as date) else 0 end}}, seq)
                filter (where c) as tenure
        from done group by id),
    joined as (select coalesce(p.id, l.id) as client_employee_id,
            case when l.first_name is not null then l.first_name.v else p.first_name end as first_name,
            case when l.last_name is not null then l.last_name.v else p.last_name end as last_name,
            case when l.department_name is not null then l.department_name.v else p.department_name end as department_name,
            case when l.hire_date is not null then l.hire_date.v else p.hire_date end as hire_date,
            case when l.term_date is not null then l.term_date.v end as term_date,
            case when l.active_status is not null then l.active_status.v else true end as active_status,
            case when p.id is not null then p.tenure_days else l.tenure.v end as tenure_days,
            false as is_placeholder, p.full_name as old_name, l.renamed, l.made
        from people p full join last l on p.id = l.id)"""
_NAME = """case when renamed is not null or made then coalesce(nullif(concat_ws(' ', nullif(first_name, ''), nullif(last_name, '')), ''),
    client_employee_id) else old_name end as full_name"""


def _table_sql(which: str) -> str:
    columns = ", ".join(_NAME if name == "full_name" else name for name in SHOWN)
    return f"{_VIEWS} select {columns} from joined where {which}"


def _applied(spark, sf) -> DataFrame:
    after, _ = apply_changes(_people(spark, sf), _changes(spark, sf), RULES)
    return after.select(*SHOWN)


@query("ch1_created_employees", _table_sql("client_employee_id like 'N%'"))
def _(spark, sf):
    return _applied(spark, sf).where(F.col(ID).startswith("N"))


@query("ch2_updated_employees", _table_sql("client_employee_id not like 'N%'"))
def _(spark, sf):
    return _applied(spark, sf).where(~F.col(ID).startswith("N"))


@query("ch3_deleted_employees", _table_sql("term_date is not null"))
def _(spark, sf):
    return _applied(spark, sf).where(F.col("term_date").isNotNull())


@query("ch_refused_changes", f"""{_VIEWS}
    select seq, op, id as client_employee_id, reason from judged where reason is not null""")
def _(spark, sf):
    _, refused = apply_changes(_people(spark, sf), _changes(spark, sf), RULES)
    return refused


_RELOADED_NAME = "case when c_custkey % 7 = 0 then concat_ws(' ', nullif(first_name, ''), 'M', 'L' || c_custkey) else {} end"


@query("ch_after_reload", f"""{_VIEWS},
    shown as (select * replace (case when c_custkey % 5 = 0 then 'F' || c_nationkey else department_name end as department_name),
            {_NAME}, c_custkey
        from joined left join customer on client_employee_id = cast(c_custkey as varchar))
    select client_employee_id, first_name, case when c_custkey % 7 = 0 then 'L' || c_custkey else last_name end as last_name,
        {_RELOADED_NAME.format("full_name")} as full_name, department_name, hire_date, term_date,
        case when c_custkey is null then tenure_days else date '2002-01-01' - hire_date end as tenure_days,
        active_status, is_placeholder
    from shown""")
def _(spark, sf):
    """Load, stored changes, and two more loads: the same records again, then some with other departments and names."""
    layers = Layers(spark, new_folder(spark, "edited"))
    staged, key = _staged(spark, sf), F.col(ID).cast("long")
    layers.replace(staged, "staging.employee_staging")
    load_employees(layers, RULES)
    store_changes(layers, _changes(spark, sf), RULES)
    other = staged.withColumns({
        "department_name": F.when(key % 5 == 0, F.concat(F.lit("F"), F.substring("department_name", 2, 9))).otherwise(F.col("department_name")),
        "last_name": F.when(key % 7 == 0, F.concat(F.lit("L"), F.col(ID))).otherwise(F.col("last_name")),
    })
    for again in (staged, other):
        layers.replace(again, "staging.employee_staging")
        load_employees(layers, RULES)
    return layers.read("curated.employee").select(*SHOWN)


@query("ch_log", f"""{_VIEWS} select op, count(*) as n, min(seq) as first, max(seq) as last from changes group by 1""")
def _(spark, sf):
    """The stored log, refused changes included."""
    layers = Layers(spark, new_folder(spark, "edited"))
    layers.replace(_people(spark, sf), "curated.employee")
    store_changes(layers, _changes(spark, sf), RULES)
    return layers.read("changes.employee").groupBy("op").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last")
    )
