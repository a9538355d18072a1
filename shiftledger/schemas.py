"""Fixed table layouts of the raw, staging, curated and quality layers."""

from __future__ import annotations

from pyspark.sql import types as T

NUMBER = T.DecimalType(18, 4)

# Column names and types, in table order.
EMPLOYEE_FIELDS = {
    "client_employee_id": T.StringType(),
    "first_name": T.StringType(),
    "middle_name": T.StringType(),
    "last_name": T.StringType(),
    "preferred_name": T.StringType(),
    "job_code": T.StringType(),
    "job_title": T.StringType(),
    "job_start_date": T.DateType(),
    "organization_id": T.StringType(),
    "organization_name": T.StringType(),
    "department_id": T.StringType(),
    "department_name": T.StringType(),
    "dob": T.DateType(),
    "hire_date": T.DateType(),
    "recent_hire_date": T.DateType(),
    "anniversary_date": T.DateType(),
    "term_date": T.DateType(),
    "years_of_experience": NUMBER,
    "work_email": T.StringType(),
    "address": T.StringType(),
    "city": T.StringType(),
    "state": T.StringType(),
    "zip": T.StringType(),
    "country": T.StringType(),
    "manager_employee_id": T.StringType(),
    "manager_employee_name": T.StringType(),
    "fte_status": T.StringType(),
    "is_per_deim": T.BooleanType(),
    "cell_phone": T.StringType(),
    "work_phone": T.StringType(),
    "scheduled_weekly_hour": NUMBER,
    "active_status": T.BooleanType(),
    "termination_reason": T.StringType(),
    "clinical_level": T.StringType(),
}

TIMESHEET_FIELDS = {
    "client_employee_id": T.StringType(),
    "department_id": T.StringType(),
    "department_name": T.StringType(),
    "home_department_id": T.StringType(),
    "home_department_name": T.StringType(),
    "pay_code": T.StringType(),
    "punch_in_comment": T.StringType(),
    "punch_out_comment": T.StringType(),
    "hours_worked": NUMBER,
    "punch_apply_date": T.DateType(),
    "punch_in_datetime": T.TimestampNTZType(),
    "punch_out_datetime": T.TimestampNTZType(),
    "scheduled_start_datetime": T.TimestampNTZType(),
    "scheduled_end_datetime": T.TimestampNTZType(),
}

# Where a raw row came from. The last two give the position in the file (start
# of the file block, then a counter that rises within the block); together they
# do the work of a serial row id without a global numbering.
LINEAGE_FIELDS = {
    "source_file": T.StringType(),
    "source_path": T.StringType(),
    "loaded_at": T.TimestampType(),
    "source_offset": T.LongType(),
    "source_row": T.LongType(),
}

AUDIT_FIELDS = {"created_at": T.TimestampType(), "updated_at": T.TimestampType()}

FLAG_FIELDS = {
    "is_late_arrival": T.BooleanType(),
    "is_early_departure": T.BooleanType(),
    "is_overtime": T.BooleanType(),
}


def struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _as_text(fields: dict[str, T.DataType]) -> dict[str, T.DataType]:
    return {name: T.StringType() for name in fields}


def _curated_employee() -> dict[str, T.DataType]:
    fields: dict[str, T.DataType] = {}
    for name, kind in EMPLOYEE_FIELDS.items():
        fields[name] = kind
        if name == "preferred_name":
            fields["full_name"] = T.StringType()
        elif name == "term_date":
            fields["tenure_days"] = T.IntegerType()
    return {**fields, "is_placeholder": T.BooleanType()}


CURATED_EMPLOYEE_FIELDS = _curated_employee()
CURATED_TIMESHEET_FIELDS = {
    **{n: k for n, k in TIMESHEET_FIELDS.items() if not n.endswith("_comment")},
    **FLAG_FIELDS,
}

RAW_EMPLOYEE = struct({**_as_text(EMPLOYEE_FIELDS), **LINEAGE_FIELDS})
RAW_TIMESHEET = struct({**_as_text(TIMESHEET_FIELDS), **LINEAGE_FIELDS})
STAGING_EMPLOYEE = struct({**EMPLOYEE_FIELDS, **AUDIT_FIELDS})
STAGING_TIMESHEET = struct({**TIMESHEET_FIELDS, **LINEAGE_FIELDS, "created_at": T.TimestampType()})
CURATED_EMPLOYEE = struct({**CURATED_EMPLOYEE_FIELDS, **AUDIT_FIELDS})
CURATED_TIMESHEET = struct({**CURATED_TIMESHEET_FIELDS, "created_at": T.TimestampType()})

EMPLOYEE_CHANGES = struct({
    "client_employee_id": T.StringType(),
    "op": T.StringType(),
    "seq": T.LongType(),
    "fields": T.MapType(T.StringType(), T.StringType()),
    "batch": T.LongType(),
    "as_of": T.DateType(),
    "made_at": T.TimestampType(),
})

TIMESHEET_DAILY = struct({
    "client_employee_id": T.StringType(),
    "punch_apply_date": T.DateType(),
    "punches": T.LongType(),
    "hours_worked": T.DecimalType(28, 4),
    **{f"{name}_{part}": T.LongType() for name in ("late_arrival", "early_departure", "overtime") for part in ("assessable", "flagged")},
})

CHECK_RESULTS = struct({
    "run_id": T.StringType(),
    "run_at": T.TimestampType(),
    "check_name": T.StringType(),
    "severity": T.StringType(),
    "passed": T.BooleanType(),
    "metric_value": T.DoubleType(),
    "details": T.StringType(),
})

TABLES = {
    "raw.employee_raw": RAW_EMPLOYEE,
    "raw.timesheet_raw": RAW_TIMESHEET,
    "staging.employee_staging": STAGING_EMPLOYEE,
    "staging.timesheet_staging": STAGING_TIMESHEET,
    "curated.employee": CURATED_EMPLOYEE,
    "curated.timesheet": CURATED_TIMESHEET,
    "curated.timesheet_daily": TIMESHEET_DAILY,
    "changes.employee": EMPLOYEE_CHANGES,
    "quality.check_results": CHECK_RESULTS,
}

# Tables kept in one folder per month of a date column, for partition pruning.
MONTHLY = {"curated.timesheet": "punch_apply_date", "curated.timesheet_daily": "punch_apply_date"}

# Columns with a Bloom filter per row group, so that a lookup by a value skips the row groups without it. Row groups with few
# distinct values have a dictionary in its place; filters are written in the smallest size that fits.
BLOOMED = {"curated.timesheet": "client_employee_id"}

# Tables kept in a fixed number of folders by the hash of a key, so that an upsert reads and writes only the folders of its keys.
HASHED = {"staging.employee_staging": "client_employee_id", "curated.employee": "client_employee_id"}
