from shiftledger.operators.changes import apply_changes
from shiftledger.operators.constraints import ConstraintViolation, Rule, enforce
from shiftledger.operators.keyed import first_per_key, insert_absent, missing_keys, upsert

__all__ = [
    "ConstraintViolation", "Rule", "apply_changes", "enforce", "first_per_key", "insert_absent",
    "missing_keys", "upsert",
]
