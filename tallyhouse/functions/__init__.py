"""Column expressions shared by operators and marts (all JVM-side)."""

from tallyhouse.functions.clean import (
    bucketize,
    change_hash,
    code_or_null,
    composite_id,
    concat_skip_null,
    empty_if_null,
    key_hash,
    null_if_blank,
    safe_bool,
    salted_hash,
)
from tallyhouse.functions.dates import days_between, grain, hours_between, month_days
from tallyhouse.functions.measures import (
    clamp01,
    count_if,
    credit,
    invoiced,
    money,
    percent_if,
    ratio,
    round_to,
    signed,
    sum_if,
)

__all__ = [
    "bucketize", "change_hash", "clamp01", "code_or_null", "composite_id", "concat_skip_null",
    "count_if", "credit", "days_between", "empty_if_null", "grain", "hours_between", "invoiced",
    "key_hash", "money", "month_days", "null_if_blank", "percent_if", "ratio", "round_to",
    "safe_bool", "salted_hash", "signed", "sum_if",
]
