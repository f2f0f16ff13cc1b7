"""Column-level building blocks: one row in, one value out.

Every function returns a ``pyspark.sql.Column`` made only of built-in
expressions, so it stays inside whole-stage codegen on the executors.
"""

from indicata.functions.columns import (
    adult_flag,
    age_at_admission,
    date_key,
    diag_type,
    elective_flag,
    month_label,
    or_default,
    present_flag,
    principal_flag,
    safe_date,
    safe_rate,
    strict_bigint,
    surrogate_key,
    text_list,
)

__all__ = [
    "adult_flag",
    "age_at_admission",
    "date_key",
    "diag_type",
    "elective_flag",
    "month_label",
    "or_default",
    "present_flag",
    "principal_flag",
    "safe_date",
    "safe_rate",
    "strict_bigint",
    "surrogate_key",
    "text_list",
]
