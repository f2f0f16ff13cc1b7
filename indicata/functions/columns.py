"""Scalar column expressions used by the dimensional model and the indicator.

All arithmetic on dates is done with integer date parts rather than string
formatting, which keeps the expressions cheap inside generated code.
"""

from __future__ import annotations

import datetime as _dt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract (must match the source system):
# the separator inside hashed keys, the date text format, and the labels
# derived from the diagnosis rank.
KEY_SEPARATOR = "|"
DATE_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"
PRINCIPAL = "Principal"
SECONDARY = "Secondary"
UNKNOWN = "UNKNOWN"


def _as_column(value: Any) -> Column:
    """Columns pass through; any other value becomes a string literal."""
    if isinstance(value, Column):
        return value.cast("string")
    return F.lit(str(value))


def surrogate_key(*parts: Any, sep: str = KEY_SEPARATOR) -> Column:
    """Lower-case hex SHA-256 of the parts joined by ``sep``.

    Uses ``concat`` (NULL when any part is NULL), never ``concat_ws``,
    which would silently skip NULL parts and collide keys.
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_as_column(part))
    return F.sha2(F.concat(*pieces), 256)


def strict_bigint(c: Column, what: str = "id") -> Column:
    """String to 64-bit integer; malformed text fails the job.

    Independent of ``spark.sql.ansi.enabled``: a non-NULL value that does
    not parse raises instead of turning into NULL.
    """
    parsed = c.try_cast("bigint")
    return F.when(
        c.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"invalid {what}: "), c)),
    ).otherwise(parsed)


def safe_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Strict date parse: NULL on any text that is not exactly ``fmt``."""
    return F.try_to_date(c, fmt)


def or_default(c: Column, default: Any) -> Column:
    return F.coalesce(c, F.lit(default))


def _mmdd(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def age_at_admission(birth: Column, admission: Column) -> Column:
    """Calendar-year difference, minus one before the birthday (MMDD compare)."""
    years = F.year(admission) - F.year(birth)
    before_birthday = F.when(_mmdd(admission) < _mmdd(birth), 1).otherwise(0)
    return (years - before_birthday).cast("bigint")


def adult_flag(birth: Column, admission: Column, min_age: int = 18, strict_age: bool = False) -> Column:
    """1 when the *calendar-year* difference reaches ``min_age``; NULL dates give 0.

    The source rule ignores the birthday (a 17-year-old can be adult);
    ``strict_age=True`` uses the birthday-corrected age instead.
    """
    years = age_at_admission(birth, admission) if strict_age else F.year(admission) - F.year(birth)
    return F.when(years >= min_age, 1).otherwise(0).cast("bigint")


def elective_flag(admission_type: Column, value: str = "elective") -> Column:
    return F.when(F.lower(admission_type) == value.lower(), 1).otherwise(0).cast("bigint")


def diag_type(rank: Column) -> Column:
    return F.when(rank == 1, PRINCIPAL).when(rank > 1, SECONDARY).otherwise(UNKNOWN)


def principal_flag(rank: Column) -> Column:
    """1 only for rank 1; NULL or other ranks count as non-principal."""
    return F.when(rank == 1, 1).otherwise(0).cast("bigint")


def present_flag(indicator: Column, yes: str = "Y") -> Column:
    """Case-sensitive: only the exact ``yes`` value gives 1."""
    return F.when(indicator == yes, 1).otherwise(0).cast("bigint")


def date_key(d: Column, start: _dt.date, end: _dt.date) -> Column:
    """``yyyymmdd`` integer for dates inside the date dimension, else -1.

    Equivalent to a left lookup into a day-grain dimension spanning
    ``start..end`` with a -1 member, computed without a join.
    """
    ymd = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    inside = d.between(F.lit(start), F.lit(end))
    return F.when(inside, ymd).otherwise(-1).cast("bigint")


def month_label(d: Column) -> Column:
    return F.date_format(d, MONTH_FORMAT)


def safe_rate(numerator: Column, denominator: Column, digits: int = 3) -> Column:
    """Rounded ratio (HALF_UP); zero or NULL denominator gives NULL."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits)


def text_list(arr: Column, sep: str = ",") -> Column:
    """Flatten an array of strings to text (for comparisons and exports)."""
    return F.array_join(arr, sep)
