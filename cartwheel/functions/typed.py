"""Null-safe typing helpers for all-string warehouse columns.

The session runs with ANSI mode on, so a bare cast of a string column raises
on '' or '7.0'. Every numeric read of a string column goes through these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_long(x) -> Column:
    """String -> bigint; '', garbage and fractional text become NULL."""
    return _c(x).try_cast("bigint")


def to_int(x) -> Column:
    """String -> int; anything that is not an integer becomes NULL."""
    return _c(x).try_cast("int")


def to_double(x) -> Column:
    """String -> double; unparsable text becomes NULL."""
    return _c(x).try_cast("double")


def to_whole(x) -> Column:
    """String -> int by its value: '7' and '7.0' are 7, '7.9' is cut to 7;
    blank or unparsable text becomes NULL."""
    return F.coalesce(to_int(x), to_double(x).try_cast("int"))


def blank_to_zero(x, as_type: str = "double") -> Column:
    """``if(x='', 0, x)`` as a number: blank, NULL or unparsable -> 0. Whole
    types take the value cut to a whole number, so '15.0' is 15."""
    value = to_double(x) if as_type == "double" else to_whole(x).cast(as_type)
    return F.coalesce(value, F.lit(0).cast(as_type))


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL instead of an error."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round6(x) -> Column:
    """Round to 6 decimals (how doubles are compared across engines)."""
    return F.round(_c(x), 6)


def hour_gap(hour, last_hour, circular: bool = False) -> Column:
    """Distance between two hours of day: ``min(g, 24 - g)`` with
    ``g = hour - last_hour`` as the reference writes it (negative gaps give a
    negative result); ``circular=True`` uses ``|g|`` so the result is always in
    [0, 12]. A NULL hour gives NULL (``least`` would otherwise skip it)."""
    g = _c(hour) - _c(last_hour)
    if circular:
        g = F.abs(g)
    return F.when(g.isNull(), F.lit(None)).otherwise(F.least(g, F.lit(24) - g))


def plus_columns(a, b) -> Column:
    """Sum of two string columns read as integers (NULL if either is not one)."""
    return to_int(a) + to_int(b)
