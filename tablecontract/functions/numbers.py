"""Whole numbers and decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: 2^63, the first whole float INTEGER cannot hold.
INT64_LIMIT = 9223372036854775808.0
NOT_WHOLE = "INTEGER takes whole numbers of 64 bits only"


def is_whole_float(value: Column) -> Column:
    """True when a double is finite, has no fraction and fits INTEGER.

    ``try_cast`` is no substitute: it truncates 1.5 and saturates at the limits.
    """
    return F.coalesce(
        ~F.isnan(value) & (value < INT64_LIMIT) & (value >= -INT64_LIMIT) & (value % 1 == 0), F.lit(False)
    )


def whole_float_problem(value: Column) -> Column:
    """Why a double cannot become INTEGER, or NULL when it can."""
    return F.when(value.isNotNull() & ~is_whole_float(value), F.lit(NOT_WHOLE))


def whole_float_to_integer(value: Column) -> Column:
    return F.when(is_whole_float(value), value.cast("bigint"))


def decimal_text(value: Column, scale: int) -> Column:
    """A whole value without a fraction, any other with every digit of the column's scale."""
    if scale == 0:
        return value.cast("string")
    text = value.cast("string")
    # Outside ANSI mode Spark writes very small decimals with an exponent.
    digits = (F.abs(value) * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("decimal(38,0)").cast("string")
    small = F.concat(F.when(value < 0, "-0.").otherwise("0."), F.lpad(digits, scale, "0"))
    return (
        F.when(text.contains("E"), F.when(value == 0, "0").otherwise(small))
        .when(F.rtrim(text, F.lit("0")).endswith("."), F.substring_index(text, ".", 1))
        .otherwise(text)
    )


def is_not_finite(value: Column) -> Column:
    return F.coalesce(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(False))
