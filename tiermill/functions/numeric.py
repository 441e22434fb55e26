"""Numeric rules: safe ratios, decimal averages, percent change, strict parsing.

Quotients are taken between ``decimal(18,0)`` or ``decimal(20,0)`` operands. A wider
dividend leaves Spark only six fractional digits and would round twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

STORED_RATIO = "decimal(5,2)"


def numeric_coerce(text: Column) -> Column:
    """Number in the text, 0 for anything that is not a number."""
    return F.coalesce(parse_number(text), F.lit(0.0))


def parse_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def parse_integer(text: Column, kind: str = "int") -> Column:
    """Strict integer: '12.0' and out-of-range values give null."""
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast(kind))


def quotient(dividend: Column, divisor: Column, places: int) -> Column:
    """Half-up decimal quotient, null on a zero or null divisor."""
    top = dividend.cast("decimal(20,0)")
    bottom = F.nullif(divisor.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(top / bottom, places)


def fit_decimal(value: Column, kind: str, on_overflow: str = "raise") -> Column:
    """Store a value in a decimal column type.

    ``raise`` fails the job as a database column would; ``quarantine`` gives null. The load
    keeps the full value of such a cell in a quarantine table.
    """
    if on_overflow not in ("raise", "quarantine"):
        raise ValueError(f"unknown overflow policy {on_overflow!r}")
    fitted = value.try_cast(kind)
    if on_overflow == "quarantine":
        return fitted
    message = F.concat(F.lit(f"value does not fit {kind}: "), value.cast("string"))
    return F.when(value.isNotNull() & fitted.isNull(), F.raise_error(message)).otherwise(fitted)


def safe_ratio(
    a: Column, b: Column, kind: str = STORED_RATIO, on_overflow: str = "raise"
) -> Column:
    """``a / b`` to two places, half away from zero; null unless ``b > 0``."""
    ratio = F.when(b > 0, quotient(a, b, 2))
    return fit_decimal(ratio, kind, on_overflow)


def average(values: Column, places: int = 2) -> Column:
    """Exact average of an integer column; nulls do not count."""
    return quotient(F.sum(values), F.count(values), places)


def average_decimal(values: Column, places: int = 2) -> Column:
    """Exact average of a two-place decimal column, taken over whole hundredths."""
    hundredths = (values * 100).cast("bigint")
    total = F.sum(hundredths).cast("decimal(20,0)")
    count = F.nullif(F.count(values) * 100, F.lit(0)).cast("decimal(18,0)")
    return F.round(total / count, places)


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change to two places, null on a zero or missing base."""
    delta = (current - previous).cast("decimal(18,0)")
    base = F.nullif(previous.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(delta * F.lit(100).cast("decimal(3,0)") / base, 2)


def trend_label(
    current: Column, previous: Column, labels: tuple[str, str, str, str]
) -> Column:
    """Four-way label (no base, up, down, same); a null current value reads as 'same'."""
    base, up, down, same = labels
    return (
        F.when(previous.isNull(), base)
        .when(current > previous, up)
        .when(current < previous, down)
        .otherwise(same)
    )


def member_label(flag: Column, labels: tuple[str, str]) -> Column:
    """Two-way label; a null flag takes the second one."""
    return F.when(flag, labels[0]).otherwise(labels[1])
