"""Income, pricing and rate arithmetic. Denominators are guarded before dividing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def total_income(*parts: Column) -> Column:
    zero = F.lit(0.0)
    total = zero
    for part in parts:
        total = total + F.coalesce(part, zero)
    return total


def monthly_income(total: Column, duration: Column) -> Column:
    return F.when(duration > 0, total / duration)


def financing_markup(loan_price: Column, cash_price: Column) -> Column:
    return loan_price - cash_price


def markup_percentage(loan_price: Column, cash_price: Column) -> Column:
    return F.when(cash_price > 0, (loan_price - cash_price) / cash_price * 100)


def share32(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` in 32-bit floats (Spark widens float / float to double)."""
    quotient = (part.cast("float") / whole.cast("float")).cast("float")
    return quotient * F.lit(100).cast("float")


def rate32(part: Column, whole: Column) -> Column:
    """:func:`share32`, 0 where the whole is not positive."""
    return F.when(whole > 0, share32(part, whole)).otherwise(F.lit(0).cast("float"))


def rate(part: Column, whole: Column) -> Column:
    """Percentage in doubles, 0 where the whole is not positive."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def fixed(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, ties to even."""
    return F.format_string(f"%.{digits}f", F.bround(value.cast("double"), digits))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)
