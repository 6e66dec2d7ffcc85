"""Percent of total, and the group with the highest or lowest value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def percent_of_total(count: Column, digits: int = 1) -> Column:
    """For an already aggregated frame of a few groups."""
    total = F.sum(count).over(Window.partitionBy())
    return F.round(count * F.lit(100.0) / total, digits)


def arg_max(label: Column, value: Column, position: Column) -> Column:
    """Label with the highest value; the earliest position wins a tie, NULLs never win."""
    return F.min_by(label, F.when(value.isNotNull(), F.struct(-value, position)))


def arg_min(label: Column, value: Column, position: Column) -> Column:
    return F.min_by(label, F.when(value.isNotNull(), F.struct(value, position)))


def with_percentages(df: DataFrame, total: str, parts: dict[str, str]) -> DataFrame:
    """Append each part as a percentage of the total, under the given name; NULL if the total is 0."""
    whole = F.nullif(F.col(total), F.lit(0).cast("bigint"))
    return df.withColumns({pct: F.round(F.col(part) * F.lit(100.0) / whole, 1) for part, pct in parts.items()})
