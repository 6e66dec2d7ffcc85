"""Calendar differences that count crossed boundaries, not completed units.

31 Dec to 1 Jan is one year, one quarter and one month apart. Spark's own
``datediff(unit, …)`` counts completed units, so these are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def years_between(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)).cast("bigint")


def quarters_between(start: Column, end: Column) -> Column:
    return years_between(start, end) * 4 + F.quarter(end) - F.quarter(start)


def months_between(start: Column, end: Column) -> Column:
    return years_between(start, end) * 12 + F.month(end) - F.month(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def quarter_start(column: Column) -> Column:
    return F.trunc(column, "quarter")
