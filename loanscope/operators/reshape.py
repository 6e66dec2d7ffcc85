"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def columns_to_rows(df: DataFrame, keys: Sequence[str], labels: Mapping[str, str], label: str, value: str):
    """One row per key and listed column: (keys, label of the column, its value)."""
    renamed = df.select(*keys, *(F.col(name).alias(text) for name, text in labels.items()))
    return renamed.unpivot(list(keys), list(labels.values()), label, value)


def expressions_to_rows(df: DataFrame, columns: Sequence[str], rows: Sequence[Sequence[Column | str]]):
    """One output row per listed tuple of expressions, evaluated on every input row."""
    structs = [
        F.struct(*(
            (cell if isinstance(cell, Column) else F.lit(cell)).alias(name)
            for name, cell in zip(columns, row, strict=True)
        ))
        for row in rows
    ]
    return df.select(F.inline(F.array(*structs)))
