"""Adding columns by SQL expression: long per-event rules read best as SQL, and reach the JVM in
one piece."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_exprs(df: DataFrame, **expressions: str) -> DataFrame:
    """Add or replace columns; every expression sees the columns as they were before."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def text_list(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)
