"""Aggregate expressions with the fact table's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_all() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """Zero, not null, when nothing matches."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def avg_double(total: Column, rows: Column) -> Column:
    """Average from an exact sum and a count, so partial results can be merged."""
    return total.cast("double") / rows
