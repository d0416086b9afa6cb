"""Ordered and latest-row listings, and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.times import moment, whole_second
from trolley.schemas import RETENTION_DAYS


def latest_events(fact: DataFrame, rows: int = 10) -> DataFrame:
    """The newest rows by processing time; each task keeps only its own newest."""
    return fact.orderBy(F.desc("processed_at"), "event_id").limit(rows)


def latest_per_key(changes: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The newest row of every key, by a pre-aggregating maximum instead of a sort."""
    others = [c for c in changes.columns if c != key]
    newest = changes.groupBy(key).agg(
        F.max_by(F.struct(*others), F.struct(at, tie)).alias("_newest")
    )
    return newest.select(key, "_newest.*")


def listed(changes: DataFrame, *order: str) -> DataFrame:
    return changes.orderBy(*order)


def retained(
    fact: DataFrame,
    as_of: datetime | str | Column | None = None,
    days: int = RETENTION_DAYS,
) -> DataFrame:
    """Rows that have not reached their retention age, which counts whole seconds.

    The bound is on the bare column, and on the table's partition column where there is one, so that
    whole days are never opened.
    """
    horizon = moment(as_of) - F.make_dt_interval(days=F.lit(days))
    kept = fact.filter(
        F.col("processed_at") >= whole_second(horizon) + F.make_dt_interval(secs=F.lit(1))
    )
    if "processed_date" in fact.columns:
        kept = kept.filter(F.col("processed_date") >= F.to_date(horizon))
    return kept
