"""Duplicates per user and event id.

Copies of one id may be very many, so nothing here gathers them: the first copy is found by a
pre-aggregated minimum or a running window, and marks reach rows by an outer join.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.columns import with_exprs
from trolley.functions.scalars import content_id
from trolley.functions.times import micros_between
from trolley.operators.prefix import Keys, per_key, running, running_last
from trolley.schemas import DEDUP_TTL_HOURS

DEDUP_KEY = "dedup_key"


def ttl_micros(ttl_hours: float) -> int:
    return int(ttl_hours * 3_600_000_000)


def with_dedup_key(events: DataFrame, generate_ids: bool = False) -> DataFrame:
    """The id duplicates are recognised by: the event's own, or one made of its content."""
    key = F.col("event_id")
    if generate_ids:
        key = content_id(
            F.col("user_id"), F.col("event_type"), F.col("product_id"), F.col("timestamp")
        )
    return events.withColumn(DEDUP_KEY, key)


def within_ttl(now: Column, processed_at: Column, ttl_hours: float) -> Column:
    """Strictly younger than the TTL; a mark exactly that old has expired."""
    return micros_between(now, processed_at) < F.lit(ttl_micros(ttl_hours))


def first_copies(events: DataFrame, hot: Keys, generate_ids: bool = False) -> DataFrame:
    """Flag ``is_duplicate`` on every copy after the first of (user, id), by arrival."""

    def step(rows: DataFrame) -> DataFrame:
        seen = running_last("true", include_row=False)
        rows = running(rows, ["user_id", DEDUP_KEY], ["seq"], _seen=seen)
        return with_exprs(rows, is_duplicate="_seen IS NOT NULL").drop("_seen")

    keyed = with_dedup_key(events, generate_ids)
    return per_key(keyed, "user_id", "seq", hot, step)


def committed_marks(events: DataFrame) -> DataFrame:
    """What the store knows of saved events: one row per (user, id) with its newest mark."""
    return events.groupBy("user_id", DEDUP_KEY).agg(F.max("processed_at").alias("processed_at"))


def flag_against_marks(
    events: DataFrame,
    marks: DataFrame,
    ttl_hours: float = DEDUP_TTL_HOURS,
    earliest: datetime | None = None,
) -> DataFrame:
    """Flag events whose (user, id) holds a live mark; nothing is marked, so equal new ones agree.

    ``marks`` may be all of the store's. Those too old to be live when the first event arrived (at
    ``earliest``, looked up if not given) are left out by a filter that reaches the scan. The join
    keeps all events, so adaptive execution can split the partitions of an id with very many copies.
    """
    if earliest is None:
        earliest = events.agg(F.min("arrived_at")).first()[0]
    keys = ["user_id", DEDUP_KEY]
    if earliest is not None:
        oldest = F.lit(earliest) - F.expr(f"make_dt_interval(0, 0, 0, {ttl_micros(ttl_hours) / 1e6!r})")
        marks = marks.filter(F.col("processed_at") > oldest)
    # A second mark of an id would give its events twice.
    newest = marks.groupBy(*keys).agg(F.max("processed_at").alias("_marked"))
    live = within_ttl(F.col("arrived_at"), F.col("_marked"), ttl_hours)
    joined = events.join(newest, keys, "left")
    return joined.withColumn("is_duplicate", F.coalesce(live, F.lit(False))).drop("_marked")
