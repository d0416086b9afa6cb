"""Out-of-order classification against a watermark of each user's own.

The watermark is the largest event time the user has shown so far. It only classifies; it never
drops state. Late events cannot raise it, so a running maximum over all judged events is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.columns import with_exprs
from trolley.operators.prefix import Keys, per_key, running, running_max
from trolley.schemas import ALLOWED_LATENESS_SECONDS

ACCEPT = "accept"
REJECT = "reject"
ADJUST = "adjust_window"
# What each policy does with a late event inside the tolerance.
TOLERATED = {ACCEPT: "accepted", REJECT: "rejected", ADJUST: "adjusted"}

EPOCH = "timestamp_seconds(0)"


def judged(rows: DataFrame, policy: str, allowed_seconds: float) -> DataFrame:
    """Columns that follow from ``watermark_before``; an adjusted event moves to the watermark."""
    if policy not in TOLERATED:
        raise ValueError(f"policy must be one of {sorted(TOLERATED)}")
    gap = "(unix_micros(watermark_before) - unix_micros(timestamp))"
    allowed = round(allowed_seconds * 1_000_000)
    rows = with_exprs(
        rows,
        is_late="timestamp < watermark_before",
        lateness_seconds=f"greatest(0, {gap}) / 1e6D",
        action=(
            f"CASE WHEN {gap} <= 0 THEN 'on_time' "
            f"WHEN {gap} <= {allowed} THEN '{TOLERATED[policy]}' ELSE 'rejected' END"
        ),
        watermark_after="greatest(timestamp, watermark_before)",
        original_timestamp="timestamp",
    )
    if policy == ADJUST:
        rows = with_exprs(
            rows, timestamp="if(action = 'adjusted', watermark_before, timestamp)"
        )
    return rows


def with_watermark(rows: DataFrame, counted: str | None = None) -> DataFrame:
    """Add the watermark each event meets; ``counted`` limits which events may raise it."""
    ts = f"CASE WHEN {counted} THEN timestamp END" if counted else "timestamp"
    rows = running(rows, ["user_id"], ["seq"], watermark_before=running_max(ts, include_row=False))
    return with_exprs(rows, watermark_before=f"greatest(watermark_before, {EPOCH})")


def classify(
    events: DataFrame,
    hot: Keys,
    policy: str = ACCEPT,
    allowed_seconds: float = ALLOWED_LATENESS_SECONDS,
) -> DataFrame:
    """Judge valid, de-duplicated events of each user in arrival order."""
    return per_key(
        events, "user_id", "seq", hot,
        lambda rows: judged(with_watermark(rows), policy, allowed_seconds),
    )


def watermark_stats(classified: DataFrame) -> DataFrame:
    """Per user: newest event time, last on-time arrival, and late and adjusted counts."""
    action = F.col("action")
    return classified.groupBy("user_id").agg(
        F.max("watermark_after").alias("max_timestamp"),
        F.max(F.when(action == "on_time", F.col("arrived_at"))).alias("last_processed"),
        F.count_if(action.isin("accepted", "rejected")).alias("late_event_count"),
        F.count_if(action == "adjusted").alias("adjusted_event_count"),
    )


def stats_of_user(stats: DataFrame, user_id: int) -> DataFrame:
    """One user's statistics; a user never seen has the initial ones."""
    wanted = stats.sparkSession.range(1).select(F.lit(user_id).cast("bigint").alias("user_id"))
    found = stats.filter(F.col("user_id") == user_id)
    return wanted.join(found, "user_id", "left").selectExpr(
        "user_id",
        f"coalesce(max_timestamp, {EPOCH}) AS max_timestamp",
        "last_processed",
        "coalesce(late_event_count, 0) AS late_event_count",
        "coalesce(adjusted_event_count, 0) AS adjusted_event_count",
    )
