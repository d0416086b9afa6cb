"""Replaying a plan of events: each row says when to send what."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.times import ISO_SECONDS, moment

# Fixed value: how far behind the send time an event's own time lies unless the plan says so.
DEFAULT_OFFSET_SECONDS = -10


def replay_events(plan: DataFrame, start: datetime | str | Column, run_id: str = "") -> DataFrame:
    """Wire events of a plan (at_second, event_id, …, timestamp_offset_seconds, session_id)."""
    begin = moment(start)
    offset = F.coalesce("timestamp_offset_seconds", F.lit(DEFAULT_OFFSET_SECONDS))
    sent_at = F.timestamp_seconds(F.unix_seconds(begin) + F.col("at_second"))
    event_ts = F.timestamp_seconds(F.unix_seconds(begin) + F.col("at_second") + offset)
    event_id = F.col("event_id")
    if run_id:
        event_id = F.concat_ws("-", F.lit(run_id), event_id)
    session = F.coalesce(
        F.nullif("session_id", F.lit("")),
        F.concat(F.lit("sess_scenario_"), F.col("user_id").cast("string")),
    )
    return plan.select(
        sent_at.alias("sent_at"),
        event_id.alias("event_id"),
        "user_id",
        "event_type",
        "product_id",
        "product_name",
        "quantity",
        "price",
        F.date_format(event_ts, ISO_SECONDS).alias("timestamp"),
        session.alias("session_id"),
    )
