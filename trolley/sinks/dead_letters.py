"""Dead letters: the event as it came, why it failed, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.times import ISO_MICROS
from trolley.operators.fold import SINK_RANGE
from trolley.schemas import EVENT_FIELDS


def event_json(timestamp: str = "timestamp") -> Column:
    """The event document; nulls are written out and the time keeps its microseconds."""
    fields = [
        F.date_format(timestamp, ISO_MICROS).alias(name) if name == "timestamp" else F.col(name)
        for name in EVENT_FIELDS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def dead_letter(failed: DataFrame, error: Column, at: str = "arrived_at") -> DataFrame:
    """The text of an unreadable message stands for the event it should have been."""
    original = event_json()
    if "value" in failed.columns:
        original = F.coalesce("value", original)
    return failed.select(
        original.alias("original_event"), error.alias("error"), F.col(at).alias("timestamp")
    )


def dead_letters(results: DataFrame) -> DataFrame:
    """Dead letters of every outcome that has an error: broken rules, rejected late events, and
    events the fact table cannot hold."""
    return dead_letter(results.filter(F.col("error").isNotNull()), F.col("error"))


def late_rejections(results: DataFrame) -> DataFrame:
    return dead_letters(results.filter(F.col("outcome") == "late_rejected"))


def validation_failures(results: DataFrame) -> DataFrame:
    return dead_letters(results.filter(F.col("error").startswith("validation_error")))


def out_of_range(results: DataFrame) -> DataFrame:
    """Events the fact table cannot hold."""
    return dead_letters(results.filter(F.col("outcome") == SINK_RANGE))


def failed_flush(accepted: DataFrame, reason: str) -> DataFrame:
    """Every event of a batch whose write failed."""
    return dead_letter(accepted, F.lit(f"sink_write_failed: {reason}"))
