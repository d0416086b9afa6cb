"""Events as messages keyed by user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.times import ISO_MICROS
from trolley.schemas import EVENT_FIELDS

# The fields of an enriched message.
ENRICHED_FIELDS = [
    *EVENT_FIELDS,
    "processing_lag",
    "is_late",
    "hour_of_day",
    "day_of_week",
    "cart_total_before",
    "cart_total_after",
    "processed_at",
]


def keyed_messages(events: DataFrame, fields: list[str]) -> DataFrame:
    """``(key, value)`` rows; timestamps travel as ISO text."""
    kinds = dict(events.dtypes)
    columns = [
        F.date_format(f, ISO_MICROS).alias(f) if kinds[f].startswith("timestamp") else F.col(f)
        for f in fields
    ]
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return events.select(F.col("user_id").cast("string").alias("key"), value.alias("value"))


def enriched_messages(accepted: DataFrame) -> DataFrame:
    return keyed_messages(accepted, ENRICHED_FIELDS)


def wire_messages(events: DataFrame) -> DataFrame:
    return keyed_messages(events, EVENT_FIELDS)


def to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch, acknowledged by all replicas; needs the Kafka connector."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", topic)
        .save()
    )
