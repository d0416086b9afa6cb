"""Reading the stream's state from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.streaming.processor import ITEMS, MARKS, TOTALS, WATERMARK


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("stateVarName", variable)
        .load()
    )


def _entries(spark: SparkSession, checkpoint: str, variable: str, key: str, value: str) -> DataFrame:
    """Map state, one row per entry."""
    return _state(spark, checkpoint, variable).select(
        F.col("key.user_id").alias("user_id"),
        F.col(f"user_map_key.{key}").alias(key),
        F.col(f"user_map_value.{value}").alias(value),
    )


def cart_lines(spark: SparkSession, checkpoint: str) -> DataFrame:
    return _entries(spark, checkpoint, ITEMS, "product_id", "quantity")


def committed_marks(spark: SparkSession, checkpoint: str) -> DataFrame:
    marks = _state(spark, checkpoint, MARKS).select(
        F.col("key.user_id").alias("user_id"),
        F.explode(F.arrays_zip("user_map_value.dedup_keys", "user_map_value.processed_us")).alias("mark"),
    )
    return marks.selectExpr(
        "user_id", "mark.dedup_keys AS dedup_key", "timestamp_micros(mark.processed_us) AS processed_at"
    )


def watermark_stats(spark: SparkSession, checkpoint: str) -> DataFrame:
    return _state(spark, checkpoint, WATERMARK).select(
        F.col("key.user_id").alias("user_id"),
        F.timestamp_micros("value.max_us").alias("max_timestamp"),
        F.timestamp_micros("value.last_processed_us").alias("last_processed"),
        "value.late_event_count",
        "value.adjusted_event_count",
    )


def cart_snapshot(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Each user's cart as of the last committed micro-batch."""
    lines = cart_lines(spark, checkpoint).groupBy("user_id").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct("product_id", "quantity"))
            )
        ).alias("items")
    )
    totals = _state(spark, checkpoint, TOTALS).select(
        F.col("key.user_id").alias("user_id"),
        "value.total_value",
        F.timestamp_micros("value.last_updated_us").alias("last_updated"),
        "value.event_count",
    )
    no_items = F.expr("CAST(map() AS map<bigint, bigint>)")
    return totals.join(lines, "user_id", "left").select(
        "user_id",
        F.coalesce("items", no_items).alias("items"),
        "total_value",
        "last_updated",
        "event_count",
    )
