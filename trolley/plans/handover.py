"""What a stream has to know to go on where batches ended.

The state is a table of pieces, several a user: an hour's marks (or a part of them), a line of the cart,
the watermark, the cart's totals. No piece grows with the user, and the stream takes them one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.cart import cart_snapshot
from trolley.operators.dedup import DEDUP_KEY, ttl_micros
from trolley.operators.enrich import IS_ACCEPTED
from trolley.operators.lateness import watermark_stats
from trolley.plans.batch import INVALID, Settings
from trolley.operators.fold import DUPLICATE
from trolley.schemas import CHECKOUT
from trolley.streaming.marks import ALL, PARTS, SLICE_US, WHOLE

#: The pieces' columns; each kind of piece fills its own and leaves the others empty.
PIECES = {
    "slice": "bigint",
    "part": "int",
    "dedup_keys": "array<string>",
    "processed_us": "array<bigint>",
    "product_id": "bigint",
    "quantity": "bigint",
    "max_us": "bigint",
    "last_processed_us": "bigint",
    "late_event_count": "bigint",
    "adjusted_event_count": "bigint",
    "total_value": "double",
    "event_count": "bigint",
    "last_updated_us": "bigint",
    "cart_epoch": "bigint",
}


def live_marks(results: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``user_id, dedup_key, marked_us`` of stored events that can still make others duplicates: marks
    that had expired for their user's newest arrival are left out."""
    newest = results.filter(F.col("outcome") != INVALID).groupBy("user_id").agg(
        F.max(F.unix_micros("arrived_at")).alias("_newest")
    )
    marks = results.filter(IS_ACCEPTED).groupBy("user_id", DEDUP_KEY).agg(
        F.max(F.unix_micros("arrived_at")).alias("marked_us")
    )
    live = F.col("_newest") - F.col("marked_us") < ttl_micros(settings.ttl_hours)
    return marks.join(newest, "user_id").filter(live).drop("_newest")


def mark_pieces(marks: DataFrame) -> DataFrame:
    """An hour's marks of a user as one piece, or as ``PARTS`` if there are more than ``WHOLE``."""
    sliced = marks.withColumn("slice", F.expr(f"marked_us DIV {SLICE_US}"))
    sizes = sliced.groupBy("user_id", "slice").agg(F.count("*").alias("_n"))
    part = F.when(F.col("_n") > WHOLE, F.crc32(DEDUP_KEY) % PARTS).otherwise(ALL).cast("int")
    parts = sliced.join(sizes, ["user_id", "slice"]).withColumn("part", part)
    held = parts.groupBy("user_id", "slice", "part").agg(F.collect_list(F.struct(DEDUP_KEY, "marked_us")).alias("_held"))
    return held.selectExpr(
        "user_id", "slice", "part", f"_held.{DEDUP_KEY} AS dedup_keys", "_held.marked_us AS processed_us"
    )


def stream_state(results: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The state after ``results`` (all outcomes up to the hand-over), as pieces per user."""
    judged = results.filter(F.col("outcome") != INVALID)
    stats = watermark_stats(judged.filter(F.col("outcome") != DUPLICATE)).selectExpr(
        "user_id",
        "unix_micros(max_timestamp) AS max_us",
        "unix_micros(last_processed) AS last_processed_us",
        "late_event_count",
        "adjusted_event_count",
    )
    accepted = results.filter(IS_ACCEPTED)
    carts = cart_snapshot(accepted)
    epochs = accepted.groupBy("user_id").agg(
        F.max(F.col("cart_epoch") + (F.col("event_type") == CHECKOUT).cast("bigint")).alias("cart_epoch")
    )
    totals = carts.join(epochs, "user_id").selectExpr(
        "user_id", "total_value", "event_count", "unix_micros(last_updated) AS last_updated_us", "cart_epoch"
    )
    lines = carts.select("user_id", F.explode("items").alias("product_id", "quantity"))
    pieces = [mark_pieces(live_marks(results, settings)), lines, stats, totals]

    def filled(piece: DataFrame) -> DataFrame:
        own = {c: F.col(c) if c in piece.columns else F.lit(None) for c in PIECES}
        return piece.select("user_id", *[own[c].cast(kind).alias(c) for c, kind in PIECES.items()])

    return reduce(DataFrame.unionByName, map(filled, pieces))
