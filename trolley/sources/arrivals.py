"""Cart arrivals derived from a generic ``events`` table.

The table itself is clean and ordered, so the projection plants re-sends, late rows and rule
violations by arithmetic on the event number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.operators.prefix import Keys, hot_keys, per_key, running, running_last


COLUMNS = ["event_id", "user_id", "event_type", "props", "ts"]


def hot_users(events: DataFrame) -> Keys:
    return hot_keys(events.select("user_id"), "user_id")


def with_previous_ts(events: DataFrame, hot: Keys) -> DataFrame:
    def step(rows: DataFrame) -> DataFrame:
        return running(
            rows, ["user_id"], ["event_id"], previous_ts=running_last("ts", include_row=False)
        )

    return per_key(events, "user_id", "event_id", hot, step)


def _as_cart_events(events: DataFrame, shifted: Column) -> DataFrame:
    """Cart events with re-sends; ``shifted`` is the event time a row claims."""
    kind, number = "event_type", "event_id"
    rows = events.select(
        F.expr(number).alias("number"),
        "user_id",
        F.expr(
            f"CASE {kind} WHEN 'view' THEN '{S.ADD}' "
            f"WHEN 'click' THEN if({number} % 2 = 0, '{S.ADD}', '{S.UPDATE}') "
            f"WHEN 'error' THEN '{S.REMOVE}' WHEN 'purchase' THEN '{S.CHECKOUT}' "
            "ELSE 'signup' END"
        ).alias("event_type"),
        F.expr(
            f"CASE WHEN {kind} <> 'purchase' "
            "THEN try_cast(get_json_object(props, '$.k') AS BIGINT) % 20 END"
        ).alias("product_id"),
        F.expr(f"if({kind} = 'purchase', 0, CAST({number} % 5 AS INT))").alias("quantity"),
        shifted.alias("timestamp"),
        F.col("ts").alias("arrived_at"),
        # A re-send is the same event arriving one second later: no second scan.
        F.expr(f"explode(if({number} % 20 = 4, array(0, 1), array(0)))").alias("copy"),
    )
    return rows.withColumn(
        "arrived_at", F.expr("arrived_at + make_dt_interval(0, 0, 0, copy)")
    ).selectExpr(
        "number * 2 + copy AS seq",
        "arrived_at",
        "CAST(number AS STRING) AS event_id",
        "user_id",
        "event_type",
        "product_id",
        "concat('p', product_id) AS product_name",
        "quantity",
        f"CASE WHEN event_type = '{S.CHECKOUT}' THEN 0D "
        "ELSE CAST(9.99 + 10 * coalesce(product_id, 0) AS DOUBLE) END AS price",
        "timestamp",
        "concat('s', user_id, '-', CAST(arrived_at AS DATE)) AS session_id",
    )


def cart_arrivals(events: DataFrame, hot: Keys) -> DataFrame:
    """Arrivals in which some events claim a time shortly before their user's previous event."""
    events = with_previous_ts(events.select(*COLUMNS), hot)
    shifted = F.expr(
        "CASE event_id % 10 WHEN 3 THEN coalesce(previous_ts - INTERVAL 180 SECONDS, ts) "
        "WHEN 7 THEN coalesce(previous_ts - INTERVAL 600 SECONDS, ts) ELSE ts END"
    )
    return _as_cart_events(events, shifted)


def shifted_arrivals(events: DataFrame) -> DataFrame:
    """Arrivals whose late rows lie a fixed time back, so no row needs another: works on streams."""
    shifted = F.expr(
        "CASE event_id % 10 WHEN 3 THEN ts - INTERVAL 12 HOURS "
        "WHEN 7 THEN ts - INTERVAL 72 HOURS ELSE ts END"
    )
    return _as_cart_events(events, shifted)
