"""Columns an accepted event gains on its way to the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trolley.functions.columns import text_list, with_exprs
from trolley.operators.fold import MAX_QUANTITY, MAX_UINT32, SINK_RANGE
from trolley.schemas import FACT

ACCEPTED = ("saved", "saved_late")
IS_ACCEPTED = f"outcome IN ({text_list(ACCEPTED)})"
MONEY = "decimal(10,2)"


def enriched(accepted: DataFrame) -> DataFrame:
    """Add lag, hour and weekday; the arrival time is the processing time, so replays agree."""
    return with_exprs(
        accepted,
        processed_at="arrived_at",
        processing_lag="(unix_micros(arrived_at) - unix_micros(timestamp)) / 1e6D",
        hour_of_day="hour(timestamp)",
        day_of_week="weekday(timestamp)",
    )


def misfit() -> str:
    """Why an event by itself does not fit the fact table, or null."""
    cases = [
        f"WHEN quantity NOT BETWEEN 0 AND {MAX_QUANTITY} THEN '{SINK_RANGE}: quantity'",
        f"WHEN coalesce(product_id, 0) NOT BETWEEN 0 AND {MAX_UINT32} "
        f"THEN '{SINK_RANGE}: product_id'",
        f"WHEN try_cast(price AS {MONEY}) IS NULL THEN '{SINK_RANGE}: price'",
    ]
    return f"CASE {' '.join(cases)} END"


def fact_rows(events: DataFrame) -> DataFrame:
    """The fact columns of enriched events, in table order."""
    columns = {
        "product_id": "coalesce(product_id, 0L)",
        "product_name": "coalesce(product_name, '')",
        "timestamp": "date_trunc('MILLISECOND', timestamp)",
        "processed_at": "date_trunc('MILLISECOND', processed_at)",
        "processing_lag": "greatest(0L, CAST(processing_lag AS BIGINT))",
    }
    return events.selectExpr(
        *[
            f"try_cast({columns.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in FACT.fields
        ]
    )
