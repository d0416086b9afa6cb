"""Duplicate and lateness decisions as if events were taken one by one.

The two depend on each other: a duplicate does not move the watermark, and only events that were
stored can make later ones duplicates. ``first_pass`` decides all users whose re-sends are clean
with running aggregates, and flags where that may be wrong; the users it cannot decide go, once,
through the ordered pass of ``fold.one_by_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from trolley.functions.columns import with_exprs
from trolley.operators.dedup import DEDUP_KEY, ttl_micros
from trolley.operators.lateness import judged, with_watermark
from trolley.operators.prefix import running, running_last, running_min

COPIES = ["user_id", DEDUP_KEY]


def first_pass(
    rows: DataFrame, policy: str, allowed_seconds: float, ttl_hours: float
) -> DataFrame:
    """Flag copies of an earlier stored event, and ``irregular`` where that may be wrong.

    ``misfit`` says why an event cannot be stored, if so. Regular copies repeat the event time of
    the first and arrive within the TTL. They meet the same or a higher watermark, so the first
    copy that fits decides for all and none can move the watermark.
    """
    rows = judged(with_watermark(rows), policy, allowed_seconds)
    rows = running(
        rows,
        COPIES,
        ["seq"],
        _kept=running_last(
            "CASE WHEN action <> 'rejected' AND misfit IS NULL THEN true END", include_row=False
        ),
        _previous=running_last("original_timestamp", include_row=False),
        _first=running_min("arrived_at", include_row=False),
    )
    age = "(unix_micros(arrived_at) - unix_micros(_first))"
    return with_exprs(
        rows,
        is_duplicate="_kept IS NOT NULL",
        irregular=(
            "coalesce(_previous <> original_timestamp "
            f"OR {age} >= {ttl_micros(ttl_hours)}, false)"
        ),
    ).drop("_kept", "_previous", "_first")
