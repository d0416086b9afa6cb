"""Scalar helpers on event columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trolley.functions.times import iso_text


def content_id(user_id: Column, event_type: Column, product_id: Column, ts: Column) -> Column:
    """An id derived from what the event says, for producers that send none."""
    product = F.coalesce(product_id.cast("string"), F.lit("None"))
    return F.md5(F.concat_ws(":", user_id.cast("string"), event_type, product, iso_text(ts)))


def integer_keys(items: Column) -> Column:
    """A cart's items as read from JSON (text keys) keyed by product number again."""
    return F.transform_keys(items, lambda key, _: key.cast("bigint"))
