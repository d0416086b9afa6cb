"""Event rules; the first one broken names the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.functions.columns import text_list

CONSUMER_RULES = ("event_id", "user_id", "event_type", "product_id", "quantity", "price")
PRODUCER_RULES = ("event_type", "product_id", "quantity", "price")
# Rules that compare a number; a null there is not a broken rule but an event no rule can judge.
NUMBER_RULES = ("user_id", "quantity", "price")

_ALLOWED = text_list(S.EVENT_TYPES)
_LISTED = ", ".join(sorted(S.EVENT_TYPES))
# The error texts are part of the contract.
RULES = {
    "event_id": ("coalesce(event_id, '') = ''", "'event_id cannot be empty'"),
    "user_id": ("user_id <= 0", "concat('Invalid user_id: ', user_id)"),
    "event_type": (
        f"coalesce(event_type, '') NOT IN ({_ALLOWED})",
        "concat('Invalid event_type: ', coalesce(event_type, 'None'), "
        f"'. Must be one of: {_LISTED}')",
    ),
    "product_id": (
        f"coalesce(event_type, '') <> '{S.CHECKOUT}' AND coalesce(product_id, 0) = 0",
        "concat('product_id required for ', coalesce(event_type, 'None'))",
    ),
    "quantity": (
        "quantity <= 0 AND coalesce(event_type, '') NOT IN "
        f"('{S.CHECKOUT}', '{S.UPDATE}')",
        "concat('Invalid quantity: ', quantity)",
    ),
    "price": ("price < 0", "concat('Negative price: ', price)"),
}


def rule_error(rules: tuple[str, ...] = CONSUMER_RULES) -> Column:
    """Dead-letter text of the first rule that is broken or cannot be judged, or null."""
    cases = []
    for name in rules:
        if name in NUMBER_RULES:
            cases.append(f"WHEN {name} IS NULL THEN 'unexpected_error: {name} is missing'")
        broken, message = RULES[name]
        cases.append(f"WHEN {broken} THEN concat('validation_error: ', {message})")
    return F.expr(f"CASE {' '.join(cases)} END")


def with_errors(events: DataFrame, rules: tuple[str, ...] = CONSUMER_RULES) -> DataFrame:
    """Add ``error`` (null for a good event); an unreadable message is reported as such."""
    error = rule_error(rules)
    if "decode_error" in events.columns:
        error = F.coalesce("decode_error", error)
    return events.withColumn("error", error)


def valid_events(events: DataFrame, rules: tuple[str, ...] = CONSUMER_RULES) -> DataFrame:
    return with_errors(events, rules).filter("error IS NULL").drop("error", "decode_error")
