"""The whole event job on a batch: one outcome per arrival."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.functions.columns import with_exprs
from trolley.operators import lateness
from trolley.operators.cart import with_cart
from trolley.operators.dedup import DEDUP_KEY, ttl_micros, with_dedup_key
from trolley.operators.enrich import IS_ACCEPTED, enriched, fact_rows, misfit
from trolley.operators.fold import (
    DECISION,
    DUPLICATE,
    LATE_ERROR,
    LATE_REJECTED,
    MAX_CENTS,
    SAVED,
    SAVED_LATE,
    SINK_RANGE,
    one_by_one,
)
from trolley.operators.expiry import flag_expiring, in_order
from trolley.operators.lateness import ACCEPT
from trolley.operators.prefix import Keys, hot_keys, per_key, split_by_keys
from trolley.operators.sequential import first_pass
from trolley.operators.validate import CONSUMER_RULES, valid_events, with_errors
from trolley.session import stored

INVALID = "invalid"


@dataclass(frozen=True)
class Settings:
    """``clean_resends=True`` asserts that copies of an event repeat its event time and arrive
    within the TTL, and that no cart's total outgrows the fact table; the plan is then a single
    lazy pass. A total that does outgrow it fails the query.

    ``sweep_after`` is for streams: how far one partition's arrivals may be behind another's. Marks
    leave the state when the newest arrival is that much past their end; without it they stay until
    their id comes again. ``bloom_bits`` makes a stream keep marks as Bloom filters of so many bits an
    hour and user: no duplicate is missed, some events are taken for one."""

    policy: str = ACCEPT
    allowed_seconds: float = S.ALLOWED_LATENESS_SECONDS
    ttl_hours: float = S.DEDUP_TTL_HOURS
    generate_ids: bool = False
    rules: tuple[str, ...] = CONSUMER_RULES
    clean_resends: bool = False
    sweep_after: str | None = "1 day"
    bloom_bits: int | None = None


# Columns only judged events have; invalid ones carry nulls of the same types.
OUTCOME_COLUMNS = {
    DEDUP_KEY: "string",
    "is_late": "boolean",
    "lateness_seconds": "double",
    "action": "string",
    "watermark_before": "timestamp",
    "watermark_after": "timestamp",
    "original_timestamp": "timestamp",
    "cart_epoch": "bigint",
    "line_quantity": "bigint",
    "cart_total_before": "double",
    "cart_total_after": "double",
    "cart_changed": "boolean",
    "outcome": "string",
    "error": "string",
}


def _with_outcomes(rows: DataFrame, hot: Keys) -> DataFrame:
    """Outcomes and carts of events that are judged and flagged as duplicates or not."""
    # A duplicate is never judged for lateness.
    rows = with_exprs(
        rows,
        outcome=(
            f"CASE WHEN is_duplicate THEN '{DUPLICATE}' "
            f"WHEN action = 'rejected' THEN '{LATE_REJECTED}' "
            f"WHEN misfit IS NOT NULL THEN '{SINK_RANGE}' "
            f"WHEN is_late THEN '{SAVED_LATE}' ELSE '{SAVED}' END"
        ),
        timestamp="if(is_duplicate, original_timestamp, timestamp)",
        is_late="is_late AND NOT is_duplicate",
        lateness_seconds="if(is_duplicate, 0D, lateness_seconds)",
        action="if(is_duplicate, NULL, action)",
        watermark_after="if(is_duplicate, watermark_before, watermark_after)",
    ).drop("is_duplicate")
    return with_exprs(
        with_cart(rows, hot, applies=IS_ACCEPTED),
        error=(
            f"CASE WHEN outcome = '{LATE_REJECTED}' THEN '{LATE_ERROR}' "
            f"WHEN outcome = '{SINK_RANGE}' THEN misfit END"
        ),
        _outgrown=f"coalesce(abs(cart_total_after) * 100 > {MAX_CENTS}.5D, false)",
    ).drop("misfit")


def judged_outcomes(
    valid: DataFrame, settings: Settings = Settings(), hot: Keys = None
) -> DataFrame:
    """Outcomes and carts of valid events.

    Without the promise of ``clean_resends`` the first pass is stored, and the users it cannot
    decide (a re-send that claims another time or comes after the TTL, a cart that outgrows the fact
    table) go through one ordered pass; all others stay as they are. Heavy ones whose events come in
    order are spared it: their marks are found in parallel.
    """
    hot = hot_keys(valid, "user_id") if hot is None else hot
    keyed = with_exprs(with_dedup_key(valid, settings.generate_ids), misfit=misfit())
    rows = per_key(
        keyed,
        "user_id",
        "seq",
        hot,
        lambda part: first_pass(
            part, settings.policy, settings.allowed_seconds, settings.ttl_hours
        ),
    )
    rows = _with_outcomes(rows, hot)
    if settings.clean_resends:
        promise = "raise_error('a cart total outgrows the fact table, against clean_resends')"
        return with_exprs(rows, outcome=f"if(_outgrown, {promise}, outcome)").drop(
            "_outgrown", "irregular"
        )
    rows = stored(rows.withColumn("_undecided", F.col("irregular") | F.col("_outgrown")).drop("irregular"), "first-pass")
    undecided = stored(rows.filter("_undecided").select("user_id").distinct(), "undecided")
    rows = rows.drop("_outgrown", "_undecided")
    if undecided.isEmpty():
        return rows
    own = [*valid.columns, DEDUP_KEY]
    decided = rows.join(undecided, "user_id", "left_anti")
    chained = _chained_outcomes(keyed, undecided, settings, hot)
    if chained is not None:
        decided = decided.unionByName(chained.select(*rows.columns))
        undecided = stored(undecided.join(chained.select("user_id").distinct(), "user_id", "left_anti"), "undecided")
        if undecided.isEmpty():
            return decided
    again = keyed.select(*own).join(undecided, "user_id", "left_semi")
    ordered = stored(ordered_outcomes(again, settings).select(*rows.columns), "ordered")
    return decided.unionByName(ordered)


def _chained_outcomes(
    keyed: DataFrame, undecided: DataFrame, settings: Settings, hot: Keys
) -> DataFrame | None:
    """Outcomes of the heavy undecided users whose events come in order, if there are any; those whose
    cart outgrows the fact table after all are left out."""
    if isinstance(hot, list) and not hot:
        return None
    heavy, _ = split_by_keys(undecided, "user_id", hot)
    rows = keyed.join(stored(heavy, "heavy"), "user_id", "left_semi")
    calm = stored(in_order(rows, hot), "calm")
    if calm.isEmpty():
        return None
    flagged = stored(flag_expiring(rows.join(calm, "user_id", "left_semi"), ttl_micros(settings.ttl_hours)), "flagged")
    judged = per_key(
        flagged,
        "user_id",
        "seq",
        hot,
        lambda part: lateness.judged(
            lateness.with_watermark(part, "NOT is_duplicate"), settings.policy, settings.allowed_seconds
        ),
    )
    found = stored(_with_outcomes(judged, hot), "chained")
    outgrown = found.filter("_outgrown").select("user_id").distinct()
    return found.join(outgrown, "user_id", "left_anti").drop("_outgrown")


def plain_numbers(keyed: DataFrame) -> DataFrame:
    """Times as microseconds, so that no time zone is involved on the way through Python."""
    return with_exprs(
        keyed, event_us="unix_micros(timestamp)", arrived_us="unix_micros(arrived_at)"
    ).drop("timestamp", "arrived_at")


def with_times(decided: DataFrame) -> DataFrame:
    """The opposite of ``plain_numbers``, with the decision's times."""
    return with_exprs(
        decided,
        arrived_at="timestamp_micros(arrived_us)",
        timestamp="timestamp_micros(adjusted_us)",
        original_timestamp="timestamp_micros(event_us)",
        watermark_before="timestamp_micros(watermark_before_us)",
        watermark_after="timestamp_micros(watermark_after_us)",
    ).drop("arrived_us", "event_us", *[n for n in DECISION.names if n.endswith("_us")])


def ordered_outcomes(keyed: DataFrame, settings: Settings) -> DataFrame:
    """Outcomes of events taken one by one."""
    decided = one_by_one(
        plain_numbers(keyed),
        settings.policy,
        settings.allowed_seconds,
        ttl_micros(settings.ttl_hours),
    )
    return with_times(decided)


def invalid_outcomes(checked: DataFrame, own: list[str]) -> DataFrame:
    """The outcome rows of events with an ``error``."""
    known = {"outcome": F.lit(INVALID), "error": F.col("error")}
    empty = {name: F.lit(None) for name in OUTCOME_COLUMNS} | known
    return checked.filter("error IS NOT NULL").select(
        *own, *[empty[name].cast(kind).alias(name) for name, kind in OUTCOME_COLUMNS.items()]
    )


def outcomes(
    events: DataFrame, settings: Settings = Settings(), hot: Keys = None
) -> DataFrame:
    """Every arrival with its outcome.

    Invalid events skip the per-user work, so a missing or broken user id never gathers rows.
    """
    checked = with_errors(events, settings.rules)
    own = [c for c in events.columns if c != "decode_error"]
    judged = judged_outcomes(checked.filter("error IS NULL").select(*own), settings, hot)
    return judged.select(*own, *OUTCOME_COLUMNS).unionByName(invalid_outcomes(checked, own))


def accepted_events(results: DataFrame) -> DataFrame:
    """Accepted events, enriched; all of them fit the fact table."""
    return enriched(results.filter(IS_ACCEPTED))


def fact_from_events(
    events: DataFrame, settings: Settings = Settings(), hot: Keys = None
) -> DataFrame:
    """Arrivals straight to fact rows; the invalid branch is not planned at all."""
    valid = valid_events(events, settings.rules)
    return fact_rows(accepted_events(judged_outcomes(valid, settings, hot)))
