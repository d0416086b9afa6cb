"""Roll-ups of the fact table, whole or maintained batch by batch.

Each roll-up first groups by its key *and* the thing it counts distinctly (user or session). That
spreads heavy keys, merges exactly with later partials, and turns distinct counts into plain counts,
so no row is ever expanded for several distinct aggregates; but it can be as large as the fact
table. What batches leave is therefore of a size that does not grow with their events (``PARTIALS``):
of minutes a bitmap of users per ``bitmap_bucket_number``, whose distinct counts are exact, of hours
and products a row per key with theta sketches of the sets.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.aggregates import avg_double, count_all, count_where, sum_where
from trolley.functions.times import (
    moment,
    start_of_five_minutes,
    start_of_hour,
    start_of_minute,
)
from trolley.schemas import ADD, CHECKOUT, REMOVE, UPDATE

WIDE_MONEY = "decimal(38,2)"


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _count(kind: str) -> Column:
    return count_where(_is(kind))


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


def _total(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value), F.lit(0)).cast(WIDE_MONEY)


@dataclass(frozen=True)
class Rollup:
    """Key columns, the distinct column, and how partials and results are made."""

    key: list[str]
    detail: str

    def keyed(self, fact: DataFrame) -> DataFrame:
        raise NotImplementedError

    def partial_columns(self) -> list[Column]:
        raise NotImplementedError

    def merge_columns(self) -> list[Column]:
        raise NotImplementedError

    def result_columns(self) -> list[Column]:
        raise NotImplementedError

    def partial(self, fact: DataFrame) -> DataFrame:
        """One batch's contribution, per key and detail."""
        return self.keyed(fact).groupBy(*self.key, self.detail).agg(*self.partial_columns())

    def merged(self, partials: DataFrame) -> DataFrame:
        """Partials of any number of batches as one."""
        return partials.groupBy(*self.key, self.detail).agg(*self.merge_columns())

    def result(self, merged: DataFrame) -> DataFrame:
        return merged.groupBy(*self.key).agg(*self.result_columns())

    def of(self, fact: DataFrame) -> DataFrame:
        """The roll-up computed from the whole fact table."""
        return self.result(self.partial(fact))

    def of_partials(self, partials: DataFrame) -> DataFrame:
        """The roll-up read from stored partials."""
        return self.result(self.merged(partials))


class MinuteRollup(Rollup):
    """Per minute; ``revenue_total`` sums the cart *after* checkout and so is always zero,
    ``checkout_value`` sums what was checked out."""

    counts = [
        "add_to_cart_count",
        "remove_item_count",
        "update_quantity_count",
        "checkout_count",
        "total_events",
        "late_events_count",
    ]
    sums = ["revenue_total", "checkout_value", "cart_value_sum"]

    def __init__(self) -> None:
        super().__init__(["minute"], "user_id")

    def keyed(self, fact: DataFrame) -> DataFrame:
        return fact.withColumn("minute", start_of_minute(F.col("timestamp")))

    def partial_columns(self) -> list[Column]:
        after, before = F.col("cart_total_after"), F.col("cart_total_before")
        return [
            _count(ADD).alias("add_to_cart_count"),
            _count(REMOVE).alias("remove_item_count"),
            _count(UPDATE).alias("update_quantity_count"),
            _count(CHECKOUT).alias("checkout_count"),
            count_all().alias("total_events"),
            F.sum("is_late").alias("late_events_count"),
            _total(F.when(_is(CHECKOUT), after)).alias("revenue_total"),
            _total(F.when(_is(CHECKOUT), before)).alias("checkout_value"),
            _total(after).alias("cart_value_sum"),
            F.max(after).alias("max_cart_value"),
        ]

    def merge_columns(self) -> list[Column]:
        return [
            *[_sum(c) for c in self.counts],
            *[_total(c).alias(c) for c in self.sums],
            F.max("max_cart_value").alias("max_cart_value"),
        ]

    def result_columns(self) -> list[Column]:
        return [
            *[_sum(c) for c in self.counts],
            _total("revenue_total").alias("revenue_total"),
            avg_double(F.sum("cart_value_sum"), F.sum("total_events")).alias("avg_cart_value"),
            F.max("max_cart_value").alias("max_cart_value"),
            count_all().alias("unique_users"),
            count_where(F.col("checkout_count") > 0).alias("unique_checkout_users"),
            _total("checkout_value").alias("checkout_value"),
        ]


class HourlyUserRollup(Rollup):
    """Per hour and user; ``avg_processing_lag_ms`` holds seconds, under the name it is known by."""

    counts = ["total_actions", "adds", "removes", "checkouts", "lag_sum"]

    def __init__(self) -> None:
        super().__init__(["hour", "user_id"], "session_id")

    def keyed(self, fact: DataFrame) -> DataFrame:
        return fact.withColumn("hour", start_of_hour(F.col("timestamp")))

    def partial_columns(self) -> list[Column]:
        change = F.col("cart_total_after") - F.col("cart_total_before")
        return [
            count_all().alias("total_actions"),
            _count(ADD).alias("adds"),
            _count(REMOVE).alias("removes"),
            _count(CHECKOUT).alias("checkouts"),
            F.sum("processing_lag").alias("lag_sum"),
            _total(change).alias("cart_value_change"),
        ]

    def merge_columns(self) -> list[Column]:
        return [
            *[_sum(c) for c in self.counts],
            _total("cart_value_change").alias("cart_value_change"),
        ]

    def result_columns(self) -> list[Column]:
        return [
            *[_sum(c) for c in self.counts[:4]],
            _total("cart_value_change").alias("cart_value_change"),
            count_all().alias("sessions_count"),
            avg_double(F.sum("lag_sum"), F.sum("total_actions")).alias("avg_processing_lag_ms"),
        ]


class ProductRollup(Rollup):
    """Per five minutes and product."""

    sums = ["add_count", "remove_count", "total_added_quantity", "total_removed_quantity"]

    def __init__(self) -> None:
        super().__init__(["window_start", "product_id", "product_name"], "user_id")

    def keyed(self, fact: DataFrame) -> DataFrame:
        return fact.filter(F.col("product_id") > 0).withColumn(
            "window_start", start_of_five_minutes(F.col("timestamp"))
        )

    def partial_columns(self) -> list[Column]:
        quantity = F.col("quantity")
        return [
            _count(ADD).alias("add_count"),
            _count(REMOVE).alias("remove_count"),
            sum_where(quantity, _is(ADD)).alias("total_added_quantity"),
            sum_where(quantity, _is(REMOVE)).alias("total_removed_quantity"),
            _total(F.when(_is(ADD), F.col("price") * quantity)).alias("potential_revenue"),
        ]

    def merge_columns(self) -> list[Column]:
        return [
            *[_sum(c) for c in self.sums],
            _total("potential_revenue").alias("potential_revenue"),
        ]

    def result_columns(self) -> list[Column]:
        return [
            *self.merge_columns(),
            count_where(F.col("add_count") + F.col("remove_count") > 0).alias("unique_users"),
        ]


MINUTE = MinuteRollup()
HOURLY_USER = HourlyUserRollup()
PRODUCT = ProductRollup()
ROLLUPS = {"minute": MINUTE, "hourly_user": HOURLY_USER, "product": PRODUCT}


class BitmapMinutes:
    """The minute roll-up from rows per minute and bucket of 32,768 user ids, each with a bitmap of its
    users: exact, and mergeable in any order. A row is 4 KB whatever its events are, a minute at most an
    eighth of a byte per user id there is; ids should be dense, as serial numbers are.
    """

    key = ["minute", "bucket"]
    sets = ["users", "checkout_users"]

    def partial(self, fact: DataFrame, *by: str) -> DataFrame:
        """What a batch leaves; ``by`` tells several batches apart."""
        place = F.bitmap_bit_position("user_id")
        rows = MINUTE.keyed(fact).withColumn("bucket", F.bitmap_bucket_number("user_id"))
        return rows.groupBy(*by, *self.key).agg(
            *MINUTE.partial_columns(),
            F.bitmap_construct_agg(place).alias("users"),
            F.bitmap_construct_agg(F.when(_is(CHECKOUT), place)).alias("checkout_users"),
        )

    def merged(self, partials: DataFrame) -> DataFrame:
        sets = [F.bitmap_or_agg(c).alias(c) for c in self.sets]
        return partials.groupBy(*self.key).agg(*MINUTE.merge_columns(), *sets)

    def of_partials(self, partials: DataFrame) -> DataFrame:
        counted = {c: F.bitmap_count(c) for c in self.sets}
        minutes = self.merged(partials).withColumns(counted).groupBy("minute").agg(
            *MINUTE.merge_columns(), *[_sum(c) for c in self.sets]
        )
        return minutes.select(
            "minute",
            *MINUTE.counts,
            "revenue_total",
            avg_double(F.col("cart_value_sum"), F.col("total_events")).alias("avg_cart_value"),
            "max_cart_value",
            F.col("users").alias("unique_users"),
            F.col("checkout_users").alias("unique_checkout_users"),
            "checkout_value",
        )


@dataclass(frozen=True)
class ThetaRollup:
    """A roll-up from one row per key, with a theta sketch of the set it counts (``of``, where ``where``
    holds): exact up to 4,096 members, about 1.6 % standard error beyond. All else is exact."""

    rollup: Rollup
    distinct: str
    of: str
    where: str = "true"

    def partial(self, fact: DataFrame, *by: str) -> DataFrame:
        members = F.theta_sketch_agg(F.expr(f"CASE WHEN {self.where} THEN {self.of} END"))
        rows = self.rollup.keyed(fact).groupBy(*by, *self.rollup.key)
        return rows.agg(*self.rollup.partial_columns(), members.alias("members"))

    def merged(self, partials: DataFrame) -> DataFrame:
        members = F.theta_union_agg("members").alias("members")
        return partials.groupBy(*self.rollup.key).agg(*self.rollup.merge_columns(), members)

    def of_partials(self, partials: DataFrame) -> DataFrame:
        merged = self.merged(partials).withColumn(self.distinct, F.theta_sketch_estimate("members"))
        if "lag_sum" in merged.columns:
            lag = avg_double(F.col("lag_sum"), F.col("total_actions")).alias("avg_processing_lag_ms")
            return merged.select("*", lag).drop("lag_sum", "members")
        return merged.drop("members")


#: What batches leave of each roll-up.
PARTIALS = {
    "minute": BitmapMinutes(),
    "hourly_user": ThetaRollup(HOURLY_USER, "sessions_count", "session_id"),
    "product": ThetaRollup(PRODUCT, "unique_users", "user_id", f"event_type IN ('{ADD}', '{REMOVE}')"),
}


def active_carts(fact: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Users with more add than remove events in the last hour, newest first.

    By its definition the value is the largest total of the hour and the session the
    alphabetically last one; ``open_carts`` answers what is in the carts now.
    """
    now = moment(as_of)
    recent = fact.filter(
        (F.col("timestamp") > now - F.make_dt_interval(hours=F.lit(1))) & ~_is(CHECKOUT)
    )
    carts = recent.groupBy("user_id").agg(
        F.max("timestamp").alias("last_activity"),
        (_count(ADD) - _count(REMOVE)).alias("net_adds"),
        F.max("cart_total_after").alias("current_cart_value"),
        F.max("session_id").alias("current_session"),
    )
    active = carts.filter(F.col("net_adds") > 0)
    # Sorting reads its input twice, to sample it first: let that be the few carts.
    return active.repartition("user_id", "last_activity").orderBy(
        F.desc("last_activity"), "user_id"
    )


def summed_merge(rollup: Rollup, fact: DataFrame, insert_block: Column) -> DataFrame:
    """The roll-up as a table that adds up every number of its insert blocks.

    Averages, maxima and distinct counts of the blocks are added too; kept for comparing against
    tables maintained that way. The product roll-up is merged without the product's name.
    """
    blocks = fact.withColumn("_insert", insert_block)
    per_block = rollup.keyed(blocks).groupBy("_insert", *rollup.key, rollup.detail).agg(
        *rollup.partial_columns()
    )
    results = per_block.groupBy("_insert", *rollup.key).agg(*rollup.result_columns())
    key = [c for c in rollup.key if c != "product_name"]
    numbers = [c for c in results.columns if c not in ("_insert", *rollup.key)]
    return results.groupBy(*key).agg(*[F.sum(c).alias(c) for c in numbers])


def minute_sketches(fact: DataFrame, *by: str) -> DataFrame:
    """One row per minute whatever its users: what adds up, and user sets as HLL sketches (about
    1.6 % standard error). The smaller alternative to ``BitmapMinutes`` where ids are not dense."""
    users = F.col("user_id")
    return MINUTE.keyed(fact).groupBy(*by, "minute").agg(
        *MINUTE.partial_columns(),
        F.hll_sketch_agg(users).alias("users"),
        F.hll_sketch_agg(F.when(_is(CHECKOUT), users)).alias("checkout_users"),
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """Any number of batches' rows as one row per minute, of the same columns."""
    return sketches.groupBy("minute").agg(
        *MINUTE.merge_columns(),
        F.hll_union_agg("users").alias("users"),
        F.hll_union_agg("checkout_users").alias("checkout_users"),
    )


def minute_from_sketches(sketches: DataFrame) -> DataFrame:
    """The minute roll-up; distinct counts are estimates, all other columns are exact."""
    estimated = F.hll_sketch_estimate("checkout_users")
    return merged_sketches(sketches).select(
        "minute",
        *MINUTE.counts,
        "revenue_total",
        avg_double(F.col("cart_value_sum"), F.col("total_events")).alias("avg_cart_value"),
        "max_cart_value",
        F.hll_sketch_estimate("users").alias("unique_users"),
        F.coalesce(estimated, F.lit(0)).alias("unique_checkout_users"),
        "checkout_value",
    )
