"""Registered queries: each takes a session and a folder of tables and returns a DataFrame.

Every query works on the whole ``events`` table or on what is derived from it.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import wraps
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas as S
from trolley.functions.scalars import content_id
from trolley.functions.times import (
    seconds_between,
    start_of_five_minutes,
    start_of_hour,
    start_of_minute,
    weekday_from_monday,
    whole_second,
)
from trolley.operators import cart, dedup, lateness, listings, metrics, rollups
from trolley.operators.prefix import Keys
from trolley.operators.validate import PRODUCER_RULES, valid_events, with_errors
from trolley.plans import reads
from trolley.plans.batch import (
    Settings,
    accepted_events,
    fact_from_events,
    judged_outcomes,
    outcomes,
)
from trolley.plans.handover import stream_state
from trolley.plans.ingest import Tables, flush_batch
from trolley.plans.reads import event_days
from trolley.session import prepare, shared_dir, stored
from trolley.sinks import dead_letters
from trolley.sinks.clustering import two_ways
from trolley.sinks.flush import FlushError
from trolley.sinks.tables import write_batch, write_fact
from trolley.sources.arrivals import cart_arrivals, hot_users, shifted_arrivals
from trolley.sources.messages import file_messages, typed_events
from trolley.sources.replay import replay_events
from trolley.sources.tables import table, utc_timestamps
from trolley.streaming.job import start_job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Points in time the time-dependent queries are asked at.
AS_OF = "2024-01-15 00:00:00"
RETENTION_AS_OF = "2024-02-14 12:00:00"
REPLAY_START = "2026-01-01 12:00:10"
# The re-sends of the arrivals repeat their event a second later.
CLEAN = Settings(clean_resends=True)


def register(function: Query) -> Query:
    """Add a query under its function's name; timestamps leave it zone-less, as UTC."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = function(prepare(spark), folder)
        stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})

    QUERIES[function.__name__] = run
    return function


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def _arrivals(spark: SparkSession, folder: str) -> tuple[DataFrame, Keys]:
    """Arrivals and the heavy users among them."""
    events = _events(spark, folder)
    hot = hot_users(events)
    return cart_arrivals(events, hot), hot


def _valid(spark: SparkSession, folder: str) -> tuple[DataFrame, Keys]:
    arrivals, hot = _arrivals(spark, folder)
    return valid_events(arrivals), hot


def _fresh(spark: SparkSession, folder: str) -> tuple[DataFrame, Keys]:
    """Valid first copies and the heavy users."""
    valid, hot = _valid(spark, folder)
    first = dedup.first_copies(valid, hot).filter("NOT is_duplicate").drop("is_duplicate")
    return first, hot


def _results(spark: SparkSession, folder: str, settings: Settings = CLEAN) -> DataFrame:
    arrivals, hot = _arrivals(spark, folder)
    return outcomes(arrivals, settings, hot)


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, hot = _arrivals(spark, folder)
    return fact_from_events(arrivals, CLEAN, hot)


def _money(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles of two digits, averages with six."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            changed[field.name] = F.round(F.col(field.name).cast("double"), 2)
        elif isinstance(field.dataType, T.DoubleType):
            changed[field.name] = F.round(field.name, 6)
    return df.withColumns(changed)


# Sources


@register
def decoded_messages(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, _ = _arrivals(spark, folder)
    number = F.col("event_id").cast("bigint") % 40
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole = F.to_json(
        F.struct(
            "event_id",
            F.when(number == 7, "abc").otherwise(F.col("user_id").cast("string")).alias("user_id"),
            "event_type",
            "product_id",
            F.when(number != 2, F.col("quantity")).alias("quantity"),
            F.when(number != 6, F.col("price")).alias("price"),
            F.when(number == 5, "not a time").when(number != 3, stamp).alias("timestamp"),
            F.when(number != 8, F.col("session_id")).alias("session_id"),
        )
    )
    # User ids travel as numbers; one that is text is a typed error.
    whole = F.regexp_replace(whole, '"user_id":"([0-9]+)"', '"user_id":$1')
    value = F.when(number == 1, F.expr("substr(_whole, 1, length(_whole) - 1)")).otherwise(
        F.col("_whole")
    )
    messages = arrivals.withColumn("_whole", whole).select(
        "seq", "arrived_at", value.alias("value")
    )
    typed = typed_events(messages)
    good = F.col("decode_error").isNull()
    fields = ["event_id", "user_id", "event_type", "product_id", "quantity", "price",
              "timestamp", "session_id"]
    return typed.select("seq", good.alias("decoded"), *[F.when(good, F.col(f)).alias(f) for f in fields])


@register
def replayed_events(spark: SparkSession, folder: str) -> DataFrame:
    plan = _events(spark, folder).selectExpr(
        "event_id AS at_second",
        "concat('scn-', event_id) AS event_id",
        "user_id",
        "'add_to_cart' AS event_type",
        "event_id % 20 AS product_id",
        "concat('p', event_id % 20) AS product_name",
        "1 AS quantity",
        "value AS price",
        "CASE event_id % 10 WHEN 3 THEN -180 WHEN 7 THEN -600 END AS timestamp_offset_seconds",
        "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('s', user_id) END AS session_id",
    )
    return replay_events(plan, REPLAY_START, "run1")


# Scalar functions


@register
def time_parts(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return _events(spark, folder).select(
        "event_id",
        start_of_minute(ts).alias("minute"),
        start_of_hour(ts).alias("hour_start"),
        start_of_five_minutes(ts).alias("five_minutes"),
        whole_second(ts).alias("whole_second"),
        (ts - F.make_dt_interval(hours=F.lit(1))).alias("hour_before"),
        F.hour(ts).alias("hour_of_day"),
        weekday_from_monday(ts).alias("day_of_week"),
        F.round(seconds_between(F.lit(AS_OF).cast("timestamp"), ts), 6).alias("lag_seconds"),
    )


@register
def content_ids(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, _ = _arrivals(spark, folder)
    # Whole seconds on some rows: their text has no fraction.
    ts = F.when(F.col("seq") % 3 == 0, whole_second(F.col("timestamp"))).otherwise(
        F.col("timestamp")
    )
    key = content_id(F.col("user_id"), F.col("event_type"), F.col("product_id"), ts)
    return arrivals.select("seq", key.alias("content_id"))


# Validation


def _broken(arrivals: DataFrame) -> DataFrame:
    """Arrivals with two more kinds of fault than they come with."""
    return arrivals.withColumns(
        {
            "price": F.expr("if(seq % 50 = 9, -price - 1, price)"),
            "event_id": F.expr("CASE seq % 50 WHEN 12 THEN '' WHEN 14 THEN NULL ELSE event_id END"),
        }
    )


@register
def broken_rules(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, _ = _arrivals(spark, folder)
    return with_errors(_broken(arrivals)).select("seq", "error")


@register
def broken_producer_rules(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, _ = _arrivals(spark, folder)
    return with_errors(_broken(arrivals), PRODUCER_RULES).select("seq", "error")


# Duplicates


@register
def first_copies(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.first_copies(*_valid(spark, folder)).select("seq", "user_id", "is_duplicate")


@register
def content_id_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    valid, hot = _valid(spark, folder)
    flagged = dedup.first_copies(valid, hot, generate_ids=True)
    return flagged.select("seq", "user_id", "dedup_key", "is_duplicate")


@register
def duplicates_against_store(spark: SparkSession, folder: str) -> DataFrame:
    """The store knows every third event; a second look at all of them a day later."""
    valid, _ = _valid(spark, folder)
    keyed = dedup.with_dedup_key(valid)
    stored = keyed.filter("CAST(event_id AS BIGINT) % 3 = 0")
    marks = dedup.committed_marks(stored.withColumnRenamed("arrived_at", "processed_at"))
    again = keyed.withColumn(
        "arrived_at", F.expr("arrived_at + make_dt_interval(0, 23, 59, 59 + seq % 2)")
    )
    return dedup.flag_against_marks(again, marks).select("seq", "is_duplicate")


@register
def duplicates_with_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """Ids so coarse that copies recur for weeks: marks expire and are set anew."""
    valid, hot = _valid(spark, folder)
    coarse = valid.withColumns(
        {
            "event_id": F.concat_ws("-", "event_type", (F.col("product_id") % 3).cast("string")),
            "timestamp": F.col("arrived_at"),
        }
    )
    decided = judged_outcomes(coarse, Settings(), hot)
    return decided.select("seq", "user_id", (F.col("outcome") == "duplicate").alias("is_duplicate"))


# Lateness


def _lateness(spark: SparkSession, folder: str, policy: str) -> DataFrame:
    judged = lateness.classify(*_fresh(spark, folder), policy=policy)
    return judged.select(
        "seq",
        "user_id",
        "is_late",
        F.round("lateness_seconds", 6).alias("lateness_seconds"),
        "action",
        "watermark_before",
        "watermark_after",
        "timestamp",
    )


@register
def lateness_accept(spark: SparkSession, folder: str) -> DataFrame:
    return _lateness(spark, folder, lateness.ACCEPT)


@register
def lateness_reject(spark: SparkSession, folder: str) -> DataFrame:
    return _lateness(spark, folder, lateness.REJECT)


@register
def lateness_adjust(spark: SparkSession, folder: str) -> DataFrame:
    return _lateness(spark, folder, lateness.ADJUST)


@register
def watermark_stats(spark: SparkSession, folder: str) -> DataFrame:
    judged = lateness.classify(*_fresh(spark, folder), policy=lateness.ADJUST)
    return lateness.watermark_stats(judged)


# Carts and the whole event job


@register
def cart_totals(spark: SparkSession, folder: str) -> DataFrame:
    results = _results(spark, folder).filter("cart_total_after IS NOT NULL")
    return results.select(
        "seq",
        "user_id",
        "event_type",
        "line_quantity",
        F.round("cart_total_before", 2).alias("cart_total_before"),
        F.round("cart_total_after", 2).alias("cart_total_after"),
    )


@register
def cart_totals_with_changing_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices differ between add and remove, so totals fall below zero and updates lift them."""
    valid, hot = _valid(spark, folder)
    drifting = valid.withColumn("price", F.expr("price + (seq % 7) * 25"))
    return cart.with_cart(drifting, hot).select(
        "seq",
        "user_id",
        "cart_changed",
        F.round("cart_total_before", 2).alias("cart_total_before"),
        F.round("cart_total_after", 2).alias("cart_total_after"),
    )


@register
def cart_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    carts = cart.cart_snapshot(_results(spark, folder))
    return carts.select(
        "user_id",
        F.round("total_value", 2).alias("total_value"),
        "event_count",
        "last_updated",
        F.size("items").cast("bigint").alias("products"),
        F.expr("aggregate(map_values(items), 0L, (a, x) -> a + x)").alias("units"),
    )


@register
def open_carts(spark: SparkSession, folder: str) -> DataFrame:
    carts = cart.open_carts(cart.cart_snapshot(_results(spark, folder)))
    return carts.select("user_id", F.round("total_value", 2).alias("total_value"))


@register
def enriched_events(spark: SparkSession, folder: str) -> DataFrame:
    return accepted_events(_results(spark, folder)).select(
        "seq",
        F.round("processing_lag", 6).alias("processing_lag"),
        "is_late",
        "hour_of_day",
        "day_of_week",
        F.round("cart_total_before", 2).alias("cart_total_before"),
        F.round("cart_total_after", 2).alias("cart_total_after"),
        "processed_at",
    )


@register
def event_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job without the promise that re-sends are clean."""
    return _results(spark, folder, Settings()).select(
        "seq",
        "user_id",
        "outcome",
        "error",
        F.round("lateness_seconds", 6).alias("lateness_seconds"),
        F.round("cart_total_after", 2).alias("cart_total_after"),
    )


def _misfits(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of arrivals some of which the fact table cannot hold: by quantity, by price, or by
    the total they lead to; re-sends of some come with a price that fits."""
    arrivals, hot = _arrivals(spark, folder)
    quantity = (
        f"CASE WHEN event_type = '{S.UPDATE}' AND seq % 14 = 4 THEN -1 "
        f"WHEN event_type = '{S.ADD}' AND quantity > 0 AND seq % 46 = 10 THEN 70000 ELSE quantity END"
    )
    price = (
        "CASE WHEN seq % 80 = 8 THEN 1e9D WHEN seq % 80 = 48 THEN double('NaN') "
        f"WHEN event_type = '{S.ADD}' AND seq % 30 = 14 THEN 45000000.25D ELSE price END"
    )
    changed = arrivals.withColumns({"quantity": F.expr(quantity), "price": F.expr(price)})
    return outcomes(changed, Settings(), hot)


@register
def sink_range_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _misfits(spark, folder).select(
        "seq", "user_id", "outcome", "error", F.round("cart_total_after", 2).alias("cart_total_after")
    )


@register
def events_processed_with_misfits(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.events_processed(_misfits(spark, folder))


# Sinks


@register
def fact_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _money(_fact(spark, folder))


@register
def dead_letter_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dead_letters.dead_letters(_results(spark, folder))


@register
def late_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return dead_letters.late_rejections(_results(spark, folder))


@register
def validation_failures(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, _ = _arrivals(spark, folder)
    failed = with_errors(arrivals).withColumn(
        "outcome", F.when(F.col("error").isNotNull(), "invalid")
    )
    return dead_letters.validation_failures(failed)


@register
def retained_rows(spark: SparkSession, folder: str) -> DataFrame:
    kept = listings.retained(_fact(spark, folder), RETENTION_AS_OF)
    return kept.select("event_id", "user_id", "processed_at")


@register
def streamed_fact_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming job over the events as they lie in storage, read back from its fact table."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # A pattern, since a stream takes a folder or a pattern but no single file.
    files = file_messages(spark, f"{folder}/[e]vents.parquet", schema, max_bytes=64 << 20)
    arrivals = shifted_arrivals(utc_timestamps(files))
    run = f"{shared_dir(spark)}/streamed-{uuid.uuid4().hex}"
    tables = Tables(f"{run}/tables")
    settings = Settings(allowed_seconds=86_400)
    start_job(arrivals, tables, f"{run}/state", settings).awaitTermination()
    return _money(spark.read.parquet(tables.fact).drop("processed_date", "batch_id"))


@register
def handed_over_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The first half of the arrivals as a batch, the second as a stream that begins with its state."""
    arrivals, hot = _arrivals(spark, folder)
    arrivals = stored(arrivals, "arrivals")
    middle = arrivals.agg(F.expr("(min(seq) + max(seq)) DIV 2")).first()[0]
    settings = Settings()
    first = stored(outcomes(arrivals.filter(F.col("seq") <= middle), settings, hot), "first-half")
    run = f"{shared_dir(spark)}/handed-over-{uuid.uuid4().hex}"
    arrivals.filter(F.col("seq") > middle).write.parquet(f"{run}/landed")
    landed = file_messages(spark, f"{run}/landed", arrivals.schema, max_bytes=64 << 20)

    def store(results: DataFrame, tables: Tables, batch_id: int) -> None:
        write_batch(results, tables.path("outcomes"), batch_id)

    tables = Tables(f"{run}/tables")
    query = start_job(
        landed, tables, f"{run}/state", settings, store=store, initial=stream_state(first, settings), first_batch=1
    )
    query.awaitTermination()
    second = spark.read.parquet(tables.path("outcomes")).select(*first.columns)
    return first.unionByName(second).select(
        "seq",
        "user_id",
        "outcome",
        "error",
        F.round("lateness_seconds", 6).alias("lateness_seconds"),
        F.round("cart_total_after", 2).alias("cart_total_after"),
    )


@register
def approximate_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The stream with marks as Bloom filters against the exact batch job: none missed, and not more
    than one in fifty events taken for a duplicate that is none."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    files = file_messages(spark, f"{folder}/[e]vents.parquet", schema, max_bytes=64 << 20)
    run = f"{shared_dir(spark)}/approximate-{uuid.uuid4().hex}"
    tables, settings = Tables(f"{run}/tables"), Settings(allowed_seconds=86_400, bloom_bits=1 << 13)

    def store(results: DataFrame, tables: Tables, batch_id: int) -> None:
        write_batch(results.select("seq", "outcome"), tables.path("outcomes"), batch_id)

    start_job(shifted_arrivals(utc_timestamps(files)), tables, f"{run}/state", settings, store=store).awaitTermination()
    guessed = spark.read.parquet(tables.path("outcomes")).select("seq", (F.col("outcome") == "duplicate").alias("guessed"))
    exact = outcomes(shifted_arrivals(_events(spark, folder)), Settings(allowed_seconds=86_400))
    both = exact.select("seq", (F.col("outcome") == "duplicate").alias("duplicate")).join(guessed, "seq")
    return both.agg(
        F.count_if("duplicate").alias("duplicates"),
        F.count_if(F.expr("duplicate AND NOT guessed")).alias("missed"),
        (F.count_if(F.expr("guessed AND NOT duplicate")) <= 0.02 * F.count("*")).alias("within_bound"),
    )


@register
def two_way_fact_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table clustered by minute and user, read back."""
    tables = Tables(f"{shared_dir(spark)}/clustered-{uuid.uuid4().hex}")
    write_fact(stored(_fact(spark, folder), "fact"), tables.fact, layout=two_ways)
    return _money(spark.read.parquet(tables.fact).drop("processed_date", "batch_id"))


# Listings


@register
def latest_events(spark: SparkSession, folder: str) -> DataFrame:
    newest = listings.latest_events(_fact(spark, folder))
    return newest.select("event_id", "user_id", "event_type", "is_late", "processed_at")


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).selectExpr(
        "lpad(CAST(user_id % 100 AS STRING), 3, '0') AS version",
        "ts AS applied_at",
        "event_id AS change_id",
        "concat(event_type, '_', event_id) AS migration_name",
        "md5(props) AS checksum",
        "CAST(event_id % 2 AS INT) AS success",
    )


@register
def latest_change_per_version(spark: SparkSession, folder: str) -> DataFrame:
    return listings.latest_per_key(_changes(spark, folder), "version", "applied_at", "change_id")


@register
def change_listing(spark: SparkSession, folder: str) -> DataFrame:
    return listings.listed(_changes(spark, folder), "version", "applied_at")


# Roll-ups


@register
def minute_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.MINUTE.of(_fact(spark, folder)))


@register
def hourly_user_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.HOURLY_USER.of(_fact(spark, folder)))


@register
def product_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.PRODUCT.of(_fact(spark, folder)))


def _daily_partials(rollup: rollups.Rollup, fact: DataFrame) -> DataFrame:
    """What batches of one arrival day each would have left."""
    days = rollup.keyed(fact).groupBy(
        F.to_date("processed_at").alias("batch"), *rollup.key, rollup.detail
    )
    return days.agg(*rollup.partial_columns()).drop("batch")


@register
def minute_rollup_from_batches(spark: SparkSession, folder: str) -> DataFrame:
    partials = _daily_partials(rollups.MINUTE, _fact(spark, folder))
    return _money(rollups.MINUTE.of_partials(partials))


@register
def hourly_user_rollup_from_batches(spark: SparkSession, folder: str) -> DataFrame:
    partials = _daily_partials(rollups.HOURLY_USER, _fact(spark, folder))
    return _money(rollups.HOURLY_USER.of_partials(partials))


@register
def product_rollup_from_batches(spark: SparkSession, folder: str) -> DataFrame:
    partials = _daily_partials(rollups.PRODUCT, _fact(spark, folder))
    return _money(rollups.PRODUCT.of_partials(partials))


def _insert_block():
    return F.floor(F.unix_seconds("processed_at") / F.lit(6 * 3600))


@register
def minute_rollup_summed(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.summed_merge(rollups.MINUTE, _fact(spark, folder), _insert_block()))


@register
def hourly_user_rollup_summed(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.summed_merge(rollups.HOURLY_USER, _fact(spark, folder), _insert_block()))


@register
def product_rollup_summed(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.summed_merge(rollups.PRODUCT, _fact(spark, folder), _insert_block()))


@register
def minute_uniques_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    minutes = rollups.minute_from_sketches(rollups.minute_sketches(_fact(spark, folder)))
    return minutes.select("minute", "total_events", "unique_users", "unique_checkout_users")


def _day_of_batch() -> Column:
    return F.to_date("processed_at")


@register
def minute_sums_from_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All that adds up, from one row per minute and arrival day."""
    fact = _fact(spark, folder).withColumn("_batch", _day_of_batch())
    # Rows of one minute that arrived on two days are two batches' partials.
    minutes = rollups.minute_from_sketches(rollups.minute_sketches(fact, "_batch").drop("_batch"))
    return _money(minutes.drop("unique_users", "unique_checkout_users"))


def _from_partials(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A roll-up from what batches of one arrival day each leave."""
    fact = _fact(spark, folder).withColumn("_batch", _day_of_batch())
    partials = rollups.PARTIALS[name].partial(fact, "_batch").drop("_batch")
    return _money(rollups.PARTIALS[name].of_partials(partials))


@register
def minute_rollup_from_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return _from_partials(spark, folder, "minute")


@register
def hourly_user_rollup_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return _from_partials(spark, folder, "hourly_user")


@register
def product_rollup_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return _from_partials(spark, folder, "product")


@register
def product_sketch_errors(spark: SparkSession, folder: str) -> DataFrame:
    """One product whose users are as many as there are events, merged from a sketch a day: the distinct
    count is five standard errors off at most, all sums are exact."""
    crowd = {
        "user_id": F.col("event_id").cast("bigint"),
        "timestamp": F.date_trunc("YEAR", "timestamp"),
        "product_id": F.lit(1).cast("bigint"),
        "product_name": F.lit("all"),
        "_batch": _day_of_batch(),
    }
    partials = rollups.PARTIALS["product"].partial(_fact(spark, folder).withColumns(crowd), "_batch")
    merged = rollups.PARTIALS["product"].of_partials(partials.drop("_batch"))
    users = F.col("add_count") + F.col("remove_count")
    return merged.select(
        "window_start", "add_count", "remove_count", (F.abs(F.col("unique_users") - users) <= 0.08 * users).alias("within_bound")
    )


@register
def sketch_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Estimates of sets of thousands, merged from ten sketches each: five standard errors off at
    most."""
    parts = _events(spark, folder).groupBy("event_type", (F.col("event_id") % 10).alias("part")).agg(
        F.hll_sketch_agg("event_id").alias("s"), F.countDistinct("event_id").alias("n")
    )
    merged = parts.groupBy("event_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("s")).alias("estimate"), F.sum("n").alias("n")
    )
    return merged.selectExpr("event_type", "n", "abs(estimate - n) <= 0.08 * n AS within_bound")


@register
def active_carts(spark: SparkSession, folder: str) -> DataFrame:
    return _money(rollups.active_carts(_fact(spark, folder), AS_OF))


def _stored_fact(spark: SparkSession, folder: str) -> Tables:
    """The fact table as batches leave it, with the days its partitions hold."""
    tables = Tables(f"{shared_dir(spark)}/table-{uuid.uuid4().hex}")
    fact = stored(_fact(spark, folder), "fact")
    write_fact(fact, tables.fact)
    write_batch(event_days(fact), tables.event_days, 0)
    return tables


@register
def active_carts_of_table(spark: SparkSession, folder: str) -> DataFrame:
    tables = _stored_fact(spark, folder)
    return _money(reads.active_carts_of_table(spark, tables.fact, tables.event_days, AS_OF))


@register
def latest_events_of_table(spark: SparkSession, folder: str) -> DataFrame:
    newest = reads.latest_events_of_table(spark, _stored_fact(spark, folder).fact)
    return newest.select("event_id", "user_id", "event_type", "is_late", "processed_at")


# Metrics


@register
def events_processed(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.events_processed(_results(spark, folder))


@register
def flush_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of failed writes, from what a job leaves that could not store one of its two batches."""
    arrivals, hot = _arrivals(spark, folder)
    accepted = stored(accepted_events(judged_outcomes(valid_events(arrivals), CLEAN, hot)), "accepted")
    tables = Tables(f"{shared_dir(spark)}/flushed-{uuid.uuid4().hex}")

    def broken(fact: DataFrame) -> None:
        raise OSError("disk full")

    for batch_id, write in ((0, None), (1, broken)):
        batch = accepted.filter(F.expr(f"CAST(event_id AS BIGINT) % 2 = {batch_id}"))
        with suppress(FlushError):
            flush_batch(batch, tables, batch_id, write)
    counted = spark.read.parquet(tables.metrics).filter("labels['status'] = 'flush_error'").groupBy(
        F.expr("labels['event_type']").alias("event_type")
    ).agg(F.sum("value").cast("bigint").alias("counted"))
    letters = metrics.flush_errors(spark.read.parquet(tables.dead_letter))
    return counted.join(letters, "event_type").select("event_type", "counted", "value", "failed_batches")


@register
def duplicate_events(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.duplicate_events(_results(spark, folder))


@register
def late_events(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.late_events(_results(spark, folder))


def _seconds(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).selectExpr("ts", "event_type", "value / 100 AS seconds")


@register
def processing_histogram(spark: SparkSession, folder: str) -> DataFrame:
    buckets = metrics.histogram(_seconds(spark, folder), "seconds", "event_type")
    return buckets.withColumn("le", F.when(F.col("le") < 1e9, F.col("le")))


@register
def p95_processing_seconds(spark: SparkSession, folder: str) -> DataFrame:
    p95 = metrics.p95_over_five_minutes(_seconds(spark, folder), "seconds", "ts")
    return p95.withColumn("value", F.round("value", 6))


def _offsets(spark: SparkSession, folder: str, *by) -> DataFrame:
    events = _events(spark, folder).withColumn("partition", F.col("user_id") % 6)
    read = F.max(F.when((F.col("event_type") != "view") & (F.col("partition") != 5), F.col("event_id")))
    return events.groupBy("partition", *by).agg(
        (F.max("event_id") + 1).alias("highwater"), read.alias("position")
    )


@register
def consumer_lag(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.consumer_lag(_offsets(spark, folder))


@register
def consumer_lag_series(spark: SparkSession, folder: str) -> DataFrame:
    hour = start_of_hour(F.col("ts")).alias("ts")
    return metrics.consumer_lag(_offsets(spark, folder, hour), "ts")


@register
def success_total_series(spark: SparkSession, folder: str) -> DataFrame:
    saved = _results(spark, folder).filter("outcome IN ('saved', 'saved_late')")
    return metrics.cumulative(metrics.increase_per_minute(saved, "arrived_at"), "minute")


@register
def duplicate_total_series(spark: SparkSession, folder: str) -> DataFrame:
    copies = _results(spark, folder).filter("outcome = 'duplicate'")
    return metrics.cumulative(metrics.increase_per_minute(copies, "arrived_at"), "minute")


def _late(spark: SparkSession, folder: str) -> DataFrame:
    late = _results(spark, folder).withColumn("action", metrics.late_action())
    return metrics.increase_per_minute(late.filter("action IS NOT NULL"), "arrived_at", "action")


@register
def late_increase_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    return _late(spark, folder)


@register
def late_total_series(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.cumulative(_late(spark, folder), "minute", "action")


@register
def last_metric_values(spark: SparkSession, folder: str) -> DataFrame:
    samples = _events(spark, folder).selectExpr(
        "ts", "event_type AS name", "CASE WHEN event_id % 3 > 0 THEN value END AS value"
    )
    return metrics.last_value(samples, "name", as_of=AS_OF, minutes=120)
