"""Operational metrics as tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.times import moment, start_of_five_minutes, start_of_minute

# Upper bounds of the latency histogram in seconds; the last bucket is open.
BUCKETS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]
OPEN = float("inf")
LOOK_BACK_MINUTES = 15
#: The outcome of events whose batch could not be written.
FLUSH_FAILED = "flush_failed"


def status() -> Column:
    """The status an outcome is counted under; duplicates and rejections have counters of
    their own, and what the fact table cannot hold counts as a failed write."""
    error = F.coalesce("error", F.lit(""))
    return (
        F.when(F.col("outcome").isin("saved", "saved_late"), "success")
        .when(error.startswith("validation_error"), "validation_error")
        .when(F.col("outcome") == "invalid", "error")
        .when(F.col("outcome").isin("sink_range", FLUSH_FAILED), "flush_error")
    )


def events_processed(results: DataFrame) -> DataFrame:
    counted = results.withColumn("status", status()).filter(F.col("status").isNotNull())
    return counted.groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("value"))


def flush_errors(letters: DataFrame) -> DataFrame:
    """Events lost to failed writes per type, and the batches they came in, from stored letters."""
    failed = letters.filter(F.col("error").startswith("sink_write_failed"))
    per_batch = failed.groupBy(
        F.get_json_object("original_event", "$.event_type").alias("event_type"), "batch_id"
    ).agg(F.count(F.lit(1)).alias("value"))
    return per_batch.groupBy("event_type").agg(
        F.sum("value").alias("value"), F.count(F.lit(1)).alias("failed_batches")
    )


def duplicate_events(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("outcome") == "duplicate").alias("value"))


def late_action() -> Column:
    return F.when(F.col("outcome") == "saved_late", "accepted").when(
        F.col("outcome") == "late_rejected", "rejected"
    )


def late_events(results: DataFrame) -> DataFrame:
    late = results.withColumn("action", late_action()).filter(F.col("action").isNotNull())
    return late.groupBy("action").agg(F.count(F.lit(1)).alias("value"))


def histogram(samples: DataFrame, seconds: str, *by: str) -> DataFrame:
    """Cumulative bucket counts ``(…, le, value)``; one pass, rows are not multiplied."""
    bounds = [*BUCKETS, OPEN]
    counts = samples.groupBy(*by).agg(
        *[F.count_if(F.col(seconds) <= F.lit(le)).alias(f"b{i}") for i, le in enumerate(bounds)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("value"))
            for i, le in enumerate(bounds)
        ]
    )
    return counts.select(*by, F.inline(pairs))


def quantile_from_buckets(buckets: DataFrame, q: float, *by: str) -> DataFrame:
    """The quantile by linear interpolation inside its bucket.

    A quantile that falls into the open bucket is the largest finite bound.
    """
    rows = F.sort_array(F.collect_list(F.struct("le", "value")))
    sets = buckets.groupBy(*by).agg(rows.alias("b"), F.max("value").alias("total"))
    text = f"""
        CASE WHEN total > 0 THEN
          CASE WHEN isnull(hit.le) OR hit.le = double('Infinity') THEN {BUCKETS[-1]}D
               WHEN hit.value = below.value THEN hit.le
               ELSE below.le + (hit.le - below.le)
                    * (rank - below.value) / (hit.value - below.value) END
        END"""
    start = "named_struct('le', 0D, 'value', 0L)"
    ranked = sets.withColumn("rank", F.lit(float(q)) * F.col("total"))
    found = ranked.selectExpr(
        *by,
        "total",
        "rank",
        "filter(b, x -> x.value >= rank)[0] AS hit",
        f"coalesce(try_element_at(filter(b, x -> x.value < rank), -1), {start}) AS below",
    )
    return found.selectExpr(*by, f"{text} AS value")


def p95_over_five_minutes(samples: DataFrame, seconds: str, ts: str) -> DataFrame:
    windows = samples.withColumn("window_start", start_of_five_minutes(F.col(ts)))
    return quantile_from_buckets(
        histogram(windows, seconds, "window_start"), 0.95, "window_start"
    )


def increase_per_minute(events: DataFrame, ts: str, *labels: str) -> DataFrame:
    """How much a counter grew in each minute, per label set: exact counts, no extrapolation."""
    minutes = events.withColumn("minute", start_of_minute(F.col(ts)))
    return minutes.groupBy("minute", *labels).agg(F.count(F.lit(1)).alias("value"))


def cumulative(increases: DataFrame, ts: str, *labels: str) -> DataFrame:
    """A counter's running total from its increases.

    Days are summed apart and what earlier days add up to is joined to each, so a long series never
    sits in one task. Nothing runs before the result is asked for.
    """
    by = [*labels, "_day"]
    days = increases.withColumn("_day", F.to_date(ts))
    sums = days.groupBy(*by).agg(F.sum("value").alias("_moved"))
    # One row per day and series.
    earlier = (
        Window.partitionBy(*labels or [F.lit(0)]).orderBy("_day")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = sums.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.sum("_moved").over(earlier).alias("_carry")
    )
    today = Window.partitionBy(*by).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    total = F.coalesce(F.col("_carry"), F.lit(0)) + F.col("_today")
    return (
        days.withColumn("_today", F.sum("value").over(today))
        .join(carried, same).select(ts, *labels, total.alias("value"))
    )


def consumer_lag(offsets: DataFrame, *by: str) -> DataFrame:
    """Rows still to be read, over all partitions whose both offsets are known."""
    behind = F.greatest(F.lit(0), F.col("highwater") - F.col("position"))
    return offsets.groupBy(*by).agg(F.coalesce(F.sum(behind), F.lit(0)).alias("value"))


def last_value(
    samples: DataFrame,
    *labels: str,
    as_of: datetime | str | Column | None = None,
    minutes: int = LOOK_BACK_MINUTES,
) -> DataFrame:
    """The newest non-null sample of each series inside the look-back."""
    now = moment(as_of)
    ts = F.col("ts")
    recent = samples.filter(
        F.col("value").isNotNull()
        & (ts > now - F.make_dt_interval(mins=F.lit(minutes)))
        & (ts <= now)
    )
    return recent.groupBy(*labels).agg(F.max_by("value", "ts").alias("value"))


def samples_of(results: DataFrame) -> DataFrame:
    """The counters of a batch as rows ``(ts, name, labels, value)``, from one aggregation.

    A sample is dated by the newest arrival it counts, so a repeated batch gives the same rows.
    """
    counted = results.groupBy(
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
        status().alias("status"),
        late_action().alias("action"),
        (F.col("outcome") == "duplicate").alias("duplicate"),
    ).agg(F.max("arrived_at").alias("ts"), F.count(F.lit(1)).cast("double").alias("value"))

    def family(name: str, counts: str, *labels: str) -> str:
        shown = [f"{c} AS {c}" if c in labels else f"CAST(NULL AS STRING) AS {c}"
                 for c in ("event_type", "status", "action")]
        return f"struct('{name}' AS name, {', '.join(shown)}, ({counts}) AS counts)"

    families = ", ".join(
        [
            family("events_processed_total", "status IS NOT NULL", "event_type", "status"),
            family("late_events_total", "action IS NOT NULL", "action"),
            family("duplicate_events_total", "duplicate"),
        ]
    )
    rows = counted.selectExpr("ts", "value", f"inline(array({families}))").filter("counts")
    series = rows.groupBy("name", "event_type", "status", "action").agg(
        F.max("ts").alias("ts"), F.sum("value").alias("value")
    )
    return series.selectExpr(
        "ts",
        "name",
        "map_filter(map('event_type', event_type, 'status', status, 'action', action),"
        " (k, v) -> v IS NOT NULL) AS labels",
        "value",
    )
