"""Reads of a stored fact table that open no more days than they need.

The table is partitioned by the day events were processed. The newest rows by processing time lie in the
newest days; the newest by event time lie wherever late events were processed, so batches leave a
small table of which event days their partitions hold, and a join with it prunes partitions when the
query runs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.times import moment
from trolley.operators.listings import latest_events
from trolley.operators.rollups import active_carts
from trolley.sources.tables import fact_events

_DAY = "processed_date"


def event_days(fact: DataFrame) -> DataFrame:
    """``processed_date, event_date``: which days of events a batch's partitions hold."""
    return fact.select(F.to_date("processed_at").alias(_DAY), F.to_date("timestamp").alias("event_date")).distinct()


def newest_days(spark: SparkSession, path: str, rows: int) -> list[str]:
    """The newest days that hold at least ``rows`` rows in all (every day, if there are fewer), newest
    first. Rows are counted day by day, from files' footers; older days are not looked at."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    days = sorted((n.split("=", 1)[1] for n in names if n.startswith(f"{_DAY}=")), reverse=True)
    found, held = [], 0
    for day in days:
        if held >= rows:
            break
        found.append(day)
        held += spark.read.parquet(f"{path}/{_DAY}={day}").count()
    return found


def latest_events_of_table(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """The newest rows by processing time, reading the newest days only."""
    days = newest_days(spark, path, rows)
    fact = fact_events(spark, path)
    return latest_events(fact.filter(F.col(_DAY) >= F.lit(min(days, default="9999-12-31")).cast("date")), rows)


def recent_events(spark: SparkSession, path: str, days_path: str, since: str | datetime) -> DataFrame:
    """Rows of the fact table whose event time is after ``since``, from the partitions that hold events
    of its day or later."""
    days = spark.read.parquet(days_path).filter(F.col("event_date") >= F.to_date(moment(since)))
    fact = fact_events(spark, path).filter(F.col("timestamp") > moment(since))
    return fact.join(days.select(_DAY).distinct(), _DAY, "left_semi")


def active_carts_of_table(
    spark: SparkSession, path: str, days_path: str, as_of: str | datetime
) -> DataFrame:
    """``active_carts`` of a stored table; days without events of the last hour are not opened."""
    since = spark.range(1).select((moment(as_of) - F.make_dt_interval(hours=F.lit(1))).alias("t")).first()[0]
    return active_carts(recent_events(spark, path, days_path, f"{since}"), as_of)
