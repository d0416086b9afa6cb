"""Writing tables batch by batch, so that a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.times import start_of_minute
from trolley.schemas import RETENTION_DAYS

BATCH = "batch_id"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store a batch under its number, replacing what an earlier attempt left there."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def laid_out(fact: DataFrame, files: int | None = None) -> DataFrame:
    """Rows clustered for reading: by type, minute and user within each file.

    The ranges are cut from a sample of the rows, so a heavy type or user spans several files.
    """
    minute = start_of_minute(F.col("timestamp"))
    keys = [F.col("event_type"), minute, F.col("user_id")]
    ranges = [F.col("processed_date"), *keys, F.col("event_id")]
    spread = fact.repartitionByRange(*([files] if files else []), *ranges)
    return spread.sortWithinPartitions("processed_date", *keys)


def write_fact(
    fact: DataFrame,
    path: str,
    batch_id: int = 0,
    files: int | None = None,
    layout: Callable[[DataFrame, int | None], DataFrame] = laid_out,
) -> None:
    """Append a batch to the fact table, partitioned for retention and idempotent per batch.

    ``layout`` clusters the rows: ``laid_out`` for reads of a time range, ``clustering.two_ways`` for those
    of a user as well.

    ``fact`` is read twice (the ranges are sampled first), so it should come from storage or a
    cache, as it does in ``store_results``. Min/max statistics come with Parquet; ``user_id`` gets a Bloom filter for point reads.
    """
    dated = fact.withColumns(
        {"processed_date": F.to_date("processed_at"), BATCH: F.lit(batch_id).cast("bigint")}
    )
    (
        layout(dated, files)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**{"parquet.bloom.filter.enabled#user_id": "true"})
        .partitionBy("processed_date", BATCH)
        .parquet(path)
    )


def drop_expired(
    spark: SparkSession, path: str, as_of: str, days: int = RETENTION_DAYS
) -> list[str]:
    """Delete whole days of the fact table that lie beyond retention; rows of the day the horizon
    falls in are hidden by ``retained`` until their day has passed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    horizon = spark.sql(
        f"SELECT CAST(date_sub(CAST(CAST('{as_of}' AS TIMESTAMP) AS DATE), {days}) AS STRING)"
    ).first()[0]
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("processed_date=") and name.split("=", 1)[1] < horizon:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
