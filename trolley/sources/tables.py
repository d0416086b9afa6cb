"""Batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas as S


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamp columns read as UTC instants."""
    local = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in local})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc_timestamps(spark.read.parquet(f"{folder}/{name}.parquet"))


def fact_events(spark: SparkSession, path: str) -> DataFrame:
    """The fact table; partition columns added by the writer are kept for pruning."""
    partitions = [
        T.StructField("processed_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
    return spark.read.schema(T.StructType([*S.FACT.fields, *partitions])).parquet(path)
