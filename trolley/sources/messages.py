"""Raw JSON messages: where they come from and how they become typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas as S

# One broker partition's offsets fit below this; the partition number goes above.
OFFSET_BITS = 48
CORRUPT = "_corrupt"
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
MAX_OFFSETS_PER_TRIGGER = 1_000_000
MAX_BYTES_PER_TRIGGER = 64 << 20


def packed_sequence(partition: Column, offset: Column) -> Column:
    """A unique arrival number; rows of one user share a partition, so it orders them."""
    return F.shiftleft(partition.cast("bigint"), OFFSET_BITS) + offset


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = "raw_events",
    streaming: bool = True,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    **options: str,
) -> DataFrame:
    """Messages of a topic from its earliest offset; needs the Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if streaming:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load().select(
        packed_sequence(F.col("partition"), F.col("offset")).alias("seq"),
        F.col("timestamp").alias("arrived_at"),
        F.col("value").cast("string").alias("value"),
    )


def file_messages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = S.RAW_MESSAGE,
    fmt: str = "parquet",
    streaming: bool = True,
    max_files: int | None = None,
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """Messages (or typed arrivals, by ``schema``) landed as files.

    A stream takes files of at most ``max_bytes`` in all per micro-batch, which bounds what the
    stateful operator sees of one user at a time; or ``max_files`` files, if given.
    """
    if streaming and max_files:
        reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    elif streaming:
        reader = spark.readStream.option("maxBytesPerTrigger", max_bytes)
    else:
        reader = spark.read
    return reader.format(fmt).schema(schema).load(path)


def decode(messages: DataFrame) -> DataFrame:
    """Parse ``value`` to wire fields; text that does not fit the schema stays in ``_corrupt``."""
    schema = T.StructType([*S.WIRE_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    fields = messages.withColumn("_event", parsed)
    return fields.select("seq", "arrived_at", "value", "_event.*")


def with_defaults(events: DataFrame) -> DataFrame:
    """Absent quantity, price and session take the contract's defaults."""
    return events.withColumns(
        {
            "quantity": F.coalesce("quantity", F.lit(S.DEFAULT_QUANTITY)),
            "price": F.coalesce("price", F.lit(S.DEFAULT_PRICE)),
            "session_id": F.coalesce("session_id", F.lit(S.DEFAULT_SESSION)),
        }
    )


def coerced_timestamp(text: Column, arrived_at: Column) -> Column:
    """ISO text to a timestamp; an absent one is the arrival time; unreadable text gives null.

    Only a whole date, with a time or without, is ISO text: the cast alone would take a time of day
    for one of today, or a year for its first day.
    """
    read = F.when(text.rlike(ISO_TIME), text.try_cast("timestamp"))
    return F.when(text.isNull(), arrived_at).otherwise(read)


def typed_events(messages: DataFrame) -> DataFrame:
    """Messages to arrivals plus, of unreadable ones only, ``decode_error`` and the ``value``."""
    # Times are read once and problems told once: each step is a projection of its own.
    events = with_defaults(decode(messages)).withColumn(
        "_ts", coerced_timestamp(F.col("timestamp"), F.col("arrived_at"))
    )
    problem = (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("decode_error: not a cart event"))
        .when(F.col("_ts").isNull(), F.concat(F.lit("decode_error: timestamp "), F.col("timestamp")))
    )
    return events.withColumn("decode_error", problem).select(
        "seq",
        "arrived_at",
        *[F.col("_ts").alias(f) if f == "timestamp" else F.col(f) for f in S.EVENT_FIELDS],
        "decode_error",
        F.when(F.col("decode_error").isNotNull(), F.col("value")).alias("value"),
    )
