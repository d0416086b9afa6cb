"""Stream progress as metric samples."""

from __future__ import annotations

from datetime import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SAMPLE = "ts timestamp, name string, labels map<string,string>, value double"


def samples(progress) -> list[tuple]:
    """The numbers of one micro-batch: rows, durations and how far sources are behind."""
    ts = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    rows = [(ts, "batch_rows", {}, float(progress.numInputRows))]
    for phase, ms in progress.durationMs.items():
        rows.append((ts, "batch_duration_seconds", {"phase": phase}, ms / 1000.0))
    for number, source in enumerate(progress.sources):
        behind = (source.metrics or {}).get("totalOffsetsBehindLatest")
        if behind is None:
            behind = _offsets_behind(source.endOffset, source.latestOffset)
        if behind is not None:
            rows.append((ts, "consumer_lag", {"source": str(number)}, float(behind)))
    return rows


def _offsets_behind(end: str | None, latest: str | None) -> int | None:
    """Rows left per partition, where a source reports offsets as ``{topic: {partition: n}}``."""
    try:
        end_at, latest_at = json.loads(end or "null"), json.loads(latest or "null")
        return sum(
            max(0, top - end_at[topic][partition])
            for topic, partitions in latest_at.items()
            for partition, top in partitions.items()
        )
    except (TypeError, KeyError, AttributeError, ValueError):
        return None


class ProgressTable(StreamingQueryListener):
    """Appends a few sample rows per finished micro-batch to a table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = self.spark.createDataFrame(samples(event.progress), SAMPLE)
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SAMPLE).parquet(path)
