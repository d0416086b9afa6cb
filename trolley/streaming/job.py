"""The event job as one streaming query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trolley.operators.dedup import with_dedup_key
from trolley.operators.fold import DECISION
from trolley.operators.validate import with_errors
from trolley.plans.batch import (
    OUTCOME_COLUMNS,
    Settings,
    invalid_outcomes,
    plain_numbers,
    with_times,
)
from trolley.plans.ingest import Tables, store_results
from trolley.streaming.processor import CartProcessor


def stream_outcomes(
    events: DataFrame, settings: Settings = Settings(), initial: DataFrame | None = None
) -> DataFrame:
    """Every arrival with its outcome, as the batch job gives it; works on streams.

    Invalid events bypass the state and its shuffle. ``initial`` is the state to begin with, from
    ``plans.handover``; a checkpoint that holds state already ignores it. The watermark of arrivals
    drives the timers that remove expired marks and nothing else: the operator does not see the
    column, so no row is ever dropped for being behind it.
    """
    if settings.sweep_after is not None:
        events = events.withWatermark("arrived_at", settings.sweep_after)
    checked = with_errors(events, settings.rules)
    own = [c for c in events.columns if c != "decode_error"]
    valid = with_dedup_key(
        checked.filter("error IS NULL").select(*own), settings.generate_ids
    )
    plain = plain_numbers(valid)
    judged = plain.groupBy("user_id").transformWithState(
        statefulProcessor=CartProcessor(settings, plain.columns),
        outputStructType=T.StructType([*plain.schema.fields, *DECISION.fields]),
        outputMode="Append",
        timeMode="None" if settings.sweep_after is None else "EventTime",
        initialState=None if initial is None else initial.groupBy("user_id"),
    )
    judged = with_times(judged).select(*own, *OUTCOME_COLUMNS)
    return judged.unionByName(invalid_outcomes(checked, own))


def start_job(
    events: DataFrame,
    tables: Tables,
    checkpoint: str,
    settings: Settings = Settings(),
    once: bool = True,
    every: str = "10 seconds",
    store: Callable[[DataFrame, Tables, int], None] = store_results,
    initial: DataFrame | None = None,
    first_batch: int = 0,
) -> StreamingQuery:
    """Run the job on a stream of typed events.

    A failing write fails the micro-batch: nothing is committed, and starting again on the same
    checkpoint repeats it. The batch is cached because every write would run the stateful operator
    again otherwise. A stream that goes on from batches begins with their state (``initial``) and
    numbers its own batches from ``first_batch`` on, so that it replaces none of theirs.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store(batch, tables, first_batch + batch_id)
        finally:
            batch.unpersist()

    writer = (
        stream_outcomes(events, settings, initial)
        .writeStream.foreachBatch(handle)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()
