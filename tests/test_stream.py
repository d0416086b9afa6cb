import os
import random

import model
import pytest
from conftest import at, by_seq, event
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from scenario import PLAN, scenario_events

from trolley import schemas as S
from trolley.operators.cart import cart_snapshot
from trolley.operators.lateness import watermark_stats as batch_stats
from trolley.operators.rollups import MINUTE
from trolley.plans.batch import Settings, outcomes
from trolley.plans.ingest import Tables, store_results, stored_rollup
from trolley.sources.messages import file_messages, typed_events
from trolley.sources.tables import fact_events
from trolley.streaming import state
from trolley.streaming.job import start_job, stream_outcomes
from trolley.streaming.progress import ProgressTable, progress_table, samples


class Feed:
    """A folder of arrival files that become micro-batches in the order they were added."""

    def __init__(self, spark, root, schema=S.ARRIVAL):
        self.spark, self.root, self.schema = spark, root, schema
        self.files = 0
        os.makedirs(f"{root}/in", exist_ok=True)

    def add(self, df):
        path = f"{self.root}/in/{self.files}"
        df.coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                target = f"{self.root}/in/part-{self.files}.parquet"
                os.link(f"{path}/{name}", target)
                os.utime(target, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    def stream(self, files_per_batch=1):
        path = f"{self.root}/in/part-*.parquet"
        return file_messages(self.spark, path, self.schema, max_files=files_per_batch)

    @property
    def checkpoint(self):
        return f"{self.root}/checkpoint"

    @property
    def tables(self):
        return Tables(f"{self.root}/tables")

    def run(self, settings=Settings(), files_per_batch=1, **options):
        start_job(
            self.stream(files_per_batch), self.tables, self.checkpoint, settings, **options
        ).awaitTermination()


def collected(feed, settings=Settings(), files_per_batch=1):
    """The stream's outcomes without the tables."""
    rows = []
    query = (
        stream_outcomes(feed.stream(files_per_batch), settings)
        .writeStream.foreachBatch(lambda df, _: rows.extend(df.collect()))
        .option("checkpointLocation", feed.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return {r.seq: (r.outcome, r.cart_total_before, r.cart_total_after) for r in rows}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


@pytest.mark.parametrize(("policy", "cuts"), [("accept", 1), ("adjust_window", 4), ("reject", 3)])
def test_stream_equals_model_and_batch(frame, feed, policy, cuts):
    """However the arrivals are cut into micro-batches, and whatever their order inside one."""
    events = model.random_events(random.Random(21), 120, ids=40)
    size = -(-len(events) // cuts)
    for start in range(0, len(events), size):
        part = events[start : start + size]
        random.Random(start).shuffle(part)
        feed.add(frame(*part))
    settings = Settings(policy=policy, ttl_hours=0.4)
    expected, carts, _ = model.run(events, policy, ttl_hours=0.4)
    got = collected(feed, settings)
    assert {s: r[0] for s, r in got.items()} == {s: r[0] for s, r in expected.items()}
    for seq, row in expected.items():
        if row[1] is not None:
            assert got[seq][1:] == pytest.approx(row[1:], abs=1e-9)
    batch = outcomes(frame(*events), settings, hot=[])
    assert {s: r[0] for s, r in got.items()} == by_seq(batch, "outcome")

    live = {r.user_id: r for r in state.cart_snapshot(feed.spark, feed.checkpoint).collect()}
    for r in cart_snapshot(batch).collect():
        mine = live[r.user_id]
        assert (mine["items"], mine.event_count) == (r["items"], r.event_count)
        assert mine.last_updated == r.last_updated
        assert mine["items"] == carts[r.user_id]["items"]
    judged = batch.filter("outcome NOT IN ('invalid', 'duplicate')").drop("timestamp")
    stats = batch_stats(judged).orderBy("user_id").collect()
    assert state.watermark_stats(feed.spark, feed.checkpoint).orderBy("user_id").collect() == stats


def test_scenario_end_to_end(spark, frame, feed):
    """Everything a job leaves, with a bad message that has no user."""
    events = scenario_events()
    for part in (events[:7], events[7:12], [*events[12:], event(99, user_id=None)]):
        feed.add(frame(*part))
    feed.run()
    fact = fact_events(spark, feed.tables.fact)
    saved = [p for p in PLAN if p[-2].startswith("saved")]
    assert fact.count() == len(saved) == 16
    errors = sorted(r.error for r in spark.read.parquet(feed.tables.dead_letter).collect())
    assert errors == ["late_event_beyond_tolerance", "unexpected_error: user_id is missing"]
    whole = MINUTE.of(fact).orderBy("minute").collect()
    assert stored_rollup(spark, feed.tables, "minute").orderBy("minute").collect() == whole
    metrics = spark.read.parquet(feed.tables.metrics).groupBy("name").agg(F.sum("value")).collect()
    assert {r[0]: r[1] for r in metrics} == {
        "events_processed_total": 17.0,
        "late_events_total": 2.0,
        "duplicate_events_total": 1.0,
    }


def test_restart_goes_on_where_it_stopped(frame, feed):
    feed.add(frame(event(0, event_id="a"), event(1, quantity=2)))
    first = collected(feed)
    feed.add(frame(event(2, event_id="a"), event(3, event_type=S.CHECKOUT)))
    second = collected(feed)
    assert first == {0: ("saved", 0.0, 9.99), 1: ("saved", 9.99, pytest.approx(29.97))}
    assert second[2][0] == "duplicate"
    assert second[3] == ("saved", pytest.approx(29.97), 0.0)


def test_failed_write_commits_nothing_and_is_repeated(spark, frame, feed):
    feed.add(frame(event(0), event(1)))

    def broken(results, tables, batch_id):
        store_results(results, tables, batch_id)
        raise OSError("disk full")

    with pytest.raises(StreamingQueryException):
        feed.run(store=broken)
    feed.add(frame(event(2, event_id="e0"), event(3)))
    feed.run()
    fact = fact_events(spark, feed.tables.fact)
    assert sorted(r.event_id for r in fact.collect()) == ["e0", "e1", "e3"]
    samples = spark.read.parquet(feed.tables.metrics)
    assert samples.filter("name = 'duplicate_events_total'").agg(F.sum("value")).first()[0] == 1


def test_expired_mark_is_removed_when_met(spark, frame, feed):
    feed.add(frame(event(0, event_id="a")))
    feed.add(frame(event(1, event_id="a", arrived_at=at(90_000), timestamp=at(90_000))))
    assert {s: r[0] for s, r in collected(feed).items()} == {0: "saved", 1: "saved"}
    marks = state.committed_marks(spark, feed.checkpoint)
    assert [(r.dedup_key, r.t) for r in marks.select(
        "dedup_key", F.unix_seconds("processed_at").alias("t")).collect()] == [
        ("a", int(at(90_000).timestamp()))]


def test_no_op_first_event_creates_a_cart(spark, frame, feed):
    feed.add(frame(event(0, event_type=S.REMOVE)))
    collected(feed)
    row = state.cart_snapshot(spark, feed.checkpoint).first()
    assert (row["items"], row.total_value, row.event_count) == ({}, 0.0, 0)


def test_raw_messages_stream(spark, feed):
    raw = Feed(spark, feed.root, S.RAW_MESSAGE)
    raw.add(
        spark.createDataFrame(
            [
                (0, at(0), '{"event_id": "a", "user_id": 1, "event_type": "add_to_cart", '
                           '"product_id": 5, "price": 2.5}'),
                (1, at(1), "broken"),
            ],
            S.RAW_MESSAGE,
        )
    )
    start_job(typed_events(raw.stream()), raw.tables, raw.checkpoint).awaitTermination()
    assert fact_events(spark, raw.tables.fact).first().event_id == "a"
    assert spark.read.parquet(raw.tables.dead_letter).first().original_event == "broken"


def test_progress_samples(spark, frame, feed, tmp_path):
    feed.add(frame(event(0)))
    path = str(tmp_path / "progress")
    listener = ProgressTable(spark, path)
    query = start_job(feed.stream(), feed.tables, feed.checkpoint)
    query.awaitTermination()
    rows = samples(query.lastProgress)
    assert ("batch_rows", {}) in [(name, labels) for _, name, labels, _ in rows]

    class Event:
        progress = query.lastProgress

    listener.onQueryProgress(Event)
    table = progress_table(spark, path)
    assert table.filter("name = 'batch_duration_seconds'").count() > 0


class FakeSource:
    metrics = {}
    endOffset = '{"raw_events": {"0": 5, "1": 7}}'
    latestOffset = '{"raw_events": {"0": 9, "1": 7}}'


class FakeProgress:
    timestamp = "2026-01-01T12:00:00.000Z"
    numInputRows = 3
    durationMs = {"addBatch": 1500}
    sources = [FakeSource]


def test_lag_from_offsets():
    rows = {name: value for _, name, _, value in samples(FakeProgress)}
    assert rows == {"batch_rows": 3.0, "batch_duration_seconds": 1.5, "consumer_lag": 4.0}
