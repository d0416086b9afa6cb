"""Streams that go on where batches ended, and marks that leave the state."""

import random

import model
import pytest
from conftest import at, by_seq, event
from pyspark.sql import functions as F
from test_stream import Feed

from trolley.operators.cart import cart_snapshot
from trolley.operators.lateness import watermark_stats as batch_stats
from trolley.plans.batch import Settings, outcomes
from trolley.plans.handover import live_marks, mark_pieces, stream_state
from trolley.sources.tables import fact_events
from trolley.plans.ingest import ingest_batch
from trolley.streaming import marks as marks_module, state
from trolley.streaming.job import stream_outcomes
from trolley.streaming.marks import PARTS, SLICE_US, BloomMarks, Marks, part_of


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def streamed(feed, settings, initial, files_per_batch=1):
    rows = []
    query = (
        stream_outcomes(feed.stream(files_per_batch), settings, initial)
        .writeStream.foreachBatch(lambda df, _: rows.extend(df.collect()))
        .option("checkpointLocation", feed.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return {r.seq: (r.outcome, r.cart_total_before, r.cart_total_after) for r in rows}


@pytest.mark.parametrize(("policy", "seed"), [("accept", 31), ("adjust_window", 32)])
def test_batch_then_stream_is_one_batch(spark, frame, feed, policy, seed):
    events = model.random_events(random.Random(seed), 160, ids=40)
    settings = Settings(policy=policy, ttl_hours=0.4)
    first = outcomes(frame(*events[:90]), settings, hot=[])
    initial = stream_state(first, settings)
    for low in (90, 120):
        feed.add(frame(*events[low : low + 40 if low > 90 else 120]))
    # A user of the batch whom the stream never sees keeps its state.
    got = by_seq(first, "outcome", "cart_total_before", "cart_total_after") | streamed(feed, settings, initial)
    expected, carts, _ = model.run(events, policy, ttl_hours=0.4)
    assert {s: r[0] for s, r in got.items()} == {s: r[0] for s, r in expected.items()}
    for seq, row in expected.items():
        if row[1] is not None:
            assert got[seq][1:] == pytest.approx(row[1:], abs=1e-9)

    whole = outcomes(frame(*events), settings, hot=[])
    live = {r.user_id: r for r in state.cart_snapshot(spark, feed.checkpoint).collect()}
    for r in cart_snapshot(whole).collect():
        assert live[r.user_id] == r and r["items"] == carts[r.user_id]["items"]
    judged = whole.filter("outcome NOT IN ('invalid', 'duplicate')").drop("timestamp")
    stats = batch_stats(judged).orderBy("user_id").collect()
    assert state.watermark_stats(spark, feed.checkpoint).orderBy("user_id").collect() == stats


def test_users_without_new_events_keep_their_state(spark, frame, feed):
    first = outcomes(frame(event(0), event(1, user_id=7, product_id=3)), hot=[])
    feed.add(frame(event(2, event_id="e0"), event(3)))
    got = streamed(feed, Settings(), stream_state(first))
    assert {s: r[0] for s, r in got.items()} == {2: "duplicate", 3: "saved"}
    carts = {r.user_id: r for r in state.cart_snapshot(spark, feed.checkpoint).collect()}
    assert carts[7]["items"] == {3: 1} and carts[1001]["items"] == {101: 2}
    # Later micro-batches do not begin again with it.
    feed.add(frame(event(4, user_id=7, event_id="e1"), event(5, user_id=7, product_id=3)))
    got = streamed(feed, Settings(), stream_state(first))
    assert got == {4: ("duplicate", None, None), 5: ("saved", 9.99, pytest.approx(19.98))}


def test_a_job_goes_on_with_the_tables_of_its_batches(spark, frame, feed):
    first = ingest_batch(frame(event(0), event(1)), feed.tables, 0, hot=[])
    feed.add(frame(event(2, event_id="e1"), event(3)))
    feed.run(initial=stream_state(first), first_batch=1)
    fact = {r.event_id: float(r.cart_total_after) for r in fact_events(spark, feed.tables.fact).collect()}
    assert fact == {"e0": 9.99, "e1": 19.98, "e3": 29.97}


def test_swept_marks_leave_the_state(spark, frame, feed):
    """Expired marks go without their id coming again, for users who send nothing, too."""
    settings = Settings(sweep_after="0 seconds")
    day = 86_400
    first = outcomes(frame(event(0, event_id="old", user_id=5, arrived_at=at(-3000))), settings, hot=[])
    feed.add(frame(event(1, event_id="a"), event(2, event_id="b", user_id=2), event(3, event_id="c", arrived_at=at(3 * 3600))))
    feed.add(frame(event(4, event_id="d", arrived_at=at(day + 2 * 3600), timestamp=at(day))))
    got = streamed(feed, settings, stream_state(first, settings))
    assert {r[0] for r in got.values()} == {"saved"}
    kept = {r.dedup_key for r in state.committed_marks(spark, feed.checkpoint).collect()}
    assert kept == {"c", "d"}
    # What is left still decides.
    feed.add(frame(event(5, event_id="c", arrived_at=at(day + 2.5 * 3600)), event(6, event_id="a", arrived_at=at(day + 2.5 * 3600), timestamp=at(day + 9))))
    assert {s: r[0] for s, r in streamed(feed, settings, None).items()} == {5: "duplicate", 6: "saved"}


def test_rows_behind_the_watermark_of_arrivals_are_not_dropped(frame, feed):
    settings = Settings(sweep_after="0 seconds")
    feed.add(frame(event(0, arrived_at=at(90_000), timestamp=at(90_000))))
    feed.add(frame(event(1, user_id=2), event(2, user_id=3, price=-1.0)))
    feed.add(frame(event(3, user_id=2)))
    assert {s: r[0] for s, r in streamed(feed, settings, None).items()} == {0: "saved", 1: "saved", 2: "invalid", 3: "saved"}


def test_live_marks_and_their_pieces(spark, frame, monkeypatch):
    rows = [event(i, event_id=f"k{i}", arrived_at=at(60 * i)) for i in range(100)]
    results = outcomes(frame(*rows), Settings(ttl_hours=1), hot=[])
    marks = live_marks(results, Settings(ttl_hours=1))
    assert {r.dedup_key for r in marks.collect()} == {f"k{i}" for i in range(40, 100)}
    monkeypatch.setattr("trolley.plans.handover.WHOLE", 30)
    pieces = mark_pieces(marks).collect()
    assert sorted(k for p in pieces for k in p.dedup_keys) == sorted(f"k{i}" for i in range(40, 100))
    for p in pieces:
        assert {t // SLICE_US for t in p.processed_us} == {p.slice}
        if p.part >= 0:
            assert {part_of(k) for k in p.dedup_keys} == {p.part}
    assert {p.part >= 0 for p in pieces} == {True, False}


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Map(dict):
    reads = 0

    def getValue(self, key):
        self.reads += 1
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def containsKey(self, key):
        return key in self

    def removeKey(self, key):
        del self[key]


def test_marks_however_they_are_held(monkeypatch):
    monkeypatch.setattr(marks_module, "WHOLE", 5)
    rng = random.Random(6)
    index, parts, known, now = Value(), Map(), {}, 0
    for _ in range(200):
        marks = Marks(index, parts)
        for _ in range(rng.randint(0, 12)):
            now += rng.randint(0, SLICE_US // 8)
            key = f"id{rng.randint(0, 60)}"
            assert marks.get(key) == known.get(key)
            if key in known and rng.random() < 0.5:
                marks.drop(key, known.pop(key))
            elif key not in known:
                marks.put(key, now)
                known[key] = now
        if rng.random() < 0.2:
            horizon = now - rng.randint(0, 3) * SLICE_US
            marks.sweep(horizon)
            known = {k: t for k, t in known.items() if (t // SLICE_US + 1) * SLICE_US > horizon}
        marks.save()
        held = {k: t for keys, times in parts.values() for k, t in zip(keys, times, strict=True)}
        assert held == known
    assert any(part >= 0 for _, part in parts)


def test_of_a_spread_slice_only_the_parts_of_new_ids_are_read(monkeypatch):
    monkeypatch.setattr(marks_module, "WHOLE", 100)
    index, parts = Value(), Map()
    marks = Marks(index, parts)
    for i in range(2000):
        marks.put(f"id{i}", i)
    assert marks.save() == [0] and len(parts) > PARTS / 2
    again = Marks(index, parts)
    parts.reads = 0
    assert [again.get(k) for k in ("id5", "new")] == [5, None] and parts.reads <= 2
    assert again.save() == []


def test_bloom_filters_miss_no_mark():
    rng = random.Random(8)
    filters, known, now, wrong, asked = Map(), {}, 0, 0, 0
    filters.iterator = lambda: iter([(k, v) for k, v in filters.items()])
    for _ in range(60):
        marks = BloomMarks(filters, 1 << 12)
        for _ in range(40):
            now += SLICE_US // 60
            key = f"id{rng.randint(0, 4000)}"
            latest = marks.get(key)
            if key in known:
                assert known[key] <= latest
                assert known[key] // SLICE_US == latest // SLICE_US or latest > known[key]
            else:
                asked += 1
                wrong += latest is not None
                marks.put(key, now)
                known[key] = now
        marks.sweep(now - 24 * SLICE_US)
        known = {k: t for k, t in known.items() if (t // SLICE_US + 1) * SLICE_US > now - 24 * SLICE_US}
        marks.save()
        assert len(filters) <= 26 and {len(v[0]) for v in filters.values()} == {512}
    assert asked > 1500 and wrong < 0.02 * asked


def test_a_stream_with_bloom_filters_misses_no_duplicate(frame, feed):
    events = model.random_events(random.Random(33), 120, ids=40)
    settings = Settings(bloom_bits=1 << 12)
    first = outcomes(frame(*events[:50]), settings, hot=[])
    feed.add(frame(*events[50:]))
    got = streamed(feed, settings, stream_state(first, settings))
    expected = {s: r[0] for s, r in model.run(events)[0].items() if s >= events[50]["seq"]}
    assert {s for s, o in expected.items() if o == "duplicate"} <= {s for s, r in got.items() if r[0] == "duplicate"}
    assert sum(r[0] == "duplicate" and expected.get(s) != "duplicate" for s, r in got.items()) <= 2


def test_no_plan_of_the_state_gathers_a_user(spark, frame):
    results = outcomes(frame(event(0), event(1)), hot=[]).cache()
    pieces = stream_state(results).groupBy("user_id").agg(F.count("*").alias("n")).collect()
    assert [r.n for r in pieces] == [4]
