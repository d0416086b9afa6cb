import hashlib
from datetime import timedelta

import pytest
from conftest import T0, at, by_seq, event
from pyspark.sql import functions as F

from trolley.operators import fold
from trolley.operators.dedup import (
    committed_marks,
    first_copies,
    flag_against_marks,
    with_dedup_key,
)
from trolley.plans import batch
from trolley.plans.batch import Settings, judged_outcomes


def settle(df, hot, **settings):
    """Valid events through the whole job."""
    out = judged_outcomes(df, Settings(**settings), hot)
    return out.withColumn("is_duplicate", F.col("outcome") == "duplicate")


def flags(df):
    return by_seq(df, "is_duplicate")


def test_first_copy_is_kept_others_flagged(frame):
    df = frame(event(0, event_id="a"), event(1, event_id="b"), event(2, event_id="a"))
    assert flags(first_copies(df, [])) == {0: False, 1: False, 2: True}


def test_same_id_of_another_user_is_not_a_duplicate(frame):
    df = frame(event(0, event_id="a"), event(1, event_id="a", user_id=7))
    assert flags(first_copies(df, [])) == {0: False, 1: False}


def test_heavy_user_gets_the_same_flags(frame, monkeypatch):
    monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", 3)
    df = frame(*[event(i, event_id=f"e{i % 4}", user_id=1 + i % 5 // 4) for i in range(30)])
    assert flags(first_copies(df, [1])) == flags(first_copies(df, []))


def test_content_id_text(frame):
    df = frame(
        event(0),
        event(1, product_id=None),
        event(2, timestamp=T0 + timedelta(microseconds=1500)),
    )
    keys = by_seq(with_dedup_key(df, generate_ids=True), "dedup_key")
    texts = {
        0: "1001:add_to_cart:101:2026-01-01T12:00:00",
        1: "1001:add_to_cart:None:2026-01-01T12:00:01",
        2: "1001:add_to_cart:101:2026-01-01T12:00:00.001500",
    }
    assert keys == {k: hashlib.md5(t.encode()).hexdigest() for k, t in texts.items()}


def test_content_ids_ignore_the_sent_id(frame):
    df = frame(event(0, event_id="a"), event(1, event_id="b", timestamp=at(0)))
    assert flags(first_copies(df, [], generate_ids=True)) == {0: False, 1: True}


def test_against_marks(frame):
    hour = timedelta(hours=1)
    stored = frame(event(0, event_id="a"), event(1, event_id="b"), event(2, event_id="a"))
    marks = committed_marks(with_dedup_key(stored).withColumnRenamed("arrived_at", "processed_at"))
    new = frame(
        event(10, event_id="a", arrived_at=at(2) + 24 * hour - timedelta(microseconds=1)),
        event(11, event_id="a", arrived_at=at(2) + 24 * hour),
        event(12, event_id="b", arrived_at=at(3)),
        event(13, event_id="new"),
        event(14, event_id="new"),
        event(15, event_id="a", user_id=5),
    )
    out = flag_against_marks(with_dedup_key(new), marks.unionByName(marks))
    assert flags(out) == {10: True, 11: False, 12: True, 13: False, 14: False, 15: False}


def test_marks_too_old_to_live_are_not_read(spark, frame, tmp_path):
    stored = with_dedup_key(frame(event(0))).withColumnRenamed("arrived_at", "processed_at")
    stored.write.parquet(str(tmp_path / "marks"))
    marks = spark.read.parquet(str(tmp_path / "marks"))
    out = flag_against_marks(with_dedup_key(frame(event(90_000))), marks)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(processed_at), GreaterThan(processed_at," in text


def test_a_chain_of_copies_takes_one_more_pass(spark, frame, monkeypatch):
    """Forty copies, thirteen hours apart: every second one is new."""
    passes = []
    monkeypatch.setattr(
        batch, "one_by_one", lambda *a: passes.append(1) or fold.one_by_one(*a)
    )
    df = frame(
        *[event(i, event_id="a", arrived_at=at(i * 13 * 3600), timestamp=at(0)) for i in range(40)]
    )
    assert flags(settle(df, [])) == {i: i % 2 == 1 for i in range(40)}
    assert len(passes) == 1


def test_ttl_chain(frame):
    """Kept at 0 h; dropped at 23 h, which does not refresh the mark; kept at 25 h and marked
    anew; dropped at 48 h; kept at exactly 24 h after the second mark."""
    hours = [0, 23, 25, 48, 49]
    df = frame(
        *[event(i, event_id="a", arrived_at=at(h * 3600), timestamp=at(0))
          for i, h in enumerate(hours)]
    )
    assert flags(settle(df, [])) == {0: False, 1: True, 2: False, 3: True, 4: False}


def test_ttl_is_a_setting(frame):
    df = frame(
        event(0, event_id="a"), event(1, event_id="a", arrived_at=at(7200), timestamp=at(0))
    )
    assert flags(settle(df, [], ttl_hours=1)) == {0: False, 1: False}


def test_rejected_event_leaves_no_mark(frame):
    """Its re-send is judged again, and counts as new once it claims a time that is not late."""
    df = frame(
        event(0, event_id="x", timestamp=at(5000)),
        event(1, event_id="a", timestamp=at(0)),
        event(2, event_id="a", timestamp=at(0)),
        event(3, event_id="a", timestamp=at(5001)),
        event(4, event_id="a", timestamp=at(5001)),
    )
    out = settle(df, [])
    assert flags(out) == {0: False, 1: False, 2: False, 3: False, 4: True}
    assert by_seq(out, "action")[2] == "rejected"


def test_duplicate_does_not_move_the_watermark(frame):
    df = frame(
        event(0, event_id="a", timestamp=at(0)),
        event(1, event_id="a", timestamp=at(9000)),
        event(2, event_id="b", timestamp=at(10)),
    )
    out = settle(df, [])
    assert flags(out) == {0: False, 1: True, 2: False}
    assert by_seq(out, "action")[2] == "on_time"


def test_marks_keep_the_newest(frame):
    stored = with_dedup_key(frame(event(0, event_id="a"), event(5, event_id="a")))
    marks = committed_marks(stored.withColumnRenamed("arrived_at", "processed_at"))
    micros = marks.select(F.unix_seconds("processed_at")).first()[0]
    assert micros == int(at(5).timestamp())
