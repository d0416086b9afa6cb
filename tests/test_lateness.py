import pytest
from conftest import at, by_seq, event
from pyspark.sql import functions as F

from trolley.operators.lateness import (
    ACCEPT,
    ADJUST,
    REJECT,
    classify,
    stats_of_user,
    watermark_stats,
)


def times(frame, *seconds, user_id=1001):
    return frame(*[event(i, timestamp=at(s), user_id=user_id) for i, s in enumerate(seconds)])


def actions(df):
    return list(dict(sorted(by_seq(df, "action").items())).values())


def test_first_event_is_on_time_and_sets_the_watermark(frame):
    out = classify(times(frame, 0, 60), [])
    assert actions(out) == ["on_time", "on_time"]
    marks = by_seq(out, F.unix_seconds("watermark_before"))
    assert marks[0] == 0 and marks[1] == int(at(0).timestamp())


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        (ACCEPT, ["on_time", "accepted", "accepted", "rejected", "on_time"]),
        (REJECT, ["on_time", "rejected", "rejected", "rejected", "on_time"]),
        (ADJUST, ["on_time", "adjusted", "adjusted", "rejected", "on_time"]),
    ],
)
def test_policies_and_boundaries(frame, policy, expected):
    """180 s late, exactly 300 s, a microsecond more, and equal to the watermark."""
    df = times(frame, 600, 420, 300, 299.999999, 600)
    assert actions(classify(df, [], policy)) == expected


def test_lateness_in_seconds(frame):
    out = by_seq(classify(times(frame, 600, 420.5, 700), []), "lateness_seconds", "is_late")
    assert out == {0: (0.0, False), 1: (179.5, True), 2: (0.0, False)}


def test_adjusted_event_moves_to_the_watermark(frame):
    out = classify(times(frame, 600, 420), [], ADJUST)
    moved = by_seq(out, F.unix_seconds("timestamp"), F.unix_seconds("original_timestamp"))
    assert moved[1] == (int(at(600).timestamp()), int(at(420).timestamp()))


def test_users_do_not_share_watermarks(frame):
    df = frame(event(0, timestamp=at(9000)), event(1, timestamp=at(0), user_id=2))
    assert actions(classify(df, [])) == ["on_time", "on_time"]


def test_late_events_do_not_lower_the_watermark(frame):
    out = classify(times(frame, 600, 400, 350), [])
    assert by_seq(out, "lateness_seconds")[2] == 250.0


def test_heavy_user(frame, monkeypatch):
    monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", 2)
    df = times(frame, 600, 420, 300, 299, 700, 650, 100, 701)
    keep = ["seq", "action", "watermark_before", "watermark_after"]
    assert sorted(classify(df, [1001]).select(keep).collect()) == sorted(
        classify(df, []).select(keep).collect()
    )


def test_unknown_policy(frame):
    with pytest.raises(ValueError):
        classify(times(frame, 0), [], "drop")


def test_stats(frame):
    stats = watermark_stats(classify(times(frame, 600, 420, 0, 700), [], ADJUST))
    row = stats_of_user(stats, 1001).select(
        F.unix_seconds("max_timestamp"), "late_event_count", "adjusted_event_count"
    )
    assert tuple(row.first()) == (int(at(700).timestamp()), 1, 1)
    seen = stats.select(F.unix_seconds("last_processed")).first()[0]
    assert seen == int(at(3).timestamp())


def test_stats_of_unknown_user(frame):
    stats = watermark_stats(classify(times(frame, 0), []))
    row = stats_of_user(stats, 4).first()
    assert row.late_event_count == 0 and row.last_processed is None
    assert row.max_timestamp.year == 1970
