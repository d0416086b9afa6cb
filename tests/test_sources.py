import json

import pytest
from conftest import SMALL, at
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.functions.scalars import integer_keys
from trolley.functions.times import start_of_five_minutes
from trolley.operators.prefix import hot_keys
from trolley.operators.validate import with_errors
from trolley.plans.batch import Settings, outcomes
from trolley.sinks.dead_letters import dead_letters
from trolley.sources.arrivals import cart_arrivals
from trolley.sources.messages import coerced_timestamp, packed_sequence, typed_events
from trolley.sources.replay import replay_events
from trolley.sources.tables import table


def messages(spark, *values):
    return spark.createDataFrame([(i, at(i), v) for i, v in enumerate(values)], S.RAW_MESSAGE)


def test_decode_defaults_and_errors(spark):
    good = {"event_id": "a", "user_id": 1, "event_type": "checkout"}
    df = typed_events(
        messages(
            spark,
            json.dumps(good),
            "not json",
            json.dumps({**good, "user_id": "abc"}),
            json.dumps({**good, "timestamp": "2026-01-01T10:00:00"}),
            json.dumps({**good, "timestamp": "2026-01-01T10:00:00+02:00"}),
            json.dumps({**good, "timestamp": "yesterday"}),
            json.dumps({**good, "quantity": None, "extra": 1}),
        )
    )
    rows = {r.seq: r for r in df.withColumn("us", F.unix_seconds("timestamp")).collect()}
    first = rows[0]
    assert (first.quantity, first.price, first.session_id) == (1, 0.0, "")
    assert first.us == int(at(0).timestamp()) and first.product_id is None
    assert rows[1].decode_error and rows[2].decode_error and rows[5].decode_error
    assert rows[3].us - rows[4].us == 7200
    assert rows[6].decode_error is None and rows[6].quantity == 1


def test_unreadable_message_is_dead_lettered_as_it_came(spark):
    events = typed_events(messages(spark, "not json"))
    assert with_errors(events).first().error.startswith("decode_error")
    letter = dead_letters(outcomes(events, hot=[])).first()
    assert letter.original_event == "not json" and letter.error.startswith("decode_error")


def test_packed_sequence_is_unique_and_ordered(spark):
    df = spark.createDataFrame([(0, 5), (1, 0), (1, 1)], "partition int, offset long")
    seq = [r[0] for r in df.select(packed_sequence(F.col("partition"), F.col("offset"))).collect()]
    assert seq == sorted(set(seq))


def test_replay(spark):
    plan = spark.createDataFrame(
        [
            (0, "a", 1, "add_to_cart", 101, "x", 1, 9.5, None, ""),
            (60, "b", 2, "checkout", None, None, 0, 0.0, -600, "mine"),
        ],
        "at_second long, event_id string, user_id long, event_type string, product_id long, "
        "product_name string, quantity int, price double, timestamp_offset_seconds int, "
        "session_id string",
    )
    a, b = replay_events(plan, "2026-01-01 12:00:10", "run").collect()
    assert (a.event_id, a.timestamp, a.session_id) == (
        "run-a", "2026-01-01T12:00:00", "sess_scenario_1")
    assert (b.event_id, b.timestamp, b.session_id) == ("run-b", "2026-01-01T11:51:10", "mine")
    assert replay_events(plan, "2026-01-01 12:00:10").first().event_id == "a"


def test_integer_keys(spark):
    df = spark.sql("SELECT from_json('{\"7\": 2}', 'map<string,int>') AS m")
    assert df.select(integer_keys(F.col("m"))).first()[0] == {7: 2}


def test_five_minutes(spark):
    ts = spark.sql("SELECT TIMESTAMP '2026-01-01 12:04:59.999' AS t")
    got = ts.select(start_of_five_minutes(F.col("t"))).first()[0]
    assert (got.minute, got.second) == (0, 0)


def test_fixture_counts(spark):
    out = outcomes(cart_arrivals(table(spark, SMALL, "events"), []), Settings(), [])
    counts = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert counts == {
        "saved": 573, "saved_late": 34, "late_rejected": 35, "duplicate": 38, "invalid": 370,
    }


@pytest.mark.parametrize("block_rows", [50, 400])
def test_heavy_users_change_nothing(spark, monkeypatch, block_rows):
    """All of the data in a few users that are cut into blocks."""
    monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", block_rows)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    hot = hot_keys(events, "user_id", min_rows=60)
    assert hot.count() > 3
    keep = ["seq", "outcome", "lateness_seconds", "cart_total_after", "line_quantity"]
    plain = outcomes(cart_arrivals(table(spark, SMALL, "events"), []), Settings(clean_resends=True), [])
    cut = outcomes(cart_arrivals(table(spark, SMALL, "events"), hot), Settings(clean_resends=True), hot)
    a, b = plain.select(keep).orderBy("seq").collect(), cut.select(keep).orderBy("seq").collect()
    # Money too: sums of whole cents do not depend on how they are cut.
    assert a == b


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12:30:00", None), ("2026", None), ("2026-01", None), ("2026-01-01T25:00:00", None), ("today", None),
        ("2026-01-01", (0, 0)), ("2026-01-01T12:30", (12, 30)), ("2026-01-01 12:30:00.5", (12, 30)),
        ("2026-01-01T12:30:00+02:00", (10, 30)), ("2026-01-01T12:30:00Z", (12, 30)),
    ],
)
def test_only_whole_iso_times_are_read(spark, text, expected):
    """And none of them depends on the day it is read."""
    df = spark.createDataFrame([(text,)], "t string")
    read = coerced_timestamp(F.col("t"), F.lit(None).cast("timestamp"))
    got = df.select(F.hour(read).alias("h"), F.minute(read).alias("m")).first()
    assert (None if got.h is None else tuple(got)) == expected
