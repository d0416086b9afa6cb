"""Chains of marks found in parallel, against taking events one by one."""

import random

import pytest
from conftest import at, by_seq, event
from pyspark.sql import functions as F

from trolley.operators import expiry
from trolley.operators.dedup import ttl_micros
from trolley.operators.expiry import in_order, mark_chains, next_copies
from trolley.plans import batch
from trolley.plans.batch import Settings, judged_outcomes

HOUR = 3_600_000_000


def instants(spark, times):
    return spark.createDataFrame([(1, "a", t) for t in times], "user_id long, dedup_key string, at long")


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_next_copies_and_chains(spark, monkeypatch, slices):
    monkeypatch.setattr(expiry, "SLICES", slices)
    rng = random.Random(slices)
    times = sorted({rng.randint(0, 40) * HOUR // 4 + rng.choice((0, 0, 7)) for _ in range(60)} | {10**6 * HOUR})
    ttl = HOUR
    found = {r.at: r.next for r in next_copies(instants(spark, times), ttl).collect()}
    assert found == {t: n for t in times if (n := next((x for x in times if x >= t + ttl), None)) is not None}
    chain = [times[0]]
    while chain[-1] in found:
        chain.append(found[chain[-1]])
    assert sorted(r.at for r in mark_chains(instants(spark, times), ttl).collect()) == chain and len(chain) > 5


def arrivals(rng, n, users=2):
    """Events in order, ids that recur, some that do not fit; several of one instant."""
    rows, now = [], 0
    for i in range(n):
        now += rng.choice((0, 0, 600, 1800, 5400))
        e = event(i, event_id=f"k{rng.randint(0, 5)}", user_id=rng.randint(1, users), arrived_at=at(now), timestamp=at(now))
        if rng.random() < 0.1:
            e |= {"quantity": 70_000}
        rows.append(e)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_heavy_users_in_order_equal_one_by_one(frame, monkeypatch, seed):
    monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", 40)
    rows = frame(*arrivals(random.Random(seed), 200))
    settings = Settings(ttl_hours=1)
    columns = ["outcome", "error", "is_late", "watermark_before", "watermark_after", "cart_total_before", "cart_total_after", "cart_changed"]
    expected = by_seq(judged_outcomes(rows, settings, []), *columns)
    assert {"duplicate", "saved", "sink_range"} == {r[0] for r in expected.values()}
    seen = []
    monkeypatch.setattr(batch, "ordered_outcomes", lambda *a: seen.append(a))
    assert by_seq(judged_outcomes(rows, settings, [1, 2]), *columns) == expected
    assert not seen


def test_users_out_of_order_and_carts_that_outgrow_go_one_by_one(frame):
    rng = random.Random(3)
    rows = arrivals(rng, 120, users=3)
    for e in rows:
        if e["user_id"] == 1 and rng.random() < 0.2:
            e["timestamp"] = e["arrived_at"] - (at(200) - at(0))
        if e["user_id"] == 2:
            e["price"] = 30_000_000.0
    settings = Settings(ttl_hours=1)
    expected = by_seq(judged_outcomes(frame(*rows), settings, []), "outcome", "cart_total_after")
    assert by_seq(judged_outcomes(frame(*rows), settings, [1, 2, 3]), "outcome", "cart_total_after") == expected
    assert {r.user_id for r in in_order(frame(*rows), [1, 2, 3]).collect()} == {2, 3}


def test_copies_of_one_id_are_many_tasks_work(spark):
    """No partition of the search for the next copy holds more than a slice's."""
    copies = spark.range(20_000).select(
        F.lit(1).cast("long").alias("user_id"), F.lit("a").alias("dedup_key"), (F.col("id") * 60_000_000).alias("at")
    )
    ttl = ttl_micros(24)
    chain = sorted(r.at for r in mark_chains(copies, ttl).collect())
    assert chain == list(range(0, 20_000 * 60_000_000, ttl))
    plan = next_copies(copies, ttl)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert any("_slice" in w.split("rowframe")[-1] or "_slice" in w for w in windows)
