import random

import model
import pytest
from pyspark.sql import functions as F

from trolley.operators.rollups import (
    ROLLUPS,
    MINUTE,
    PARTIALS,
    active_carts,
    minute_from_sketches,
    minute_sketches,
    summed_merge,
)
from trolley.plans.batch import fact_from_events
from trolley.plans.ingest import (
    Tables,
    compact_partials,
    compaction_steps,
    partial_of,
    stored_rollup,
)
from trolley.sinks.tables import write_batch


@pytest.fixture(scope="module")
def fact(spark):
    from trolley import schemas as S

    events = model.random_events(random.Random(3), 400, users=6)
    rows = [tuple(e[n] for n in S.ARRIVAL.names) for e in events]
    df = fact_from_events(spark.createDataFrame(rows, S.ARRIVAL), hot=[])
    return df.withColumn("product_name", F.concat(F.lit("p"), "product_id")).cache()


def same(a, b):
    columns = sorted(a.columns)
    key = lambda r: str(r)
    assert sorted(a.select(columns).collect(), key=key) == sorted(
        b.select(columns).collect(), key=key
    )


@pytest.mark.parametrize("name", ROLLUPS)
def test_batches_of_any_cut_merge_to_the_whole(fact, name):
    rollup = ROLLUPS[name]
    parts = [fact.filter(F.abs(F.hash("event_id")) % 3 == i) for i in range(3)]
    partials = rollup.partial(parts[0])
    for part in parts[1:]:
        partials = partials.unionByName(rollup.partial(part))
    same(rollup.of_partials(partials), rollup.of(fact))
    # Merging may itself be done in steps.
    same(rollup.result(rollup.merged(rollup.merged(partials))), rollup.of(fact))


def test_minute_against_plain_aggregates(fact):
    plain = fact.groupBy(F.date_trunc("MINUTE", "timestamp").alias("minute")).agg(
        F.countDistinct("user_id").alias("u"),
        F.countDistinct(F.when(F.col("event_type") == "checkout", F.col("user_id"))).alias("c"),
        F.max("cart_total_after").alias("m"),
        F.avg(F.col("cart_total_after").cast("double")).alias("a"),
    )
    expected = {r.minute: (r.u, r.c, r.m, pytest.approx(r.a)) for r in plain.collect()}
    got = {
        r.minute: (r.unique_users, r.unique_checkout_users, r.max_cart_value, r.avg_cart_value)
        for r in MINUTE.of(fact).collect()
    }
    assert got == expected


def test_rollup_plans_no_row_expansion(fact):
    text = MINUTE.of(fact)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text


def test_sums_without_a_match_are_zero(fact):
    adds = fact.filter("event_type = 'add_to_cart'")
    row = MINUTE.of(adds).first()
    assert (row.revenue_total, row.checkout_value, row.unique_checkout_users) == (0, 0, 0)


def test_sketches_agree_on_small_sets(fact):
    halves = [fact.filter(F.abs(F.hash("event_id")) % 2 == i) for i in range(2)]
    merged = minute_from_sketches(minute_sketches(halves[0]).union(minute_sketches(halves[1])))
    exact = MINUTE.of(fact).select(*merged.columns)
    same(merged, exact)


def test_summed_merge_adds_up_block_results(fact):
    block = F.abs(F.hash("event_id")) % 2
    got = {r.minute: r for r in summed_merge(MINUTE, fact, block).collect()}
    expected = {}
    for i in range(2):
        for r in MINUTE.of(fact.filter(block == i)).collect():
            total, users = expected.get(r.minute, (0, 0))
            expected[r.minute] = (total + r.max_cart_value, users + r.unique_users)
    assert {m: (r.max_cart_value, r.unique_users) for m, r in got.items()} == expected


def test_active_carts_window_is_strict(fact):
    newest = fact.filter("event_type <> 'checkout'").agg(F.max("timestamp").alias("t"))
    edge = newest.select(F.col("t") + F.expr("INTERVAL 1 HOUR")).first()[0]
    assert active_carts(fact, f"{edge}").count() == 0


@pytest.mark.parametrize("name", ROLLUPS)
def test_what_batches_leave_merges_to_the_whole(spark, fact, tmp_path, name):
    """A few rows a key, however many events; compacted or not."""
    tables = Tables(str(tmp_path))
    _parts(fact, tables, name, range(3))
    whole = ROLLUPS[name].of(fact)
    same(stored_rollup(spark, tables, name).select(*whole.columns), whole)
    compact_partials(spark, tables, name, 1)
    assert {r.batch_id for r in spark.read.parquet(tables.partials(name)).collect()} == {1, 2}
    same(stored_rollup(spark, tables, name).select(*whole.columns), whole)
    compact_partials(spark, tables, name, 2)
    assert spark.read.parquet(tables.partials(name)).count() == whole.count()


def test_users_of_several_buckets_are_counted_once(fact):
    ids = [1, 32_768, 32_769, 70_000, 5_000_000_000]
    spread = fact.withColumn("user_id", F.element_at(F.lit(ids), F.pmod(F.hash("event_id"), F.lit(5)) + 1))
    spread = spread.withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    parts = [spread.filter(F.pmod(F.hash("session_id", "event_id"), F.lit(2)) == i) for i in (0, 1)]
    bitmaps = PARTIALS["minute"]
    merged = bitmaps.of_partials(bitmaps.partial(parts[0]).unionByName(bitmaps.partial(parts[1])))
    same(merged, MINUTE.of(spread).select(*merged.columns))
    assert merged.agg(F.max("unique_users")).first()[0] == 5


def test_theta_errors_are_within_what_is_stated(spark, fact):
    """A set that errs, from ten sketches."""
    row = fact.filter("event_type = 'add_to_cart' AND product_id > 0").limit(1).drop("user_id")
    crowd = row.crossJoin(spark.range(1, 50_001).withColumnRenamed("id", "user_id"))
    theta = PARTIALS["product"]
    found = theta.of_partials(theta.partial(crowd.withColumn("part", F.col("user_id") % 10), "part").drop("part")).first()
    assert found.add_count == 50_000 and found.unique_users != 50_000
    assert abs(found.unique_users - 50_000) < 5 * 0.016 * 50_000


def _parts(fact, tables, name, batches):
    for i in batches:
        part = fact.filter(F.abs(F.hash("event_id")) % 3 == i % 3)
        write_batch(partial_of(name, part), tables.partials(name), i)


@pytest.mark.parametrize("name", ["minute", "hourly_user"])
def test_a_compaction_may_break_off_anywhere(spark, fact, tmp_path, name):
    """After every step readers see all batches once, and the next run finishes the work."""
    whole = None
    steps = ["merged", "deleted 0", "deleted 1", "deleted 2", "moved"]
    for stop in range(1, len(steps) + 1):
        tables = Tables(str(tmp_path / str(stop)))
        _parts(fact, tables, name, range(3))
        whole = whole or sorted(stored_rollup(spark, tables, name).collect(), key=str)
        broken = compaction_steps(spark, tables, name, 2)
        assert [next(broken) for _ in range(stop)] == steps[:stop]
        broken.close()
        assert sorted(stored_rollup(spark, tables, name).collect(), key=str) == whole
        # Batches that came since are neither lost nor merged by the run that finishes.
        _parts(fact, tables, name, [3])
        compact_partials(spark, tables, name, 2)
        found = spark.read.parquet(tables.partials(name))
        assert {r.batch_id for r in found.select("batch_id").distinct().collect()} == {2, 3}
        events = stored_rollup(spark, tables, name).count()
        assert events == len(whole)
    assert whole == sorted(ROLLUPS[name].of(fact).select(*stored_rollup(spark, tables, name).columns).collect(), key=str)


def test_a_merge_that_was_not_finished_is_made_again(spark, fact, tmp_path):
    tables = Tables(str(tmp_path))
    _parts(fact, tables, "minute", range(3))
    whole = sorted(stored_rollup(spark, tables, "minute").collect())
    next(compaction_steps(spark, tables, "minute", 2))
    (tmp_path / "partials_minute_compacted" / "batch_id=2" / "_SUCCESS").unlink()
    assert sorted(stored_rollup(spark, tables, "minute").collect()) == whole
    compact_partials(spark, tables, "minute", 2)
    assert sorted(stored_rollup(spark, tables, "minute").collect()) == whole
    assert not (tmp_path / "partials_minute_compacted" / "batch_id=2").exists()
