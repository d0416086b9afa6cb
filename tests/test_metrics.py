import pytest
from conftest import at, event
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.operators import listings, metrics
from trolley.plans.batch import fact_from_events, outcomes
from trolley.sinks.tables import write_fact


@pytest.fixture
def results(frame):
    return outcomes(
        frame(
            event(0, event_id="a", timestamp=at(600)),
            event(1, event_id="a", timestamp=at(600)),
            event(2, timestamp=at(500)),
            event(3, timestamp=at(0)),
            event(4, price=-1.0),
            event(5, user_id=None),
            event(6, event_type=S.CHECKOUT, timestamp=at(700)),
        ),
        hot=[],
    )


def test_counters(results):
    processed = {(r.event_type, r.status): r.value for r in metrics.events_processed(results).collect()}
    assert processed == {
        (S.ADD, "success"): 2,
        (S.ADD, "validation_error"): 1,
        (S.ADD, "error"): 1,
        (S.CHECKOUT, "success"): 1,
    }
    assert metrics.duplicate_events(results).first().value == 1
    late = {r.action: r.value for r in metrics.late_events(results).collect()}
    assert late == {"accepted": 1, "rejected": 1}


def test_samples_hold_the_same_counters(results):
    got = {(r.name, tuple(sorted(r.labels.items()))): r.value for r in metrics.samples_of(results).collect()}
    assert got[("duplicate_events_total", ())] == 1
    assert got[("late_events_total", (("action", "rejected"),))] == 1
    assert got[("events_processed_total", (("event_type", S.ADD), ("status", "success")))] == 2
    assert len(got) == 7


def test_histogram_is_cumulative_and_inclusive(spark):
    df = spark.createDataFrame([(x,) for x in (0.005, 0.006, 3.0, 50.0)], "s double")
    got = {r.le: r.value for r in metrics.histogram(df, "s").collect()}
    assert (got[0.005], got[0.01], got[2.5], got[5.0], got[10.0]) == (1, 2, 2, 3, 3)
    assert got[float("inf")] == 4


@pytest.mark.parametrize(
    ("values", "q", "expected"),
    [
        ([0.3] * 10, 0.5, 0.375),
        ([0.001] * 4, 0.5, 0.0025),
        ([20.0] * 3, 0.95, 10.0),
        ([0.3] * 9 + [0.6], 0.95, 0.625),
    ],
)
def test_quantile(spark, values, q, expected):
    df = spark.createDataFrame([("a", x) for x in values], "k string, s double")
    buckets = metrics.histogram(df, "s", "k")
    assert metrics.quantile_from_buckets(buckets, q, "k").first().value == pytest.approx(expected)


def test_lag_skips_unknown_and_never_goes_negative(spark):
    df = spark.createDataFrame(
        [(0, 5, 9), (1, 10, 9), (2, None, 9), (3, 5, None)],
        "partition int, position long, highwater long",
    )
    assert metrics.consumer_lag(df).first().value == 4
    assert metrics.consumer_lag(df.limit(0)).first().value == 0


def test_cumulative_over_days(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2026-01-01' + make_interval(0, 0, 0, 0, CAST(id * 7 AS INT)) AS minute, "
        "id % 2 AS label, id AS value FROM range(40)"
    )
    got = metrics.cumulative(df, "minute", "label").orderBy("minute").collect()
    running = {0: 0, 1: 0}
    for i, row in enumerate(got):
        running[i % 2] += i
        assert (row.label, row.value) == (i % 2, running[i % 2])
    assert metrics.cumulative(df, "minute").agg(F.max("value")).first()[0] == sum(range(40))


def test_last_value_skips_nulls_and_old_samples(spark):
    df = spark.createDataFrame(
        [(at(0), "a", 1.0), (at(60), "a", 2.0), (at(120), "a", None), (at(-3600), "b", 9.0)],
        "ts timestamp, name string, value double",
    )
    got = metrics.last_value(df, "name", as_of="2026-01-01 12:05:00").collect()
    assert [(r.name, r.value) for r in got] == [("a", 2.0)]


def test_latest_per_key_and_listing(spark):
    df = spark.createDataFrame(
        [("001", 1, 10, "x"), ("001", 3, 11, "y"), ("002", 2, 12, "z")],
        "version string, applied_at long, id long, name string",
    )
    got = {r.version: r.name for r in listings.latest_per_key(df, "version", "applied_at", "id").collect()}
    assert got == {"001": "y", "002": "z"}
    assert [r.id for r in listings.listed(df, "version", "applied_at").collect()] == [10, 11, 12]


def test_retention_boundary(spark):
    df = spark.createDataFrame([(at(0),), (at(0.9),), (at(1),)], "processed_at timestamp")
    kept = listings.retained(df, "2026-01-31 12:00:00").collect()
    assert [r.processed_at.second for r in kept] == [1]


def test_retention_opens_no_expired_day(spark, frame, tmp_path):
    fact = fact_from_events(frame(event(0), event(90_000)), hot=[])
    write_fact(fact, str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    kept = listings.retained(stored, "2026-02-01 00:00:00")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in plan
    assert "GreaterThanOrEqual(processed_at," in plan
    assert [r.event_id for r in kept.collect()] == ["e90000"]


def test_totals_are_lazy_and_carry_over_days(spark):
    rows = [(at(h * 3600), label, 1) for h in range(60) for label in ("a", None)]
    df = spark.createDataFrame(rows, "minute timestamp, label string, value long")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    total = metrics.cumulative(df, "minute", "label")
    assert len(tracker.getJobIdsForGroup()) == before
    for label in ("a", None):
        values = total.filter(F.col("label").eqNullSafe(label)).orderBy("minute").collect()
        assert [r.value for r in values] == list(range(1, 61))
