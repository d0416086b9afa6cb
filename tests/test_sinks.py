import glob
import json

import pyarrow.parquet as pq
import pytest
from conftest import at, event
from pyspark.sql import functions as F

from trolley import schemas as S
from trolley.operators.listings import latest_events, retained
from trolley.operators.metrics import flush_errors
from trolley.plans.batch import Settings, accepted_events, outcomes
from trolley.plans.reads import active_carts_of_table, event_days, latest_events_of_table, newest_days
from trolley.plans.ingest import Tables, flush_batch, ingest_batch, stored_rollup
from trolley.operators.rollups import MINUTE, active_carts
from trolley.sinks.dead_letters import (
    dead_letters,
    failed_flush,
    late_rejections,
    out_of_range,
)
from trolley.sinks.flush import FlushError, flush
from trolley.sinks.publish import enriched_messages, wire_messages
from trolley.sinks.clustering import two_ways
from trolley.sinks.tables import drop_expired, laid_out, write_batch, write_fact
from trolley.sources.tables import fact_events


@pytest.fixture
def accepted(frame):
    return accepted_events(outcomes(frame(event(0), event(1), event(2)), hot=[]))


class Recorder(list):
    def __call__(self, df):
        self.append(df.collect())


def test_flush_writes_then_commits(accepted):
    written, letters, commits = Recorder(), Recorder(), []
    assert flush(accepted, written, letters, lambda: commits.append(len(written)))
    assert [r.event_id for r in written[0]] == ["e0", "e1", "e2"]
    assert commits == [1] and letters == []


def test_failed_flush_dead_letters_the_whole_batch(accepted):
    letters, commits = Recorder(), []

    def broken(df):
        raise OSError("disk full")

    with pytest.raises(FlushError):
        flush(accepted, broken, letters, lambda: commits.append(1))
    assert [r.error for r in letters[0]] == ["sink_write_failed: disk full"] * 3
    assert {json.loads(r.original_event)["event_id"] for r in letters[0]} == {"e0", "e1", "e2"}
    assert commits == []


def test_flush_errors_are_counted_by_row_and_batch(spark, accepted, tmp_path):
    for batch_id in (1, 2):
        write_batch(failed_flush(accepted, "disk full"), str(tmp_path / "letters"), batch_id)
    row = flush_errors(spark.read.parquet(str(tmp_path / "letters"))).first()
    assert (row.event_type, row.value, row.failed_batches) == (S.ADD, 6, 2)


def test_failed_batches_are_in_the_metrics(spark, accepted, tmp_path):
    tables = Tables(str(tmp_path))
    accepted = accepted.cache()

    def broken(df):
        raise OSError("disk full")

    for batch_id, write in ((1, None), (2, broken), (3, broken)):
        if write:
            with pytest.raises(FlushError):
                flush_batch(accepted, tables, batch_id, write)
        else:
            assert flush_batch(accepted, tables, batch_id)
    samples = spark.read.parquet(tables.metrics).filter("name = 'events_processed_total'")
    counts = samples.groupBy("labels.status").agg(F.sum("value")).collect()
    assert {r[0]: r[1] for r in counts} == {"success": 3.0, "flush_error": 6.0}
    assert fact_events(spark, tables.fact).count() == 3
    # What is written at last is no longer counted as lost.
    flush_batch(accepted, tables, 2)
    samples = spark.read.parquet(tables.metrics).filter("labels.status = 'flush_error'")
    assert samples.agg(F.sum("value")).first()[0] == 3.0


def test_empty_flush_does_nothing(accepted):
    written = Recorder()
    assert not flush(accepted.limit(0), written, written)
    assert written == []


def test_dead_letters_keep_the_event(frame):
    out = outcomes(
        frame(event(0, timestamp=at(9000)), event(1, timestamp=at(0)), event(2, price=-1.0)), hot=[]
    )
    late = late_rejections(out).first()
    document = json.loads(late.original_event)
    assert late.error == "late_event_beyond_tolerance"
    assert document["timestamp"] == "2026-01-01T12:00:00.000000" and document["price"] == 9.99
    assert list(document) == S.EVENT_FIELDS
    assert {r.error for r in dead_letters(out).collect()} == {
        "late_event_beyond_tolerance",
        "validation_error: Negative price: -1.0",
    }


def test_out_of_range_letters(frame):
    rows = outcomes(frame(event(0, quantity=70_000), event(1)), hot=[])
    assert [r.error for r in out_of_range(rows).collect()] == ["sink_range: quantity"]


def test_messages(accepted, frame):
    row = enriched_messages(accepted).first()
    document = json.loads(row.value)
    assert row.key == "1001" and document["cart_total_after"] == 9.99
    assert document["processed_at"] == "2026-01-01T12:00:00.000000"
    wire = json.loads(wire_messages(frame(event(0, product_name=None))).first().value)
    assert list(wire) == S.EVENT_FIELDS and wire["product_name"] is None


def test_repeated_batch_replaces_itself(spark, frame, tmp_path):
    tables = Tables(str(tmp_path))
    first = frame(event(0), event(1, price=-1.0), event(2, timestamp=at(-5000)))
    ingest_batch(first, tables, 1, hot=[])
    ingest_batch(first, tables, 1, hot=[])
    ingest_batch(frame(event(7, user_id=3)), tables, 2, hot=[])
    fact = fact_events(spark, tables.fact)
    assert sorted(r.event_id for r in fact.collect()) == ["e0", "e7"]
    assert spark.read.parquet(tables.dead_letter).count() == 2
    assert spark.read.parquet(tables.enriched).count() == 2
    whole = MINUTE.of(fact).orderBy("minute").collect()
    assert stored_rollup(spark, tables, "minute").orderBy("minute").collect() == whole


def test_layout_and_pruning(spark, accepted, tmp_path):
    path = str(tmp_path / "fact")
    from trolley.operators.enrich import fact_rows

    write_fact(fact_rows(accepted).cache(), path)
    fact = fact_events(spark, path)
    assert fact.select(S.FACT.names).schema == S.FACT
    plan = fact.filter("processed_date = DATE '2026-01-01' AND user_id = 1001").select("price")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in text
    assert "EqualTo(user_id,1001)" in text and "ReadSchema: struct<user_id:bigint,price" in text


def test_expired_days_are_dropped(spark, accepted, tmp_path):
    from trolley.operators.enrich import fact_rows

    path = str(tmp_path / "fact")
    rows = fact_rows(accepted)
    older = rows.withColumn("processed_at", F.col("processed_at") - F.expr("INTERVAL 3 DAYS"))
    write_fact(rows.unionByName(older).cache(), path)
    as_of = "2026-01-30 11:00:00"
    before = retained(fact_events(spark, path), as_of).count()
    assert drop_expired(spark, path, as_of) == ["processed_date=2025-12-29"]
    assert fact_events(spark, path).count() == 3
    assert retained(fact_events(spark, path), as_of).count() == before == 3


def _three_days(spark, accepted, tables):
    from trolley.operators.enrich import fact_rows

    rows = fact_rows(accepted).cache()
    for batch, days in enumerate((0, 1, 2)):
        back = F.expr(f"INTERVAL {days} DAYS")
        moved = rows.withColumns({"processed_at": F.col("processed_at") - back, "timestamp": F.col("timestamp") - back})
        write_fact(moved.cache(), tables.fact, batch)
        write_batch(event_days(moved), tables.event_days, batch)
    return rows


def _opened(df):
    """The days whose files a query reads."""
    return {p.split("processed_date=")[1][:10] for p in df.inputFiles()}


def test_newest_rows_open_the_newest_days(spark, accepted, tmp_path):
    tables = Tables(str(tmp_path))
    n = _three_days(spark, accepted, tables).count()
    assert newest_days(spark, tables.fact, 1) == ["2026-01-01"]
    assert newest_days(spark, tables.fact, n + 1) == ["2026-01-01", "2025-12-31"]
    assert len(newest_days(spark, tables.fact, 10 * n)) == 3
    for rows in (1, n, n + 1, 10 * n):
        expected = latest_events(fact_events(spark, tables.fact), rows).collect()
        assert latest_events_of_table(spark, tables.fact, rows).collect() == expected
    plan = latest_events_of_table(spark, tables.fact, n)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in plan and "2026-01-01" in plan


def test_recent_carts_prune_days_by_their_events(spark, accepted, tmp_path):
    """A late event of today's last hour that was processed yesterday by a clock that is behind."""
    tables = Tables(str(tmp_path))
    _three_days(spark, accepted, tables)
    odd = fact_events(spark, tables.fact).filter("processed_date = DATE '2025-12-31'").drop("processed_date", "batch_id")
    odd = odd.withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 1 DAY"), "user_id": F.lit(9).cast("bigint")}).cache()
    write_fact(odd, tables.fact, 7)
    write_batch(event_days(odd), tables.event_days, 7)
    as_of = "2026-01-01 12:30:00"
    found = active_carts_of_table(spark, tables.fact, tables.event_days, as_of)
    expected = active_carts(fact_events(spark, tables.fact), as_of).collect()
    assert found.collect() == expected and 9 in {r.user_id for r in expected}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [" in plan


def _ranges(path, column):
    """The least and largest value of a column in each file, as its footer says."""
    found = []
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found.append((min(s.min for s in stats), max(s.max for s in stats)))
    return found


def test_two_way_clustering_opens_few_files_either_way(spark, frame, tmp_path):
    from trolley.operators.enrich import fact_rows

    minutes, users = 64, 64
    rows = [event(m * users + u, user_id=u + 1, timestamp=at(60 * m), arrived_at=at(60 * m)) for m in range(minutes) for u in range(users)]
    fact = fact_rows(accepted_events(outcomes(frame(*rows), Settings(clean_resends=True), hot=[]))).cache()
    opened = {}
    for name, layout in (("one", laid_out), ("two", two_ways)):
        path = str(tmp_path / name)
        write_fact(fact, path, files=16, layout=layout)
        assert sorted(fact_events(spark, path).select(fact.columns).collect()) == sorted(fact.collect())
        by_user, by_time = _ranges(path, "user_id"), _ranges(path, "timestamp")
        assert len(by_user) == 16
        moments = [at(60 * m).replace(tzinfo=by_time[0][0].tzinfo) for m in range(minutes)]
        opened[name] = (
            sum(low <= u + 1 <= high for u in range(users) for low, high in by_user) / users,
            sum(low <= t <= high for t in moments for low, high in by_time) / minutes,
        )
    assert opened["one"][0] == 16 and max(opened["two"]) < 8
