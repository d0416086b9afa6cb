import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trolley.operators import prefix
from trolley.operators.prefix import (
    Peak,
    hot_keys,
    per_key,
    running,
    running_last,
    running_max,
    running_min,
    running_sum,
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [
        (rng.choices([1, 2, 3], [6, 1, 1])[0], i, rng.choice([None, *range(-5, 6)]))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "k long, seq long, v long")


def _step(df):
    return running(
        df,
        ["k"],
        ["seq"],
        total=running_sum("v"),
        before=running_sum("v", include_row=False),
        top=running_max("v"),
        low=running_min("v", include_row=False),
        last=running_last("v"),
        previous=running_last("v", include_row=False),
        dip=Peak("v"),
        odd_dip=Peak("v", "seq % 2 = 1", include_row=False),
    )


@pytest.mark.parametrize("block_rows", [1, 7, 50, 10_000])
def test_blocks_give_what_one_window_gives(rows, block_rows):
    plain = sorted(_step(rows).collect())
    cut = per_key(rows, "k", "seq", [1, 3], _step, block_rows)
    assert sorted(cut.select(*_step(rows).columns).collect(), key=tuple_key) == sorted(
        plain, key=tuple_key
    )


def tuple_key(row):
    return (row["k"], row["seq"])


def test_peak_is_the_largest_negated_sum(rows):
    sums, dips = {}, {}
    for row in _step(rows).orderBy("seq").collect():
        assert row.odd_dip == dips.get((row.k, "odd"))
        if row.v is not None:
            sums[row.k] = sums.get(row.k, 0) + row.v
        if row.k in sums:
            for name, counts in ((row.k, True), ((row.k, "odd"), row.seq % 2)):
                if counts:
                    dips[name] = max(dips.get(name, -sums[row.k]), -sums[row.k])
        assert row.dip == dips.get(row.k)


def test_keys_may_be_a_table(spark, rows):
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    cut = per_key(rows, "k", "seq", keys, _step, 50)
    expected = sorted(_step(rows).collect(), key=tuple_key)
    assert sorted(cut.select(*_step(rows).columns).collect(), key=tuple_key) == expected


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    heavy, others = prefix.split_by_keys(df, "k", [1])
    assert (heavy.count(), others.count()) == (1, 2)


def test_hot_keys_are_all_of_them(rows):
    sizes = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert [r.k for r in hot_keys(rows, "k", min_rows=sizes[1]).collect()] == [1]
    assert {r.k for r in hot_keys(rows, "k", min_rows=1).collect()} == {1, 2, 3}
    assert hot_keys(rows, "k", min_rows=401) == []


def test_no_task_sees_more_than_a_block(spark):
    """The sizes of the groups that windows really get."""
    data = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("seq"))

    def step(df):
        by = [c for c in ("k", prefix.BLOCK) if c in df.columns]
        return df.withColumn("size", F.count("*").over(Window.partitionBy(*by)))

    blocks = per_key(data, "k", "seq", [1], step, 100)
    assert {r.size for r in blocks.collect()} == {100} and blocks.count() == 1000


def test_ordinary_keys_need_one_exchange(rows):
    plan = _step(_step(rows).select(*rows.columns))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
