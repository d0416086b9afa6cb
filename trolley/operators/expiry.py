"""Duplicates with expiry of users too heavy for one task.

The marks of an id form a chain: the first copy, the first copy that comes at least the TTL after it, and
so on. Which copy would follow which is known for all of them at once; the chain is then followed by
pointer doubling: with every round twice as many marks are known and every pointer leaps twice as
far, so ``n`` marks take ``log2 n`` rounds of joins. Copies of one instant are one, and looking for
the next copy is dealt by slices of time, so nothing gathers the copies of an id.

This holds where a copy is stored whenever it is no duplicate. ``in_order`` finds the users whose events
come in order, none of which can be late whatever the others turn out to be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.columns import with_exprs
from trolley.operators.dedup import DEDUP_KEY
from trolley.operators.prefix import Keys, per_key, running, running_max
from trolley.session import stored

#: Slices of a TTL the search for the next copy is dealt by.
SLICES = 64
_ID = ["user_id", DEDUP_KEY]


def in_order(rows: DataFrame, hot: Keys) -> DataFrame:
    """``user_id`` of users whose event times and arrivals never go back."""

    def step(part: DataFrame) -> DataFrame:
        return running(
            part,
            ["user_id"],
            ["seq"],
            _ts=running_max("timestamp", include_row=False),
            _at=running_max("arrived_at", include_row=False),
        )

    seen = per_key(rows.select("user_id", "seq", "timestamp", "arrived_at"), "user_id", "seq", hot, step)
    back = F.coalesce(F.bool_or((F.col("timestamp") < F.col("_ts")) | (F.col("arrived_at") < F.col("_at"))), F.lit(False))
    return seen.groupBy("user_id").agg(back.alias("_back")).filter("NOT _back").select("user_id")


def next_copies(copies: DataFrame, ttl_us: int) -> DataFrame:
    """``user_id, dedup_key, at, next``: for every instant an id has copies at, the first one at
    least the TTL later."""
    width = max(1, ttl_us // SLICES)
    nodes = copies.select(*_ID, "at", F.expr(f"at DIV {width}").alias("_slice"))
    asks = copies.select(*_ID, F.col("at").alias("_from"), F.expr(f"at + {ttl_us}").alias("at"))
    asks = asks.withColumn("_slice", F.expr(f"at DIV {width}"))
    met = nodes.withColumns({"_node": F.col("at"), "_kind": F.lit(1)}).unionByName(
        asks.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    # From the last to the first. A copy at the very end of the TTL is outside it: copies come before the
    # questions of their instant.
    backward = Window.partitionBy(*_ID, "_slice").orderBy(F.desc("at"), F.desc("_kind"))
    backward = backward.rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_next", F.min("_node").over(backward)).filter("_kind = 0")
    # Nothing in the slice: the first copy of the next slice that has any.
    slices = nodes.groupBy(*_ID, "_slice").agg(F.min("at").alias("_first")).unionByName(
        met.filter("_next IS NULL").select(*_ID, "_slice").distinct(), allowMissingColumns=True
    )
    slices = slices.groupBy(*_ID, "_slice").agg(F.min("_first").alias("_first"))
    after = Window.partitionBy(*_ID).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_later", F.min("_first").over(after)).select(*_ID, "_slice", "_later")
    found = met.join(slices, [*_ID, "_slice"], "left")
    return found.select(*_ID, F.col("_from").alias("at"), F.coalesce("_next", "_later").alias("next")).filter("next IS NOT NULL")


def mark_chains(copies: DataFrame, ttl_us: int) -> DataFrame:
    """``user_id, dedup_key, at``: the instants at which ids are marked (``copies`` have an instant
    once)."""
    pointers = stored(next_copies(copies, ttl_us), "pointers")
    reached = stored(copies.groupBy(*_ID).agg(F.min("at").alias("at")), "marks")
    while True:
        new = stored(reached.join(pointers, [*_ID, "at"]).select(*_ID, F.col("next").alias("at")), "marks")
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        onward = pointers.select(*_ID, F.col("at").alias("next"), F.col("next").alias("_far"))
        pointers = stored(pointers.join(onward, [*_ID, "next"]).select(*_ID, "at", F.col("_far").alias("next")), "pointers")


def flag_expiring(rows: DataFrame, ttl_us: int) -> DataFrame:
    """Add ``is_duplicate``: a live mark was there when the event arrived.

    ``rows`` are events of users ``in_order``; those with a ``misfit`` are never stored, so never marked.
    """
    if ttl_us <= 0:
        return rows.withColumn("is_duplicate", F.lit(False))
    rows = rows.withColumn("_at", F.unix_micros("arrived_at"))
    copies = rows.filter("misfit IS NULL").groupBy(*_ID, F.col("_at").alias("at")).agg(F.min("seq").alias("_seq"))
    copies = stored(copies, "copies")
    marks = mark_chains(copies.select(*_ID, "at"), ttl_us).join(copies, [*_ID, "at"])
    # Marks are a TTL apart, so there is one at most in a TTL's slice; a live one is in the event's slice
    # or the one before.
    marks = stored(marks.withColumn("_slice", F.expr(f"at DIV {ttl_us}")), "marks")
    rows = rows.withColumn("_slice", F.expr(f"_at DIV {ttl_us}"))
    for n, back in enumerate((0, 1)):
        mine = marks.select(*_ID, (F.col("_slice") + back).alias("_slice"), F.col("at").alias(f"_mark{n}"), F.col("_seq").alias(f"_seq{n}"))
        rows = rows.join(mine, [*_ID, "_slice"], "left")
    live = " OR ".join(f"coalesce(_seq{n} < seq AND _at - _mark{n} < {ttl_us}, false)" for n in (0, 1))
    return with_exprs(rows, is_duplicate=live).drop("_at", "_slice", "_mark0", "_mark1", "_seq0", "_seq1")
