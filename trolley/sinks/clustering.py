"""Two-way clustering: rows along a Z-order curve of minute and user.

Sorting by minute and then user serves reads of a time range, but a user's rows lie in every file. Along
the curve neighbours are close in both, so either read opens a part of the files only. Both columns are
cut at quantiles first, so that heavy minutes or users take their share of the curve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.times import start_of_minute

#: Bits of the curve a column has; it is cut at ``2 ** BITS - 1`` quantiles.
BITS = 6


def cuts(df: DataFrame, *columns: Column) -> list[list[int]]:
    """Quantiles of integer columns: a fixed number, whatever the table."""
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    found = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(f or [])) for f in found]


def place(value: Column, at: list[int]) -> Column:
    """How many cuts a value has reached, spread over the whole range of ``BITS`` bits."""
    reached = F.size(F.filter(F.array(*[F.lit(c) for c in at]), lambda c: c <= value)) if at else F.lit(0)
    return F.floor(reached * ((1 << BITS) - 1) / F.lit(max(len(at), 1))).cast("int")


def z_key(*places: Column) -> Column:
    """The bits of all places, one of each in turn, the highest first."""
    key = F.lit(0)
    for bit in reversed(range(BITS)):
        for p in places:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(p, bit).bitwiseAND(F.lit(1)))
    return key


def two_ways(fact: DataFrame, files: int | None = None) -> DataFrame:
    """The rows of each day along the curve of minute and user; ``fact`` is read twice.

    Ranges are cut from a sample of the rows, by the event's id in the last place, so a heavy user's
    minute spans several files.
    """
    minute, user = F.unix_seconds(start_of_minute(F.col("timestamp"))), F.col("user_id")
    of_minute, of_user = cuts(fact, minute, user)
    curve = fact.withColumn("_z", z_key(place(minute, of_minute), place(user, of_user)))
    keys = ["processed_date", "_z", "user_id", "timestamp"]
    spread = curve.repartitionByRange(*([files] if files else []), *keys, "event_id")
    return spread.sortWithinPartitions(*keys).drop("_z")
