"""One user's events one after another: the rules of the job on plain numbers.

The stream's stateful operator and the batch job's ordered pass both step through this. Times are
microseconds since the epoch, money is whole cents held in doubles: sums of them are exact, so the
order in which they are added never matters.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trolley import schemas as S
from trolley.operators.lateness import TOLERATED

DUPLICATE = "duplicate"
LATE_REJECTED = "late_rejected"
SINK_RANGE = "sink_range"
SAVED = "saved"
SAVED_LATE = "saved_late"

MAX_QUANTITY = 65_535
MAX_UINT32 = 4_294_967_295
MAX_CENTS = 9_999_999_999

# What a step adds to an event.
DECISION = T.StructType(
    [
        T.StructField("adjusted_us", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("is_late", T.BooleanType()),
        T.StructField("lateness_seconds", T.DoubleType()),
        T.StructField("watermark_before_us", T.LongType()),
        T.StructField("watermark_after_us", T.LongType()),
        T.StructField("cart_epoch", T.LongType()),
        T.StructField("line_quantity", T.LongType()),
        T.StructField("cart_total_before", T.DoubleType()),
        T.StructField("cart_total_after", T.DoubleType()),
        T.StructField("cart_changed", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)
LATE_ERROR = "late_event_beyond_tolerance"


def cents_of(price: float) -> float | None:
    """The price as it is stored, in cents; nothing where it cannot be stored."""
    if not abs(price) <= MAX_CENTS:
        return None
    cents = Decimal(repr(price)).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100
    return float(cents) if abs(cents) <= MAX_CENTS else None


def apply_to_cart(
    kind: str, have: int, units: int, price: float, total: float
) -> tuple[int, float, bool]:
    """One event on one product line: the line's quantity, the cart's total, and whether either
    changed. Only an update keeps the total from falling below zero."""
    if kind == S.ADD:
        return have + units, total + price * units, True
    if kind == S.REMOVE and have:
        taken = min(have, units)
        return have - taken, total - price * taken, True
    if kind == S.UPDATE and have:
        left = max(units, 0)
        return left, max(0.0, total + (left - have) * price), True
    return have, total, False


class UserFold:
    """A user's watermark and cart, and what an event does to them.

    ``mark`` is newest event time, newest on-time arrival, late and adjusted counts; ``cart`` is
    total in cents, changes, last change and cart number; ``lines`` is the quantity per product.
    """

    def __init__(self, policy: str, allowed_us: int, mark: list | None = None) -> None:
        self.tolerated, self.allowed_us = TOLERATED[policy], allowed_us
        self.mark = mark or [0, None, 0, 0]
        self.cart: list = [0.0, 0, None, 0]
        self.lines: dict[int, int] = {}

    def duplicate(self, event_us: int) -> list:
        mark = self.mark[0]
        return [event_us, DUPLICATE, None, False, 0.0, mark, mark, *[None] * 6]

    def step(
        self, kind: str, product: int | None, units: int, price: float, event_us: int, arrived_us: int
    ) -> list:
        """The decision on an event that is no duplicate.

        An event that does not fit the fact table, by itself or by the total it leads to, has moved
        the watermark and changes nothing else; it is not stored, so it is not marked either.
        """
        before = self.mark[0]
        action, lateness, ts = self._judge(event_us, arrived_us)
        late = lateness > 0
        judged = [action, late, lateness / 1e6, before, self.mark[0]]
        if action == "rejected":
            return [ts, LATE_REJECTED, *judged, self.cart[3], *[None] * 4, LATE_ERROR]
        moved, error = self._move(kind, product or 0, units, cents_of(price), arrived_us)
        if error:
            return [ts, SINK_RANGE, *judged, self.cart[3], *[None] * 4, f"{SINK_RANGE}: {error}"]
        return [ts, SAVED_LATE if late else SAVED, *judged, *moved, None]

    def _judge(self, event_us: int, arrived_us: int) -> tuple[str, int, int]:
        """The action, the lateness in microseconds and the event's time; moves the watermark."""
        mark = self.mark
        lateness = max(0, mark[0] - event_us)
        if not lateness:
            mark[0], mark[1] = max(mark[0], event_us), arrived_us
            return "on_time", 0, event_us
        action = self.tolerated if lateness <= self.allowed_us else "rejected"
        if action == "adjusted":
            mark[3] += 1
            return action, lateness, mark[0]
        mark[2] += 1
        return action, lateness, event_us

    def _move(
        self, kind: str, product: int, units: int, cents: float | None, arrived_us: int
    ) -> tuple[list, str | None]:
        """The cart around an event, or the column that does not fit."""
        if not 0 <= units <= MAX_QUANTITY:
            return [], "quantity"
        if not 0 <= product <= MAX_UINT32:
            return [], "product_id"
        if cents is None:
            return [], "price"
        before, epoch = self.cart[0], self.cart[3]
        if kind == S.CHECKOUT:
            line, total, changed = None, 0.0, True
        else:
            line, total, changed = apply_to_cart(
                kind, self.lines.get(product, 0), units, cents, before
            )
            if abs(total) > MAX_CENTS:
                return [], "cart_total_after"
        if kind == S.CHECKOUT:
            self.lines.clear()
            self.cart[3] += 1
        elif line:
            self.lines[product] = line
        else:
            self.lines.pop(product, None)
        self.cart[0] = total
        if changed:
            self.cart[1] += 1
        if changed or self.cart[2] is None:
            self.cart[2] = arrived_us
        return [epoch, line, before / 100, total / 100, changed], None


_READ = ["user_id", "dedup_key", "event_type", "product_id", "quantity", "price", "event_us", "arrived_us"]


def one_by_one(
    rows: DataFrame, policy: str, allowed_seconds: float, ttl_us: int
) -> DataFrame:
    """Add ``DECISION`` to valid events with ``dedup_key``, ``event_us`` and ``arrived_us``.

    One pass: rows are dealt by user and sorted by arrival, and a task holds the state of the one
    user it is at. Marks that have expired are dropped as time goes on, so what is held is bounded
    by what a user stores within the TTL. One user's events are one task's work.
    """
    allowed_us = round(allowed_seconds * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, fold, marks = None, None, {}
        for batch in batches:
            made = []
            for who, key, *event, event_us, arrived_us in zip(
                *(batch.column(c).to_pylist() for c in _READ), strict=True
            ):
                if fold is None or who != user:
                    user, fold, marks = who, UserFold(policy, allowed_us), {}
                marked = marks.get(key)
                if marked is not None and arrived_us - marked < ttl_us:
                    made.append(fold.duplicate(event_us))
                    continue
                decision = fold.step(*event, event_us, arrived_us)
                if decision[1] in (SAVED, SAVED_LATE):
                    marks.pop(key, None)
                    marks[key] = arrived_us
                    # Oldest first: arrivals are in order.
                    while (oldest := next(iter(marks.items())))[1] <= arrived_us - ttl_us:
                        del marks[oldest[0]]
                made.append(decision)
            added = pa.RecordBatch.from_pylist(
                [dict(zip(DECISION.names, m, strict=True)) for m in made], _ARROW
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added.columns], [*batch.schema.names, *DECISION.names]
            )

    dealt = rows.repartition("user_id").sortWithinPartitions("user_id", "seq")
    return dealt.mapInArrow(run, T.StructType([*rows.schema.fields, *DECISION.fields]))


_KINDS = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
_ARROW = pa.schema([(f.name, _KINDS[f.dataType.simpleString()]) for f in DECISION.fields])
