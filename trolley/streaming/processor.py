"""The per-user stateful operator of the stream.

State lives in the state store under the user: the marks of stored events, the watermark, the
cart's lines and its totals. Spark commits it with the micro-batch, after the sink has returned,
so nothing counts as processed that was not stored. Times are microseconds since the epoch.

A stream may begin where a batch ended: the rows of ``plans.handover`` are its initial state. Marks
leave the state by timers, an hour of arrivals at a time, once the watermark of arrivals says that
they have expired.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from trolley.operators.dedup import ttl_micros
from trolley.operators.fold import DECISION, SAVED, SAVED_LATE, UserFold
from trolley.plans.batch import Settings
from trolley.streaming.marks import (
    BLOOM_KEY_SCHEMA,
    BLOOM_SCHEMA,
    INDEX_SCHEMA,
    KEY_SCHEMA,
    PART_SCHEMA,
    SLICE_US,
    BloomMarks,
    Marks,
)

MARKS, MARK_INDEX, MARK_FILTERS = "marks", "mark_index", "mark_filters"
WATERMARK, ITEMS, TOTALS = "watermark", "items", "totals"


class CartProcessor(StatefulProcessor):
    """``columns`` are the input's: they come out again, followed by the decision."""

    def __init__(self, settings: Settings, columns: list[str]) -> None:
        self.ttl_us = ttl_micros(settings.ttl_hours)
        self.policy = settings.policy
        self.allowed_us = round(settings.allowed_seconds * 1_000_000)
        self.sweeps = settings.sweep_after is not None
        self.bloom_bits = settings.bloom_bits
        self.result = Row(*columns, *DECISION.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.bloom_bits:
            self.mark_filters = handle.getMapState(MARK_FILTERS, BLOOM_KEY_SCHEMA, BLOOM_SCHEMA)
        else:
            self.mark_index = handle.getValueState(MARK_INDEX, INDEX_SCHEMA)
            self.mark_parts = handle.getMapState(MARKS, KEY_SCHEMA, PART_SCHEMA)
        self.watermark = handle.getValueState(
            WATERMARK,
            "max_us long, last_processed_us long, late_event_count long, "
            "adjusted_event_count long",
        )
        self.items = handle.getMapState(ITEMS, "product_id long", "quantity long")
        self.totals = handle.getValueState(
            TOTALS,
            "total_value double, event_count long, last_updated_us long, cart_epoch long",
        )

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """One piece of what a user's earlier batches left: an hour's marks, a line, the watermark
        or the totals."""
        piece = initialState
        if piece.slice is not None:
            marks = self._marks()
            marks.add_part(piece.slice, piece.part, piece.dedup_keys, piece.processed_us)
            self._save(marks)
        elif piece.product_id is not None:
            self.items.updateValue((piece.product_id,), (piece.quantity,))
        elif piece.max_us is not None:
            self.watermark.update(
                (piece.max_us, piece.last_processed_us, piece.late_event_count, piece.adjusted_event_count)
            )
        else:
            self.totals.update(
                (piece.total_value, piece.event_count, piece.last_updated_us, piece.cart_epoch)
            )

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """Events of one user in one micro-batch, which the source's rate limit bounds.

        The shuffle does not keep arrival order, so it is restored here. The watermark, the cart and
        marks are read before and written after the events.
        """
        mark = list(self.watermark.get()) if self.watermark.exists() else None
        fold = UserFold(self.policy, self.allowed_us, mark)
        stored: dict[int, int] | None = None
        marks = self._marks()
        for row in sorted(rows, key=lambda r: r.seq):
            if self._is_duplicate(row, marks):
                yield self.result(*row, *fold.duplicate(row.event_us))
                continue
            if stored is None:
                stored = self._load_cart(fold)
            decision = fold.step(
                row.event_type, row.product_id, row.quantity, row.price, row.event_us, row.arrived_us
            )
            if decision[1] in (SAVED, SAVED_LATE):
                marks.put(row.dedup_key, row.arrived_us)
            yield self.result(*row, *decision)
        self.watermark.update(tuple(fold.mark))
        if self.sweeps:
            # Of a backlog, what has expired by two TTLs is never written.
            marks.sweep(row.arrived_us - 2 * self.ttl_us)
        self._save(marks)
        if stored is not None:
            self._store_cart(fold.cart, fold.lines, stored)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Drop the marks that have expired by now; results do not change."""
        marks = self._marks()
        marks.sweep(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000 - self.ttl_us)
        marks.save()
        self._watch(marks)
        return iter(())

    def _marks(self) -> Marks | BloomMarks:
        if self.bloom_bits:
            return BloomMarks(self.mark_filters, self.bloom_bits)
        return Marks(self.mark_index, self.mark_parts)

    def _save(self, marks: Marks | BloomMarks) -> None:
        first = marks.first
        marks.save()
        if first:
            self._watch(marks)

    def _watch(self, marks: Marks | BloomMarks) -> None:
        """One timer a user, for the hour that expires first."""
        if self.sweeps and marks.oldest is not None:
            # Rounded up: a mark is live until its whole time has passed.
            self.handle.registerTimer(-(-((marks.oldest + 1) * SLICE_US + self.ttl_us) // 1000))

    def _load_cart(self, fold: UserFold) -> dict[int, int]:
        """Give the fold its cart; the lines as they are stored."""
        if self.totals.exists():
            total, *rest = self.totals.get()
            fold.cart = [float(round(total * 100)), *rest]
        fold.lines = {name[0]: value[0] for name, value in self.items.iterator()}
        return dict(fold.lines)

    def _store_cart(self, cart: list, lines: dict[int, int], stored: dict[int, int]) -> None:
        if cart[2] is not None:
            self.totals.update((cart[0] / 100, *cart[1:]))
        for product in stored.keys() - lines.keys():
            self.items.removeKey((product,))
        for product, quantity in lines.items():
            if stored.get(product) != quantity:
                self.items.updateValue((product,), (quantity,))

    def _is_duplicate(self, row: Row, marks: Marks | BloomMarks) -> bool:
        """Whether a live mark exists; an expired one is removed when it is met."""
        marked = marks.get(row.dedup_key)
        if marked is None:
            return False
        if row.arrived_us - marked < self.ttl_us:
            return True
        marks.drop(row.dedup_key, marked)
        return False

    def close(self) -> None:
        pass
