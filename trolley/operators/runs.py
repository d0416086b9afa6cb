"""Heavy users' carts, block by block: what a run of events does to a cart is a small function.

A run of events maps the quantity ``x`` a product line had before it

* to ``max(x + a, b)``, as long as it has adds and removes only, and
* to one of two numbers, ``c`` if ``x > a`` and ``b`` if not, once an update or a checkout is in it (an
  update sets the line only if there is one).

It maps the cart's total to ``max(x + a, b)``: every change adds, an update lifts what is below zero, and a
checkout is ``a = -infinity, b = 0``. Both kinds compose, so a user's events are cut into blocks of
arrivals:

1. per block, the function of each product's run (one pass over the block);
2. per user and product, the quantity each block begins with, from the blocks before it;
3. per block again, every event with its line as it is, and the cart's total as a function of the one
   the block begins with (the second pass);
4. per user, the totals blocks begin with, put into the functions.

A task holds the lines of one block, never a user's events. Steps 2 and 4 see one row a block.
Money is whole cents in doubles, so sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions.columns import with_exprs
from trolley.operators.prefix import BLOCK
from trolley.schemas import ADD, CHECKOUT, REMOVE, UPDATE
from trolley.session import stored

#: A run's function of a line: whether it has two values only, and its numbers.
Line = tuple[bool, int, int, int]
UNCHANGED: Line = (False, 0, 0, 0)
EMPTIED: Line = (True, 0, 0, 0)
NEVER = float("-inf")


def then(line: Line, kind: str, units: int) -> Line:
    """The function of a run with one more event of the line's product."""
    two, a, b, c = line
    if kind == ADD:
        return (two, a, b + units, c + units) if two else (False, a + units, b + units, 0)
    if kind == REMOVE:
        if two:
            return True, a, max(b - units, 0), max(c - units, 0)
        return False, a - units, max(b - units, 0), 0
    if kind == UPDATE:
        left = max(units, 0)
        if two:
            return True, a, left if b else 0, left if c else 0
        # With b at zero there is a line if x + a > 0.
        return True, -a, left if b else 0, left
    return line


def begun_with(line: Line, x: int) -> int:
    """The quantity after the run."""
    two, a, b, c = line
    if two:
        return c if x > a else b
    return max(x + a, b)


_EVENT = ["_kind", "_product", "_units", "_cents"]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: a row per line of a block, and one without a product with the block's checkouts."""
    now, lines, checkouts, rest = None, {}, 0, UNCHANGED
    names = ["user_id", BLOCK, "product", "two", "a", "b", "c", "checkouts"]

    def done() -> pa.RecordBatch:
        rows = [(*now, None, False, 0, 0, 0, checkouts), *((*now, p, *line, checkouts) for p, line in lines.items())]
        kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int64()] * 4
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("user_id", BLOCK, *_EVENT[:3])]
        for user, block, kind, product, units in zip(*columns, strict=True):
            if now != (user, block):
                if now is not None:
                    yield done()
                now, lines, checkouts, rest = (user, block), {}, 0, UNCHANGED
            if kind == CHECKOUT:
                checkouts += 1
                # Also of products that come only after it.
                lines, rest = dict.fromkeys(lines, EMPTIED), EMPTIED
            elif kind:
                lines[product] = then(lines.get(product, rest), kind, units or 0)
    if now is not None:
        yield done()


def _begun_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the quantity each block's line begins with; rows of a line are consecutive, by block."""
    now, quantity, seen = None, 0, 0
    names = ["user_id", BLOCK, "product", "two", "a", "b", "c", "checkouts", "before"]
    for batch in batches:
        made = []
        for user, block, product, two, a, b, c, checkouts, before in zip(
            *(batch.column(n).to_pylist() for n in names), strict=True
        ):
            if now != (user, product):
                now, quantity, seen = (user, product), 0, before
            if before > seen:
                # Checked out in a block that has nothing of this product.
                quantity = 0
            made.append((user, block, product, quantity))
            quantity, seen = begun_with((two, a, b, c), quantity), before + checkouts
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * 4,
            ["user_id", BLOCK, "product", "begin"],
        )


#: What step 3 adds: totals are functions of the one the block begins with.
_ADDED = T.StructType(
    [
        T.StructField("cart_epoch", T.LongType()),
        T.StructField("line_quantity", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("_a_before", "_b_before", "_a", "_b")],
        T.StructField("cart_changed", T.BooleanType()),
    ]
)
_ARROW = pa.schema(
    [
        ("cart_epoch", pa.int64()),
        ("line_quantity", pa.int64()),
        *[(c, pa.float64()) for c in ("_a_before", "_b_before", "_a", "_b")],
        ("cart_changed", pa.bool_()),
    ]
)


def _replayed(columns: list[str]):
    """Step 3. A block's rows are consecutive: first what it begins with, then its events."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, epoch, a, b = None, {}, 0, 0.0, NEVER
        for batch in batches:
            made, events = [], []
            read = ("user_id", BLOCK, "_begin", "_epoch", *_EVENT)
            for user, block, begin, begun, kind, product, units, cents in zip(
                *(batch.column(c).to_pylist() for c in read), strict=True
            ):
                if now != (user, block):
                    now, lines, epoch, a, b = (user, block), {}, 0, 0.0, NEVER
                events.append(kind is not None)
                if kind is None:
                    if begin is None:
                        epoch = begun
                    else:
                        lines[product] = begin
                    continue
                units, cents = units or 0, cents or 0.0
                before, have, line, changed = (epoch, a, b), lines.get(product, 0), None, None
                if kind == CHECKOUT:
                    lines, epoch, a, b, changed = {}, epoch + 1, NEVER, 0.0, True
                elif kind:
                    line, delta, changed = have, 0.0, kind == ADD
                    if kind == ADD:
                        line, delta = have + units, cents * units
                    elif kind == REMOVE and have:
                        line, delta, changed = max(have - units, 0), -cents * min(have, units), True
                    elif kind == UPDATE and have:
                        line, changed = max(units, 0), True
                        delta = (line - have) * cents
                    a, b = a + delta, b + delta
                    if kind == UPDATE and have:
                        b = max(b, 0.0)
                    lines[product] = line
                made.append((before[0], line, *before[1:], a, b, changed))
            rows = batch.filter(pa.array(events, pa.bool_()))
            values = zip(*made, strict=True) if made else [[]] * len(_ARROW)
            added = [pa.array(v, f.type) for v, f in zip(values, _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in columns], *added], [*columns, *_ARROW.names]
            )

    return run


def _begun_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: the total each block begins with; a user's rows are consecutive, by block."""
    now, total = None, 0.0
    for batch in batches:
        made = []
        for user, block, a, b in zip(*(batch.column(c).to_pylist() for c in ("user_id", BLOCK, "_a", "_b")), strict=True):
            if now != user:
                now, total = user, 0.0
            made.append(total)
            total = max(total + a, b)
        yield pa.RecordBatch.from_arrays(
            [batch.column("user_id"), batch.column(BLOCK), pa.array(made, pa.float64())],
            ["_user", "_number", "_total"],
        )


def replay_blocks(rows: DataFrame) -> DataFrame:
    """Add the cart around each event of users cut into blocks (``BLOCK``, which goes).

    ``rows`` have ``_kind`` (empty for events that leave the cart alone), ``_product``, ``_units`` and
    ``_cents``.
    """
    rows = stored(rows, "blocks")
    place = ["user_id", BLOCK]
    dealt = rows.select(*place, "seq", *_EVENT[:3]).repartition(*place).sortWithinPartitions(*place, "seq")
    schema = f"user_id bigint, {BLOCK} bigint, product bigint, two boolean, a bigint, b bigint, c bigint, checkouts bigint"
    lines = stored(dealt.mapInArrow(_lines, schema), "runs")
    blocks = lines.filter("product IS NULL").select(*place, "checkouts")
    earlier = Window.partitionBy("user_id").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*place, F.coalesce(F.sum("checkouts").over(earlier), F.lit(0)).alias("before"))
    runs = lines.filter("product IS NOT NULL").join(blocks, place)
    runs = runs.repartition("user_id", "product").sortWithinPartitions("user_id", "product", BLOCK)
    begun = runs.mapInArrow(_begun_lines, f"user_id bigint, {BLOCK} bigint, product bigint, begin bigint")

    begins = begun.filter("begin > 0").selectExpr(*place, "product AS _product", "begin AS _begin", "NULL AS _epoch")
    begins = begins.unionByName(blocks.selectExpr(*place, "NULL AS _product", "NULL AS _begin", "before AS _epoch"))
    met = rows.withColumns({"_begin": F.lit(None).cast("bigint"), "_epoch": F.lit(None).cast("bigint")})
    met = met.unionByName(begins, allowMissingColumns=True)
    met = met.repartition(*place).sortWithinPartitions(*place, "seq")
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema.fields], *_ADDED.fields])
    replayed = stored(met.mapInArrow(_replayed(rows.columns), schema), "replayed")

    last = replayed.groupBy(*place).agg(F.max_by(F.struct("_a", "_b"), "seq").alias("_last")).select(*place, "_last.*")
    last = last.repartition("user_id").sortWithinPartitions(*place)
    totals = last.mapInArrow(_begun_totals, "_user bigint, _number bigint, _total double")
    found = replayed.join(totals, F.expr(f"user_id = _user AND {BLOCK} = _number"))
    total = "CASE WHEN _kind <> '' THEN greatest(_total + {0}, {1}) / 100 END"
    return with_exprs(
        found,
        cart_total_before=total.format("_a_before", "_b_before"),
        cart_total_after=total.format("_a", "_b"),
    ).drop("_user", "_number", "_total", "_a_before", "_b_before", "_a", "_b", BLOCK)
