"""Each user's cart, replayed in arrival order without a row loop.

Quantities. Between two updates of a product its quantity is a sum that is held at zero:
x = S + max(x0, -M) with S the running sum of adds and removes, M its running minimum and x0 the
start. An update starts a new stretch at its own quantity, but only if the product is in the cart,
and whether it is depends on the stretch before. Per stretch that is a function of one bit, whose
value at any update is the last constant one before it.

Totals. The total is the running sum D of value changes, except that an update lifts a negative
total to zero: T = D + max(0, -min of D over those updates). Checkout starts a new cart.

Money is summed in whole cents, held in doubles: such sums are exact, so it makes no difference in
which order or in how many blocks they are taken. A price that cannot be stored counts as nothing;
the job keeps such events from the cart.

All of it is running aggregates, so one exchange by user serves every step. Heavy users are cut into
blocks, which ``runs`` composes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.columns import with_exprs
from trolley.operators.prefix import (
    Group,
    Keys,
    Peak,
    in_blocks,
    running,
    running_groups,
    running_last,
    running_sum,
)
from trolley.operators.runs import replay_blocks
from trolley.schemas import ADD, CHECKOUT, REMOVE, UPDATE

_OUT, _IN, _SAME = 0, 1, 2
_WORK = [
    "_kind", "_product", "_units", "_cents", "_stretch", "_sum", "_lift", "_start", "_effect", "_decided",
    "_present", "_have", "_quantity", "_delta", "_change", "_change_before", "_floor",
    "_floor_before",
]


def _quantities(rows: DataFrame) -> DataFrame:
    """Add ``_have`` and ``_quantity``: units of the event's product before and after it."""
    product = ["user_id", "cart_epoch", "_product"]
    stretch, order = [*product, "_stretch"], ["_stretch", "seq"]
    is_update = f"_kind = '{UPDATE}'"

    signed = f"CASE _kind WHEN '{ADD}' THEN _units WHEN '{REMOVE}' THEN -_units ELSE 0L END"
    rows = running(
        rows,
        stretch,
        ["seq"],
        _sum=running_sum(signed),
        _lift=Peak(signed),
        _start=running_last(f"CASE WHEN {is_update} THEN greatest(_units, 0L) END"),
    )
    rows = with_exprs(rows, _lift="greatest(_lift, 0L)", _start="coalesce(_start, 0L)")

    # Is the product in the cart after this row: yes or no whatever came before the stretch, or
    # the same as before it?
    effect = (
        f"CASE WHEN _sum + _lift > 0 THEN {_IN} "
        f"WHEN _sum + greatest(_start, _lift) > 0 THEN {_SAME} ELSE {_OUT} END"
    )
    rows = running(
        with_exprs(rows, _effect=effect),
        product,
        order,
        _decided=running_last("_effect", include_row=False),
    )
    rows = running(
        rows,
        product,
        order,
        _present=running_last(
            f"CASE WHEN {is_update} AND coalesce(_decided, {_OUT}) <> {_SAME} "
            f"THEN coalesce(_decided, {_OUT}) = {_IN} END"
        ),
    )
    rows = with_exprs(rows, _quantity="_sum + greatest(if(_present, _start, 0L), _lift)")
    rows = running(rows, product, order, _have=running_last("_quantity", include_row=False))
    return with_exprs(rows, _have="coalesce(_have, 0L)")


def _totals(rows: DataFrame) -> DataFrame:
    """Add ``cart_total_before`` and ``cart_total_after``."""
    by, order = ["user_id", "cart_epoch"], ["seq"]
    rows = with_exprs(
        rows,
        _delta=(
            f"CASE WHEN _kind = '{ADD}' THEN _cents * _units "
            f"WHEN _kind = '{REMOVE}' AND _have > 0 THEN -_cents * least(_have, _units) "
            f"WHEN _kind = '{UPDATE}' AND _have > 0 THEN _cents * (greatest(_units, 0L) - _have) "
            "ELSE 0D END"
        ),
    )
    lifts = f"_kind = '{UPDATE}' AND _have > 0"
    rows = running(
        rows,
        by,
        order,
        _change=running_sum("_delta"),
        _change_before=running_sum("_delta", include_row=False),
        _floor=Peak("_delta", lifts),
        _floor_before=Peak("_delta", lifts, include_row=False),
    )
    total = "(coalesce({0}, 0D) + greatest(coalesce({1}, 0D), 0D)) / 100"
    return with_exprs(
        rows,
        cart_total_before=total.format("_change_before", "_floor_before"),
        cart_total_after=f"if(_kind = '{CHECKOUT}', 0D, {total.format('_change', '_floor')})",
    )


def _numbers(rows: DataFrame, applies: str) -> DataFrame:
    return with_exprs(
        rows,
        _kind=f"if({applies}, coalesce(event_type, ''), '')",
        _product="coalesce(product_id, 0L)",
        _units="CAST(quantity AS BIGINT)",
        _cents="CAST(try_cast(price AS DECIMAL(10,2)) * 100 AS DOUBLE)",
    )


def _replay(rows: DataFrame) -> DataFrame:
    checkouts = f"CAST(_kind = '{CHECKOUT}' AS BIGINT)"
    updates = f"CAST(_kind = '{UPDATE}' AS BIGINT)"
    rows = running_groups(
        rows,
        Group(["user_id"], ["seq"], {"cart_epoch": running_sum(checkouts, include_row=False)}),
        Group(["user_id", "_product"], ["seq"], {"_stretch": running_sum(updates)}),
    )
    rows = with_exprs(rows, cart_epoch="coalesce(cart_epoch, 0L)")
    rows = _totals(_quantities(rows))
    changed = (
        f"_kind IN ('{ADD}', '{CHECKOUT}') "
        f"OR (_kind IN ('{REMOVE}', '{UPDATE}') AND _have > 0)"
    )
    return with_exprs(
        rows,
        line_quantity=f"CASE WHEN _kind NOT IN ('', '{CHECKOUT}') THEN _quantity END",
        cart_total_before="CASE WHEN _kind <> '' THEN cart_total_before END",
        cart_total_after="CASE WHEN _kind <> '' THEN cart_total_after END",
        cart_changed=f"CASE WHEN _kind <> '' THEN {changed} END",
    ).drop(*_WORK)


def with_cart(events: DataFrame, hot: Keys, applies: str = "true") -> DataFrame:
    """Add the cart around each event: totals before and after, line quantity, cart number.

    Events for which ``applies`` is false pass through untouched and leave the cart as it is.
    """
    events = _numbers(events, applies)
    heavy, others = in_blocks(events, "user_id", "seq", hot)
    if heavy is None:
        return _replay(others)
    return _replay(others).unionByName(replay_blocks(heavy).drop(*_WORK))


def cart_snapshot(carts: DataFrame) -> DataFrame:
    """The cart each user has now, from the output of ``with_cart``.

    Lines are reduced per product, and lines of carts that were checked out are dropped before
    anything is gathered: what meets in one row is the user's current cart.
    """
    seen = carts.filter(F.col("cart_total_after").isNotNull())
    done = F.col("event_type") == CHECKOUT
    lines = seen.groupBy("user_id", F.when(~done, F.col("product_id")).alias("product_id")).agg(
        F.max_by(F.struct("cart_epoch", "line_quantity"), "seq").alias("line"),
        F.max(F.struct("seq", "cart_total_after")).alias("latest"),
        F.max(F.col("cart_epoch") + done.cast("bigint")).alias("epoch"),
        F.count_if("cart_changed").alias("changes"),
        F.max(F.when(F.col("cart_changed"), F.col("arrived_at"))).alias("changed_at"),
        F.min("arrived_at").alias("first_at"),
    )
    newest = Window.partitionBy("user_id")
    current = lines.withColumn("epoch", F.max("epoch").over(newest)).withColumn(
        "held", F.expr("line.cart_epoch = epoch AND line.line_quantity > 0")
    )
    users = current.groupBy("user_id").agg(
        F.max("latest").alias("latest"),
        F.sum("changes").alias("event_count"),
        F.max("changed_at").alias("changed_at"),
        F.min("first_at").alias("first_at"),
        F.collect_list(F.when(F.col("held"), F.struct("product_id", "line.line_quantity"))).alias("lines"),
    )
    return users.selectExpr(
        "user_id",
        "map_from_entries(array_sort(lines)) AS items",
        "latest.cart_total_after AS total_value",
        "coalesce(changed_at, first_at) AS last_updated",
        "event_count",
    )


def cart_of_user(snapshot: DataFrame, user_id: int) -> DataFrame:
    """One user's cart; no row for a user never seen."""
    return snapshot.filter(F.col("user_id") == user_id)


def open_carts(snapshot: DataFrame) -> DataFrame:
    """Users whose cart holds something."""
    return snapshot.filter(F.size("items") > 0)
