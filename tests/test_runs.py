"""What a run of events does to a line and to a cart, as a function of what was there before."""

import random

import model
import pytest
from conftest import by_seq, event

from trolley import schemas as S
from trolley.operators.cart import with_cart
from trolley.operators.fold import apply_to_cart
from trolley.operators.runs import EMPTIED, UNCHANGED, begun_with, then


def test_a_run_is_its_events_one_after_another():
    rng = random.Random(5)
    for _ in range(3000):
        run = [(rng.choice([S.ADD, S.REMOVE, S.REMOVE, S.UPDATE, "wave"]), rng.randint(0, 6)) for _ in range(rng.randint(0, 8))]
        line = UNCHANGED
        for kind, units in run:
            line = then(line, kind, units)
        for begin in range(0, 25):
            quantity = begin
            for kind, units in run:
                quantity = apply_to_cart(kind, quantity, units, 1.0, 0.0)[0]
            assert begun_with(line, begin) == quantity, (run, begin)


def test_after_a_checkout_nothing_before_matters():
    assert {begun_with(then(EMPTIED, S.ADD, 3), x) for x in range(9)} == {3}
    assert {begun_with(then(EMPTIED, S.UPDATE, 3), x) for x in range(9)} == {0}


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_blocks_give_what_windows_give(frame, monkeypatch, block_rows):
    """Checkouts in blocks that have nothing of a product, prices that drift, events that are left out."""
    rng = random.Random(block_rows)
    events = model.random_events(rng, 150, users=2, products=4, late=False)
    for e in events:
        if rng.random() < 0.1:
            e |= {"event_type": S.CHECKOUT, "quantity": 0, "price": 0.0}
        if rng.random() < 0.05:
            e |= {"price": 1e12}
        if rng.random() < 0.1:
            e |= {"event_type": "wave"}
    monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", block_rows)
    columns = ["cart_epoch", "line_quantity", "cart_total_before", "cart_total_after", "cart_changed"]
    rows, applies = frame(*events), "seq % 7 <> 3"
    expected = by_seq(with_cart(rows, [], applies), *columns)
    assert by_seq(with_cart(rows, [1, 2], applies), *columns) == expected


def test_no_setting_of_the_session_is_touched(spark, frame, monkeypatch):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.adaptive.enabled")
    seen = []
    real = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, *a: seen.append(a) or real(self, *a))
    with_cart(frame(event(0), event(1)), [1001]).collect()
    assert not seen and before[1] == spark.conf.get("spark.sql.adaptive.enabled")
