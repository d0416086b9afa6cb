import random

import model
import pytest
from conftest import by_seq, event

from trolley import schemas as S
from trolley.operators.cart import cart_of_user, cart_snapshot, open_carts, with_cart


def replay(frame, *steps):
    """Steps are (type, product, quantity, price)."""
    events = [
        event(i, event_type=kind, product_id=p, quantity=q, price=price)
        for i, (kind, p, q, price) in enumerate(steps)
    ]
    return with_cart(frame(*events), [])


def totals(df):
    return [v for _, v in sorted(by_seq(df, "cart_total_after").items())]


def state(df):
    row = cart_snapshot(df).first()
    return row["items"], row.total_value, row.event_count


def test_adds(frame):
    df = replay(frame, (S.ADD, 1, 2, 10.0), (S.ADD, 1, 3, 10.0), (S.ADD, 2, 1, 5.0))
    assert totals(df) == [20.0, 50.0, 55.0]
    assert state(df) == ({1: 5, 2: 1}, 55.0, 3)


def test_remove_some_all_and_more_than_there_is(frame):
    df = replay(frame, (S.ADD, 1, 3, 10.0), (S.REMOVE, 1, 1, 10.0), (S.REMOVE, 1, 99, 10.0))
    assert totals(df) == [30.0, 20.0, 0.0]
    assert state(df) == ({}, 0.0, 3)


def test_remove_and_update_of_absent_product_change_nothing(frame):
    df = replay(frame, (S.ADD, 1, 1, 10.0), (S.REMOVE, 2, 1, 10.0), (S.UPDATE, 2, 4, 10.0))
    assert totals(df) == [10.0, 10.0, 10.0]
    assert state(df) == ({1: 1}, 10.0, 1)


def test_update_sets_and_drops(frame):
    df = replay(frame, (S.ADD, 1, 2, 10.0), (S.UPDATE, 1, 5, 10.0), (S.UPDATE, 1, 0, 10.0))
    assert totals(df) == [20.0, 50.0, 0.0]
    assert state(df) == ({}, 0.0, 3)


def test_product_dropped_and_added_again(frame):
    df = replay(
        frame,
        (S.ADD, 1, 2, 10.0),
        (S.UPDATE, 1, -1, 10.0),
        (S.UPDATE, 1, 7, 10.0),
        (S.ADD, 1, 1, 10.0),
        (S.UPDATE, 1, 7, 10.0),
    )
    assert totals(df) == [20.0, 0.0, 0.0, 10.0, 70.0]


def test_checkout_empties(frame):
    df = replay(frame, (S.ADD, 1, 2, 10.0), (S.CHECKOUT, None, 0, 0.0), (S.REMOVE, 1, 1, 10.0))
    assert totals(df) == [20.0, 0.0, 0.0]
    assert by_seq(df, "cart_total_before") == {0: 0.0, 1: 20.0, 2: 0.0}
    assert state(df) == ({}, 0.0, 2)


def test_total_may_fall_below_zero_by_remove_but_not_by_update(frame):
    df = replay(
        frame,
        (S.ADD, 1, 2, 5.0),
        (S.REMOVE, 1, 1, 20.0),
        (S.ADD, 2, 1, 1.0),
        (S.UPDATE, 1, 1, 3.0),
        (S.ADD, 2, 1, 1.0),
    )
    assert totals(df) == [10.0, -10.0, -9.0, 0.0, 1.0]


def test_events_that_do_not_apply_are_passed_by(frame):
    df = frame(event(0), event(1, event_type=S.CHECKOUT), event(2))
    out = with_cart(df, [], applies="seq <> 1")
    assert by_seq(out, "cart_total_after") == {0: 9.99, 1: None, 2: 19.98}


def test_unknown_type_leaves_the_cart(frame):
    df = replay(frame, (S.ADD, 1, 1, 2.0), ("wave", 1, 5, 2.0))
    assert totals(df) == [2.0, 2.0] and state(df) == ({1: 1}, 2.0, 1)


def test_open_carts(frame):
    df = with_cart(frame(event(0), event(1, user_id=2), event(2, user_id=2, event_type=S.REMOVE)), [])
    snapshot = cart_snapshot(df)
    assert [r.user_id for r in open_carts(snapshot).collect()] == [1001]
    assert cart_of_user(snapshot, 2).first().event_count == 2
    assert cart_of_user(snapshot, 3).first() is None


@pytest.mark.parametrize(("seed", "block_rows"), [(1, None), (2, None), (3, 1), (4, 5), (5, 17)])
def test_against_the_model(frame, monkeypatch, seed, block_rows):
    events = model.random_events(random.Random(seed), 250, late=False)
    hot = []
    if block_rows:
        monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", block_rows)
        hot = [1, 2]
    expected, carts, _ = model.run(events, all_fit=True)
    out = with_cart(frame(*events), hot).cache()
    got = by_seq(out, "cart_total_before", "cart_total_after")
    for seq, (_, before, after) in expected.items():
        assert got[seq] == pytest.approx((before, after), abs=1e-9)
    final = {r.user_id: r for r in cart_snapshot(out).collect()}
    for user, cart in carts.items():
        assert final[user]["items"] == cart["items"]
        assert final[user].event_count == cart["count"]
        assert final[user].total_value == pytest.approx(cart["total"], abs=1e-9)


def test_quantities_beyond_an_int_and_carts_that_were_emptied(frame):
    events, seq = [event(0, quantity=2_000_000_000), event(1, quantity=2_000_000_000)], 2
    for cart in range(20):
        for product in range(10):
            events.append(event(seq, user_id=2, product_id=100 * cart + product + 1))
            seq += 1
        events.append(event(seq, user_id=2, event_type=S.CHECKOUT, quantity=0, price=0.0))
        seq += 1
    snapshot = {r.user_id: r for r in cart_snapshot(with_cart(frame(*events), [])).collect()}
    assert snapshot[1001]["items"] == {101: 4_000_000_000}
    assert snapshot[2]["items"] == {} and snapshot[2].event_count == 220
