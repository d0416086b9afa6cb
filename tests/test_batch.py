import random

import model
import pytest
from conftest import at, by_seq, event
from scenario import PLAN, scenario_events

from trolley import schemas as S
from trolley.operators.metrics import events_processed
from trolley.operators.rollups import MINUTE, active_carts
from trolley.plans.batch import Settings, fact_from_events, outcomes


def test_scenario(frame):
    out = outcomes(frame(*scenario_events()), hot=[])
    got = by_seq(out, "outcome", "cart_total_after")
    for seq, plan in enumerate(PLAN):
        outcome, total = got[seq]
        assert outcome == plan[-2]
        assert total == (None if plan[-1] is None else pytest.approx(plan[-1]))
    lateness = by_seq(out, "lateness_seconds")
    assert (lateness[7], lateness[8]) == (166.0, 582.0)


def test_scenario_rollups(frame):
    fact = fact_from_events(frame(*scenario_events()), hot=[]).cache()
    assert fact.count() == 16
    rows = {f"{r.minute:%H:%M}": r for r in MINUTE.of(fact).collect()}
    late, first, second = rows["11:57"], rows["12:00"], rows["12:01"]
    assert (late.total_events, late.late_events_count, late.unique_users) == (1, 1, 1)
    assert late.avg_cart_value == pytest.approx(1219.95)
    assert (first.add_to_cart_count, first.update_quantity_count) == (9, 1)
    assert (first.total_events, first.unique_users) == (10, 5)
    assert first.avg_cart_value == pytest.approx(658.981)
    assert float(first.max_cart_value) == 1189.96
    assert (second.add_to_cart_count, second.remove_item_count, second.checkout_count) == (3, 1, 1)
    assert (second.unique_users, second.unique_checkout_users) == (2, 1)
    assert second.avg_cart_value == pytest.approx(627.988)
    assert second.revenue_total == 0
    carts = active_carts(fact, "2026-01-01 12:02:00").collect()
    assert {r.user_id: r.net_adds for r in carts} == {1001: 5, 1003: 2, 1004: 1, 1005: 1, 1006: 3}
    assert [r.user_id for r in carts] == [1006, 1003, 1005, 1004, 1001]


def test_invalid_events_carry_the_reason_and_no_judgement(frame):
    out = outcomes(frame(event(0, user_id=None), event(1, price=-1.0), event(2)), hot=[])
    assert by_seq(out, "outcome") == {0: "invalid", 1: "invalid", 2: "saved"}
    assert by_seq(out, "error")[0] == "unexpected_error: user_id is missing"
    assert by_seq(out, "is_late")[1] is None


def test_checkout_value_is_what_was_in_the_cart(frame):
    fact = fact_from_events(
        frame(event(0, quantity=2), event(1, event_type=S.CHECKOUT, quantity=0, price=0.0)), hot=[]
    )
    row = MINUTE.of(fact).first()
    assert (float(row.revenue_total), float(row.checkout_value)) == (0.0, 19.98)


def test_events_outside_the_sinks_range_stay_out_of_the_fact_table(frame):
    df = frame(
        event(0, quantity=1),
        event(1, event_type=S.UPDATE, quantity=-1),
        event(2, quantity=70_000),
        event(3, price=1e9),
        event(4, event_id="ok"),
    )
    fact = {r.event_id: r for r in fact_from_events(df, hot=[]).collect()}
    assert set(fact) == {"e0", "ok"}
    assert float(fact["ok"].cart_total_before) == 9.99
    assert float(fact["ok"].cart_total_after) == 19.98


MISFITS = [
    event(0, quantity=1),
    event(1, event_type=S.UPDATE, quantity=-1),
    event(2, quantity=70_000),
    event(3, price=1e9),
    event(4, event_id="e3", price=1.0),
    event(5, price=float("nan"), event_id="n"),
    event(6, event_id="n"),
    event(7, user_id=7, price=99_999_999.0),
    event(8, user_id=7, price=1.0, event_id="big"),
    event(9, user_id=7, price=0.5, event_id="fits"),
    event(10, user_id=7, price=0.25, event_id="big"),
    event(11, product_id=5_000_000_000),
]
MISFIT_OUTCOMES = {
    0: ("saved", 9.99), 1: ("sink_range", None), 2: ("sink_range", None), 3: ("sink_range", None),
    4: ("saved", 10.99), 5: ("sink_range", None), 6: ("saved", 20.98), 7: ("saved", 99_999_999.0),
    8: ("sink_range", None), 9: ("saved", 99_999_999.5), 10: ("saved", 99_999_999.75),
    11: ("sink_range", None),
}


@pytest.mark.parametrize("hot", [[], [7]])
def test_what_does_not_fit_changes_nothing(frame, hot):
    """It leaves no mark, so a corrected re-send is new, and the cart stays as it was."""
    out = outcomes(frame(*MISFITS), hot=hot)
    assert by_seq(out, "outcome", "cart_total_after") == MISFIT_OUTCOMES
    assert by_seq(out, "error")[8] == "sink_range: cart_total_after"
    counts = {(r.event_type, r.status): r.value for r in events_processed(out).collect()}
    assert counts[(S.ADD, "success")] == 6 and counts[(S.ADD, "flush_error")] == 5


def test_a_broken_promise_is_noticed(frame):
    df = frame(*[e for e in MISFITS if e["user_id"] == 7])
    with pytest.raises(Exception, match="outgrows the fact table"):
        outcomes(df, Settings(clean_resends=True), hot=[]).collect()


@pytest.mark.parametrize("policy", ["accept", "reject", "adjust_window"])
@pytest.mark.parametrize(("seed", "block_rows"), [(11, None), (12, 6)])
def test_against_the_model(frame, monkeypatch, policy, seed, block_rows):
    """Re-sends with other times, rejected first copies and marks that expire, all mixed."""
    events = model.random_events(random.Random(seed), 160, ids=45)
    settings = Settings(policy=policy, ttl_hours=0.4)
    hot = []
    if block_rows:
        monkeypatch.setattr("trolley.operators.prefix.BLOCK_ROWS", block_rows)
        hot = [1]
    expected, _, _ = model.run(events, policy, ttl_hours=0.4)
    got = by_seq(outcomes(frame(*events), settings, hot), "outcome", "cart_total_before",
                 "cart_total_after")
    assert {s: r[0] for s, r in got.items()} == {s: r[0] for s, r in expected.items()}
    for seq, (_, before, after) in expected.items():
        if before is not None:
            assert got[seq][1:] == pytest.approx((before, after), abs=1e-9)


def test_clean_resends_need_no_extra_pass(frame):
    df = frame(event(0, event_id="a"), event(1), event(2, event_id="a", timestamp=at(0)))
    lazy = outcomes(df, Settings(clean_resends=True), hot=[])
    assert by_seq(lazy, "outcome") == by_seq(outcomes(df, hot=[]), "outcome")
    assert by_seq(lazy, "outcome")[2] == "duplicate"


def test_row_order_and_partitioning_do_not_matter(frame):
    events = model.random_events(random.Random(5), 120, ids=60)
    shuffled = events[:]
    random.Random(6).shuffle(shuffled)
    one = by_seq(outcomes(frame(*events).coalesce(1), hot=[]), "outcome", "cart_total_after")
    other = by_seq(outcomes(frame(*shuffled).repartition(7), hot=[]), "outcome", "cart_total_after")
    assert one == other


def test_ordinary_users_take_one_exchange(frame):
    out = fact_from_events(frame(event(0)), Settings(clean_resends=True), hot=[])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
