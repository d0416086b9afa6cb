import pytest
from conftest import by_seq, event

from trolley import schemas as S
from trolley.operators.validate import PRODUCER_RULES, valid_events, with_errors

BAD = [
    ({"event_id": ""}, "validation_error: event_id cannot be empty"),
    ({"event_id": None, "user_id": None}, "validation_error: event_id cannot be empty"),
    ({"user_id": 0}, "validation_error: Invalid user_id: 0"),
    ({"user_id": -4}, "validation_error: Invalid user_id: -4"),
    (
        {"event_type": "signup"},
        "validation_error: Invalid event_type: signup. Must be one of: "
        "add_to_cart, checkout, remove_item, update_quantity",
    ),
    ({"product_id": None}, "validation_error: product_id required for add_to_cart"),
    (
        {"product_id": 0, "event_type": S.UPDATE},
        "validation_error: product_id required for update_quantity",
    ),
    ({"quantity": 0}, "validation_error: Invalid quantity: 0"),
    ({"quantity": -2, "event_type": S.REMOVE}, "validation_error: Invalid quantity: -2"),
    ({"price": -1.5}, "validation_error: Negative price: -1.5"),
    ({"user_id": 0, "price": -1.0}, "validation_error: Invalid user_id: 0"),
    ({"user_id": None}, "unexpected_error: user_id is missing"),
    ({"quantity": None}, "unexpected_error: quantity is missing"),
    ({"price": None}, "unexpected_error: price is missing"),
    ({"event_type": None, "price": None}, None),
]
GOOD = [
    {"product_id": -7},
    {"event_type": S.CHECKOUT, "product_id": None, "quantity": 0, "price": 0.0},
    {"event_type": S.UPDATE, "quantity": 0},
    {"event_type": S.UPDATE, "quantity": -3},
]


def test_first_broken_rule_is_named(frame):
    df = frame(*[event(i, **changes) for i, (changes, _) in enumerate(BAD)])
    errors = by_seq(with_errors(df), "error")
    for i, (_, expected) in enumerate(BAD):
        if expected is None:
            assert errors[i].startswith("validation_error: Invalid event_type: None")
        else:
            assert errors[i] == expected


def test_good_events_pass(frame):
    df = frame(*[event(i, **changes) for i, changes in enumerate(GOOD)])
    assert valid_events(df).count() == len(GOOD)
    assert "error" not in valid_events(df).columns


@pytest.mark.parametrize("changes", [{"event_id": ""}, {"user_id": 0}])
def test_producer_does_not_check_ids(frame, changes):
    assert by_seq(with_errors(frame(event(0, **changes)), PRODUCER_RULES), "error") == {0: None}
