"""The demonstration plan: 18 events over two minutes (fixed values)."""

from datetime import timedelta

from conftest import T0, event

from trolley import schemas as S

PRICE = {101: 999.99, 102: 29.99, 103: 79.99}

# second, event id, user, type, product, quantity, offset, outcome, total after
PLAN = [
    (0, "scn-1001-add-laptop", 1001, S.ADD, 101, 1, -10, "saved", 999.99),
    (4, "scn-1001-add-mouse", 1001, S.ADD, 102, 1, -10, "saved", 1029.98),
    (8, "scn-dedup-001", 1001, S.ADD, 103, 1, -10, "saved", 1109.97),
    (9, "scn-dedup-001", 1001, S.ADD, 103, 1, -10, "duplicate", None),
    (12, "scn-1002-add-mouse", 1002, S.ADD, 102, 1, -10, "saved", 29.99),
    (16, "scn-1002-update-qty", 1002, S.UPDATE, 102, 3, -10, "saved", 89.97),
    (20, "scn-1001-add-case", 1001, S.ADD, 103, 1, -10, "saved", 1189.96),
    (24, "scn-1001-late-ok", 1001, S.ADD, 102, 1, -180, "saved_late", 1219.95),
    (28, "scn-1001-late-reject", 1001, S.ADD, 101, 1, -600, "late_rejected", None),
    (45, "scn-1003-add", 1003, S.ADD, 101, 1, -10, "saved", 999.99),
    (45, "scn-1004-add", 1004, S.ADD, 102, 1, -10, "saved", 29.99),
    (46, "scn-1005-add", 1005, S.ADD, 103, 1, -10, "saved", 79.99),
    (55, "scn-1003-add-2", 1003, S.ADD, 102, 1, -10, "saved", 1029.98),
    (70, "scn-1002-remove", 1002, S.REMOVE, 102, 3, -10, "saved", 0.0),
    (72, "scn-1002-checkout", 1002, S.CHECKOUT, 0, 0, -10, "saved", 0.0),
    (90, "scn-1006-a", 1006, S.ADD, 101, 1, -10, "saved", 999.99),
    (90, "scn-1006-b", 1006, S.ADD, 102, 1, -10, "saved", 1029.98),
    (91, "scn-1006-c", 1006, S.ADD, 103, 1, -10, "saved", 1109.97),
]


def scenario_events():
    """The events as they arrive, sent from ten seconds past noon."""
    events = []
    for seq, (second, event_id, user, kind, product, quantity, offset, _, _) in enumerate(PLAN):
        sent = T0 + timedelta(seconds=10 + second)
        events.append(
            event(
                seq,
                event_id=event_id,
                user_id=user,
                event_type=kind,
                product_id=product,
                product_name="",
                quantity=quantity,
                price=PRICE.get(product, 0.0),
                arrived_at=sent,
                timestamp=sent + timedelta(seconds=offset),
                session_id=f"sess_scenario_{user}",
            )
        )
    return events
