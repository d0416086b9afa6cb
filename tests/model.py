"""What the job must do, event by event, with plain dictionaries."""

from trolley import schemas as S


def run(events, policy="accept", allowed=300, ttl_hours=24, all_fit=False):
    """``{seq: (outcome, before, after)}`` of valid events."""
    marks, watermarks, carts, results = {}, {}, {}, {}
    for e in sorted(events, key=lambda e: e["seq"]):
        user, now, ts = e["user_id"], e["arrived_at"], e["timestamp"]
        key = (user, e["event_id"])
        if key in marks and (now - marks[key]).total_seconds() < ttl_hours * 3600:
            results[e["seq"]] = ("duplicate", None, None)
            continue
        mark = watermarks.get(user)
        late = mark is not None and ts < mark
        if late:
            within = (mark - ts).total_seconds() <= allowed
            if not within or policy == "reject":
                results[e["seq"]] = ("late_rejected", None, None)
                continue
        else:
            watermarks[user] = ts
        if not all_fit and not 0 <= e["quantity"] <= 65_535:
            results[e["seq"]] = ("sink_range", None, None)
            continue
        marks[key] = now
        cart = carts.setdefault(user, {"items": {}, "total": 0.0, "count": 0})
        before = cart["total"]
        _apply(cart, e)
        results[e["seq"]] = ("saved_late" if late else "saved", before, cart["total"])
    return results, carts, watermarks


def _apply(cart, e):
    items, product, q, price = cart["items"], e["product_id"] or 0, e["quantity"], e["price"]
    kind = e["event_type"]
    if kind == S.CHECKOUT:
        items.clear()
        cart["total"] = 0.0
    elif kind == S.ADD:
        items[product] = items.get(product, 0) + q
        cart["total"] += price * q
    elif product not in items:
        return
    elif kind == S.REMOVE:
        taken = min(items[product], q)
        items[product] -= taken
        cart["total"] -= price * taken
    else:
        left = max(q, 0)
        cart["total"] = max(0.0, cart["total"] + (left - items[product]) * price)
        items[product] = left
    if items.get(product) == 0:
        del items[product]
    cart["count"] += 1


def random_events(rng, n, users=3, products=3, ids=None, late=True, spread=40):
    """Events with late rows, re-sends of other times and prices that drift."""
    from conftest import at

    events = []
    for seq in range(n):
        kind = rng.choices(S.EVENT_TYPES, [5, 3, 4, 1])[0]
        arrived = at(seq * spread)
        shift = rng.choice([0, 0, 0, 60, 299, 300, 301, 900]) if late else 0
        events.append(
            {
                "seq": seq,
                "arrived_at": arrived,
                "event_id": f"e{rng.randrange(ids) if ids else seq}",
                "user_id": rng.randrange(1, users + 1),
                "event_type": kind,
                "product_id": None if kind == S.CHECKOUT else rng.randrange(1, products + 1),
                "product_name": None,
                "quantity": rng.randrange(-1, 5) if kind == S.UPDATE else rng.randrange(1, 5),
                "price": float(rng.choice([1, 2, 5, 10])) + 0.25,
                "timestamp": at(seq * spread - shift),
                "session_id": "s",
            }
        )
    return events
