"""DuckDB SQL for the registered queries, written independently of how Spark computes them:
carts are walked event by event in recursive CTEs, roll-ups use plain distinct counts."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"
RETENTION_AS_OF = "TIMESTAMP '2024-02-14 12:00:00'"
REPLAY_START = "TIMESTAMP '2026-01-01 12:00:10'"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"

# CTEs in order of dependence; a query names the last one it needs.
_STEPS: dict[str, str] = {}

_STEPS["mapped"] = """
mapped AS (
  SELECT event_id AS n, user_id,
    CASE event_type WHEN 'view' THEN 'add_to_cart'
      WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'add_to_cart' ELSE 'update_quantity' END
      WHEN 'error' THEN 'remove_item' WHEN 'purchase' THEN 'checkout' ELSE 'signup' END AS kind,
    CASE WHEN event_type = 'purchase' THEN NULL
      ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 END AS product_id,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE CAST(event_id % 5 AS INT) END AS quantity,
    {shifted} AS event_ts,
    ts AS arrived_at
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS pts FROM events))"""

_PREVIOUS = """CASE event_id % 10 WHEN 3 THEN coalesce(pts - INTERVAL 180 SECOND, ts)
      WHEN 7 THEN coalesce(pts - INTERVAL 600 SECOND, ts) ELSE ts END"""
_FIXED = """CASE event_id % 10 WHEN 3 THEN ts - INTERVAL 12 HOUR
      WHEN 7 THEN ts - INTERVAL 72 HOUR ELSE ts END"""

_STEPS["arrivals"] = """
copies AS (
  SELECT n * 2 AS seq, * FROM mapped
  UNION ALL
  SELECT n * 2 + 1, n, user_id, kind, product_id, quantity, event_ts,
         arrived_at + INTERVAL 1 SECOND
  FROM mapped WHERE n % 20 = 4),
arrivals AS (
  SELECT seq, n, CAST(n AS VARCHAR) AS event_id, user_id, kind AS event_type, product_id,
    'p' || product_id AS product_name, quantity,
    CASE WHEN kind = 'checkout' THEN CAST(0 AS DECIMAL(18,2))
      ELSE CAST(9.99 + 10 * coalesce(product_id, 0) AS DECIMAL(18,2)) END AS price,
    event_ts AS ts, arrived_at,
    's' || user_id || '-' || CAST(CAST(arrived_at AS DATE) AS VARCHAR) AS session_id
  FROM copies)"""

_KINDS = "'add_to_cart', 'checkout', 'remove_item', 'update_quantity'"
_LISTED = "add_to_cart, checkout, remove_item, update_quantity"
_TYPE_RULES = f"""
    WHEN coalesce(event_type, '') NOT IN ({_KINDS})
      THEN 'validation_error: Invalid event_type: ' || coalesce(event_type, 'None')
           || '. Must be one of: {_LISTED}'
    WHEN event_type <> 'checkout' AND coalesce(product_id, 0) = 0
      THEN 'validation_error: product_id required for ' || event_type
    WHEN quantity <= 0 AND event_type NOT IN ('checkout', 'update_quantity')
      THEN 'validation_error: Invalid quantity: ' || quantity
    WHEN price < 0 THEN 'validation_error: Negative price: ' || CAST(price AS DOUBLE)"""
_RULES = f"""
    WHEN coalesce(event_id, '') = '' THEN 'validation_error: event_id cannot be empty'
    WHEN user_id <= 0 THEN 'validation_error: Invalid user_id: ' || user_id {_TYPE_RULES}"""

_STEPS["checked"] = f"checked AS (SELECT *, CASE {_RULES} END AS error FROM arrivals)"
_STEPS["valid"] = "valid AS (SELECT * FROM checked WHERE error IS NULL)"
_STEPS["flagged"] = """
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY seq) > 1 AS is_duplicate
  FROM valid)"""
_STEPS["judged"] = f"""
marked AS (
  SELECT *, greatest({EPOCH}, coalesce(max(ts) OVER (PARTITION BY user_id ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {EPOCH})) AS wm
  FROM flagged WHERE NOT is_duplicate),
judged AS (
  SELECT *, ts < wm AS is_late,
    CASE WHEN ts < wm THEN (epoch_us(wm) - epoch_us(ts)) / 1e6 ELSE 0 END AS lateness,
    CASE WHEN ts >= wm THEN 'on_time'
      WHEN epoch_us(wm) - epoch_us(ts) <= {{allowed}} * CAST(1000000 AS BIGINT) THEN '{{tolerated}}'
      ELSE 'rejected' END AS action
  FROM marked)"""
_STEPS["carts"] = """
accepted AS (
  SELECT *, coalesce(sum(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) OVER (
      PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS cart_no
  FROM judged WHERE action <> 'rejected'),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, cart_no, product_id ORDER BY seq) AS k
  FROM accepted WHERE event_type <> 'checkout'),
walk AS (
  SELECT user_id, cart_no, product_id, k, seq, event_type, price, CAST(0 AS BIGINT) AS had,
    CASE WHEN event_type = 'add_to_cart' THEN CAST(quantity AS BIGINT) ELSE 0 END AS has
  FROM lines WHERE k = 1
  UNION ALL
  SELECT l.user_id, l.cart_no, l.product_id, l.k, l.seq, l.event_type, l.price, w.has,
    CASE l.event_type WHEN 'add_to_cart' THEN w.has + l.quantity
      WHEN 'remove_item' THEN greatest(0, w.has - l.quantity)
      ELSE CASE WHEN w.has > 0 THEN greatest(l.quantity, 0) ELSE 0 END END
  FROM walk w JOIN lines l ON l.user_id = w.user_id AND l.cart_no = w.cart_no
    AND l.product_id = w.product_id AND l.k = w.k + 1),
moves AS (
  SELECT a.*, w.had, w.has, coalesce((w.has - w.had) * a.price, 0) AS delta
  FROM accepted a LEFT JOIN walk w ON w.seq = a.seq),
carts AS (
  SELECT *,
    CASE WHEN event_type = 'checkout' THEN 0
      ELSE sum(delta) OVER (PARTITION BY user_id, cart_no ORDER BY seq) END AS after_total,
    coalesce(sum(delta) OVER (PARTITION BY user_id, cart_no ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_total,
    event_type IN ('add_to_cart', 'checkout') OR coalesce(had, 0) > 0 AS changed
  FROM moves)"""
_STEPS["fact"] = """
fact AS (
  SELECT event_id, user_id, session_id, event_type, coalesce(product_id, 0) AS product_id,
    coalesce(product_name, '') AS product_name, quantity, price,
    date_trunc('millisecond', ts) AS "timestamp",
    date_trunc('millisecond', arrived_at) AS processed_at,
    greatest(0, CAST(trunc((epoch_us(arrived_at) - epoch_us(ts)) / 1e6) AS BIGINT))
      AS processing_lag,
    CASE WHEN is_late THEN 1 ELSE 0 END AS is_late,
    CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
    before_total AS cart_total_before, after_total AS cart_total_after
  FROM carts)"""
_STEPS["results"] = """
results AS (
  SELECT seq, user_id, event_type, 'invalid' AS outcome, error,
    CAST(NULL AS DOUBLE) AS lateness, CAST(NULL AS DECIMAL(38,2)) AS after_total, arrived_at FROM checked WHERE error IS NOT NULL
  UNION ALL
  SELECT seq, user_id, event_type, 'duplicate', NULL, 0, NULL, arrived_at
    FROM flagged WHERE is_duplicate
  UNION ALL
  SELECT seq, user_id, event_type, 'late_rejected', 'late_event_beyond_tolerance', lateness, NULL,
    arrived_at FROM judged WHERE action = 'rejected'
  UNION ALL
  SELECT seq, user_id, event_type, CASE WHEN is_late THEN 'saved_late' ELSE 'saved' END, NULL,
    lateness, after_total, arrived_at FROM carts)"""


def _upto(step: str, query: str, shifted: str = _PREVIOUS, allowed: int = 300,
          tolerated: str = "accepted") -> str:
    steps = []
    for name, text in _STEPS.items():
        steps.append(text)
        if name == step:
            break
    chain = ",\n".join(s.strip() for s in steps)
    chain = chain.replace("{shifted}", shifted).replace("{allowed}", str(allowed))
    chain = chain.replace("{tolerated}", tolerated)
    return f"WITH RECURSIVE {chain}\n{query.strip()}"


def _with(step: str, extra: str, query: str, **options) -> str:
    return _upto(step, "", **options).rstrip() + ",\n" + extra.strip() + "\n" + query.strip()


def _number(expression: str, name: str) -> str:
    return f"CAST(round({expression}, 2) AS DOUBLE) AS {name}"


SQL: dict[str, str] = {}

SQL["decoded_messages"] = _with(
    "arrivals",
    "flags AS (SELECT *, n % 40 NOT IN (1, 5, 7) AS decoded FROM arrivals)",
    """
SELECT seq, decoded,
  CASE WHEN decoded THEN event_id END AS event_id,
  CASE WHEN decoded THEN user_id END AS user_id,
  CASE WHEN decoded THEN event_type END AS event_type,
  CASE WHEN decoded THEN product_id END AS product_id,
  CASE WHEN decoded THEN CASE WHEN n % 40 = 2 THEN 1 ELSE quantity END END AS quantity,
  CASE WHEN decoded THEN CASE WHEN n % 40 = 6 THEN 0.0 ELSE CAST(price AS DOUBLE) END END AS price,
  CASE WHEN decoded THEN CASE WHEN n % 40 = 3 THEN arrived_at ELSE ts END END AS "timestamp",
  CASE WHEN decoded THEN CASE WHEN n % 40 = 8 THEN '' ELSE session_id END END AS session_id
FROM flags""",
)
SQL["replayed_events"] = f"""
SELECT {REPLAY_START} + to_seconds(event_id) AS sent_at, 'run1-scn-' || event_id AS event_id,
  user_id, 'add_to_cart' AS event_type, event_id % 20 AS product_id,
  'p' || (event_id % 20) AS product_name, 1 AS quantity, value AS price,
  strftime({REPLAY_START} + to_seconds(event_id + CASE event_id % 10 WHEN 3 THEN -180
    WHEN 7 THEN -600 ELSE -10 END), '%Y-%m-%dT%H:%M:%S') AS "timestamp",
  CASE WHEN event_id % 3 = 1 THEN 's' || user_id ELSE 'sess_scenario_' || user_id END AS session_id
FROM events"""
SQL["time_parts"] = f"""
SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour_start,
  time_bucket(INTERVAL 5 MINUTE, ts) AS five_minutes, date_trunc('second', ts) AS whole_second,
  ts - INTERVAL 1 HOUR AS hour_before, CAST(hour(ts) AS INT) AS hour_of_day,
  CAST(isodow(ts) - 1 AS INT) AS day_of_week,
  round((epoch_us({AS_OF}) - epoch_us(ts)) / 1e6, 6) AS lag_seconds
FROM events"""
_TEXT_TS = """strftime(t, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN epoch_us(t) % 1000000 <> 0 THEN '.' || strftime(t, '%f') ELSE '' END"""
_CONTENT = f"""md5(user_id || ':' || event_type || ':'
  || coalesce(CAST(product_id AS VARCHAR), 'None') || ':' || {_TEXT_TS})"""
SQL["content_ids"] = _with(
    "arrivals",
    "timed AS (SELECT *, CASE WHEN seq % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS t "
    "FROM arrivals)",
    f"SELECT seq, {_CONTENT} AS content_id FROM timed",
)
_BROKEN = """
broken AS (
  SELECT * REPLACE (CASE WHEN seq % 50 = 9 THEN -price - 1 ELSE price END AS price,
    CASE seq % 50 WHEN 12 THEN '' WHEN 14 THEN NULL ELSE event_id END AS event_id)
  FROM arrivals)"""
SQL["broken_rules"] = _with(
    "arrivals", _BROKEN, f"SELECT seq, CASE {_RULES} END AS error FROM broken"
)
SQL["broken_producer_rules"] = _with(
    "arrivals", _BROKEN, f"SELECT seq, CASE {_TYPE_RULES} END AS error FROM broken"
)
SQL["first_copies"] = _upto("flagged", "SELECT seq, user_id, is_duplicate FROM flagged")
SQL["content_id_duplicates"] = _with(
    "valid",
    f"timed AS (SELECT *, ts AS t FROM valid), keyed AS (SELECT *, {_CONTENT} AS dedup_key "
    "FROM timed)",
    """SELECT seq, user_id, dedup_key,
  row_number() OVER (PARTITION BY user_id, dedup_key ORDER BY seq) > 1 AS is_duplicate
FROM keyed""",
)
SQL["duplicates_against_store"] = _with(
    "valid",
    """marks AS (SELECT user_id, event_id, max(arrived_at) AS processed_at FROM valid
  WHERE n % 3 = 0 GROUP BY ALL)""",
    """SELECT v.seq, coalesce(v.arrived_at + INTERVAL 86399 SECOND
    + to_seconds(v.seq % 2) - m.processed_at < INTERVAL 24 HOUR, false) AS is_duplicate
FROM valid v LEFT JOIN marks m ON m.user_id = v.user_id AND m.event_id = v.event_id""",
)
SQL["duplicates_with_expiry"] = _with(
    "valid",
    """coarse AS (SELECT seq, user_id, arrived_at,
    event_type || coalesce('-' || CAST(product_id % 3 AS VARCHAR), '') AS id FROM valid),
marks AS (
  SELECT user_id, id, min(seq) AS seq FROM coarse GROUP BY ALL
  UNION ALL
  SELECT user_id, id, nxt FROM (
    SELECT c.user_id, c.id, (SELECT min(x.seq) FROM coarse x
        WHERE x.user_id = c.user_id AND x.id = c.id AND x.seq > c.seq
          AND x.arrived_at - c.arrived_at >= INTERVAL 24 HOUR) AS nxt
    FROM marks m JOIN coarse c ON c.seq = m.seq) WHERE nxt IS NOT NULL)""",
    """SELECT c.seq, c.user_id, m.seq IS NULL AS is_duplicate
FROM coarse c LEFT JOIN marks m ON m.seq = c.seq""",
)
_LATENESS = """SELECT seq, user_id, is_late, round(lateness, 6) AS lateness_seconds, action,
  wm AS watermark_before, greatest(ts, wm) AS watermark_after,
  CASE WHEN action = 'adjusted' THEN wm ELSE ts END AS "timestamp" FROM judged"""
SQL["lateness_accept"] = _upto("judged", _LATENESS)
SQL["lateness_reject"] = _upto("judged", _LATENESS, tolerated="rejected")
SQL["lateness_adjust"] = _upto("judged", _LATENESS, tolerated="adjusted")
SQL["watermark_stats"] = _upto(
    "judged",
    """SELECT user_id, max(greatest(ts, wm)) AS max_timestamp,
  max(CASE WHEN action = 'on_time' THEN arrived_at END) AS last_processed,
  count(*) FILTER (WHERE action IN ('accepted', 'rejected')) AS late_event_count,
  count(*) FILTER (WHERE action = 'adjusted') AS adjusted_event_count
FROM judged GROUP BY user_id""",
    tolerated="adjusted",
)
SQL["cart_totals"] = _upto(
    "carts",
    f"""SELECT seq, user_id, event_type,
  CASE WHEN event_type <> 'checkout' THEN has END AS line_quantity,
  {_number('before_total', 'cart_total_before')}, {_number('after_total', 'cart_total_after')}
FROM carts""",
)
# Event by event over a map of the cart, with the floor an update puts under the total.
SQL["cart_totals_with_changing_prices"] = _with(
    "valid",
    """
numbered AS (
  SELECT seq, user_id, event_type, coalesce(product_id, 0) AS p, CAST(quantity AS BIGINT) AS q,
    price + (seq % 7) * 25 AS price,
    row_number() OVER (PARTITION BY user_id ORDER BY seq) AS k FROM valid),
steps AS (
  SELECT user_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS seq,
    CAST(MAP {} AS MAP(BIGINT, BIGINT)) AS items, CAST(0 AS DECIMAL(30,2)) AS before_total,
    CAST(0 AS DECIMAL(30,2)) AS after_total, false AS changed
  FROM numbered WHERE k = 1
  UNION ALL
  SELECT user_id, k, seq,
    CASE WHEN event_type = 'checkout' THEN CAST(MAP {} AS MAP(BIGINT, BIGINT))
      ELSE map_concat(items, MAP {p: has}) END,
    total,
    CAST(CASE WHEN event_type = 'checkout' THEN 0
      WHEN event_type = 'update_quantity' AND had > 0
        THEN greatest(0, total + (has - had) * price)
      ELSE total + (has - had) * price END AS DECIMAL(30,2)),
    event_type IN ('add_to_cart', 'checkout') OR had > 0
  FROM (
    SELECT *, CASE event_type WHEN 'add_to_cart' THEN had + q
        WHEN 'remove_item' THEN greatest(0, had - q)
        WHEN 'update_quantity' THEN CASE WHEN had > 0 THEN greatest(0, q) ELSE 0 END
        ELSE had END AS has
    FROM (
      SELECT n.*, s.items, s.after_total AS total, coalesce(s.items[n.p], 0) AS had
      FROM steps s JOIN numbered n ON n.user_id = s.user_id AND n.k = s.k + 1)))""",
    f"""SELECT seq, user_id, changed AS cart_changed,
  {_number('before_total', 'cart_total_before')}, {_number('after_total', 'cart_total_after')}
FROM steps WHERE k > 0""",
)
_SNAPSHOT = """
latest AS (
  SELECT user_id, arg_max(after_total, seq) AS total,
    count(*) FILTER (WHERE changed) AS event_count,
    coalesce(max(arrived_at) FILTER (WHERE changed), min(arrived_at)) AS last_updated,
    sum(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS cart_no
  FROM carts GROUP BY user_id),
held AS (
  SELECT c.user_id, c.product_id, arg_max(c.has, c.seq) AS units
  FROM carts c JOIN latest l ON l.user_id = c.user_id AND l.cart_no = c.cart_no
  WHERE c.event_type <> 'checkout' GROUP BY ALL),
snapshot AS (
  SELECT l.user_id, l.total, l.event_count, l.last_updated,
    count(h.units) FILTER (WHERE h.units > 0) AS products,
    CAST(coalesce(sum(h.units), 0) AS BIGINT) AS units
  FROM latest l LEFT JOIN held h ON h.user_id = l.user_id GROUP BY ALL)"""
SQL["cart_snapshot"] = _with(
    "carts",
    _SNAPSHOT,
    f"SELECT user_id, {_number('total', 'total_value')}, event_count, last_updated, products, "
    "units FROM snapshot",
)
SQL["open_carts"] = _with(
    "carts",
    _SNAPSHOT,
    f"SELECT user_id, {_number('total', 'total_value')} FROM snapshot WHERE products > 0",
)
SQL["enriched_events"] = _upto(
    "carts",
    f"""SELECT seq, round((epoch_us(arrived_at) - epoch_us(ts)) / 1e6, 6) AS processing_lag, is_late,
  CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
  {_number('before_total', 'cart_total_before')}, {_number('after_total', 'cart_total_after')},
  arrived_at AS processed_at FROM carts""",
)
SQL["event_outcomes"] = _upto(
    "results",
    f"""SELECT seq, user_id, outcome, error, round(lateness, 6) AS lateness_seconds,
  {_number('after_total', 'cart_total_after')} FROM results""",
)
SQL["handed_over_outcomes"] = SQL["event_outcomes"]
# Events taken one by one: a row per user and step, with all the user's state in it.
_ONE_BY_ONE = f"""
changed AS (
  SELECT seq, user_id, event_id, event_type, coalesce(product_id, 0) AS p, ts, arrived_at,
    CASE WHEN event_type = 'update_quantity' AND seq % 14 = 4 THEN -1
      WHEN event_type = 'add_to_cart' AND seq % 46 = 10 THEN 70000 ELSE quantity END AS q,
    seq % 80 IN (8, 48) AS bad_price,
    CASE WHEN event_type = 'add_to_cart' AND seq % 30 = 14 THEN 45000000.25 ELSE price END AS price,
    row_number() OVER (PARTITION BY user_id ORDER BY seq) AS k
  FROM valid),
step AS (
  SELECT user_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS seq, CAST('' AS VARCHAR) AS event_type,
    CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS error, {EPOCH} AS wm,
    CAST(MAP {{}} AS MAP(VARCHAR, TIMESTAMP)) AS marks, CAST(MAP {{}} AS MAP(BIGINT, BIGINT)) AS items,
    CAST(0 AS DECIMAL(20, 2)) AS total
  FROM (SELECT DISTINCT user_id FROM changed)
  UNION ALL
  SELECT user_id, k, seq, event_type, outcome,
    CASE outcome WHEN 'late_rejected' THEN 'late_event_beyond_tolerance' WHEN 'sink_range' THEN misfit END,
    CASE WHEN outcome = 'duplicate' THEN wm ELSE greatest(wm, ts) END,
    CASE WHEN saved THEN map_concat(marks, MAP([event_id], [arrived_at])) ELSE marks END,
    CASE WHEN NOT saved THEN items
      WHEN event_type = 'checkout' THEN CAST(MAP {{}} AS MAP(BIGINT, BIGINT))
      ELSE map_concat(items, MAP([p], [line])) END,
    CASE WHEN saved THEN CAST(new_total AS DECIMAL(20, 2)) ELSE total END
  FROM (
    SELECT *, outcome IN ('saved', 'saved_late') AS saved FROM (
      SELECT *,
        CASE WHEN is_duplicate THEN 'duplicate'
          WHEN epoch_us(wm) - epoch_us(ts) > 300000000 THEN 'late_rejected'
          WHEN misfit IS NOT NULL THEN 'sink_range'
          WHEN ts < wm THEN 'saved_late' ELSE 'saved' END AS outcome
      FROM (
        SELECT *,
          CASE WHEN q NOT BETWEEN 0 AND 65535 THEN 'sink_range: quantity'
            WHEN bad_price THEN 'sink_range: price'
            WHEN abs(new_total) > 99999999.99 THEN 'sink_range: cart_total_after' END AS misfit
        FROM (
          SELECT *,
            CASE event_type WHEN 'checkout' THEN 0
              WHEN 'add_to_cart' THEN total + q * price
              WHEN 'remove_item' THEN total - (have - line) * price
              ELSE CASE WHEN have > 0 THEN greatest(0, total + (line - have) * price) ELSE total END
            END AS new_total
          FROM (
            SELECT *,
              CASE event_type WHEN 'add_to_cart' THEN have + q
                WHEN 'remove_item' THEN greatest(0, have - q)
                ELSE CASE WHEN have > 0 THEN greatest(q, 0) ELSE 0 END END AS line
            FROM (
              SELECT c.user_id, c.k, c.seq, c.event_type, c.event_id, c.p, c.q, c.price, c.bad_price,
                c.ts, c.arrived_at, s.wm, s.marks, s.items, s.total,
                coalesce(s.items[c.p], 0) AS have,
                coalesce(epoch_us(c.arrived_at) - epoch_us(s.marks[c.event_id]) < 86400000000, false)
                  AS is_duplicate
              FROM step s JOIN changed c ON c.user_id = s.user_id AND c.k = s.k + 1)))))))"""
SQL["sink_range_outcomes"] = _with(
    "valid",
    _ONE_BY_ONE,
    """
SELECT seq, user_id, outcome, error,
  CASE WHEN outcome IN ('saved', 'saved_late') THEN CAST(total AS DOUBLE) END AS cart_total_after
FROM step WHERE k > 0
UNION ALL
SELECT seq, user_id, 'invalid', error, NULL FROM checked WHERE error IS NOT NULL""",
)
SQL["events_processed_with_misfits"] = _with(
    "valid",
    _ONE_BY_ONE,
    """
SELECT event_type, CASE outcome WHEN 'sink_range' THEN 'flush_error' ELSE 'success' END AS status,
  count(*) AS value
FROM step WHERE outcome IN ('saved', 'saved_late', 'sink_range') GROUP BY ALL
UNION ALL
SELECT event_type, 'validation_error', count(*) FROM checked WHERE error IS NOT NULL GROUP BY ALL""",
)
_FACT = f"""SELECT event_id, user_id, session_id, event_type, product_id, product_name, quantity,
  {_number('price', 'price')}, "timestamp", processed_at, processing_lag, is_late, hour_of_day,
  day_of_week, {_number('cart_total_before', 'cart_total_before')},
  {_number('cart_total_after', 'cart_total_after')} FROM fact"""
SQL["fact_rows"] = _upto("fact", _FACT)
SQL["approximate_duplicates"] = _upto(
    "results",
    """SELECT count(*) FILTER (WHERE outcome = 'duplicate') AS duplicates, CAST(0 AS BIGINT) AS missed,
  true AS within_bound FROM results""",
    shifted=_FIXED,
    allowed=86_400,
)
SQL["two_way_fact_rows"] = SQL["fact_rows"]
SQL["streamed_fact_rows"] = _upto("fact", _FACT, shifted=_FIXED, allowed=86_400)

_JSON = """json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type,
    'product_id', product_id, 'product_name', product_name, 'quantity', quantity,
    'price', CAST(price AS DOUBLE), 'timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
    'session_id', session_id)"""
_LETTER = f'CAST({_JSON} AS VARCHAR) AS original_event, error, arrived_at AS "timestamp"'
_LATE_LETTERS = f"""SELECT {_LETTER} FROM (
  SELECT * REPLACE ('late_event_beyond_tolerance' AS error) FROM judged WHERE action = 'rejected')"""
_INVALID_LETTERS = f"SELECT {_LETTER} FROM checked WHERE error IS NOT NULL"
SQL["dead_letter_rows"] = _upto("judged", f"{_LATE_LETTERS} UNION ALL {_INVALID_LETTERS}")
SQL["late_rejections"] = _upto("judged", _LATE_LETTERS)
SQL["validation_failures"] = _upto("checked", _INVALID_LETTERS)
SQL["retained_rows"] = _upto(
    "fact",
    f"""SELECT event_id, user_id, processed_at FROM fact
WHERE date_trunc('second', processed_at) + INTERVAL 30 DAY > {RETENTION_AS_OF}""",
)
SQL["latest_events"] = _upto(
    "fact",
    """SELECT event_id, user_id, event_type, is_late, processed_at FROM fact
ORDER BY processed_at DESC, event_id LIMIT 10""",
)
_CHANGES = """SELECT lpad(CAST(user_id % 100 AS VARCHAR), 3, '0') AS version, ts AS applied_at,
  event_id AS change_id, event_type || '_' || event_id AS migration_name, md5(props) AS checksum,
  CAST(event_id % 2 AS INT) AS success FROM events"""
SQL["latest_change_per_version"] = f"""SELECT * FROM ({_CHANGES})
QUALIFY row_number() OVER (PARTITION BY version ORDER BY applied_at DESC, change_id DESC) = 1"""
SQL["change_listing"] = f"{_CHANGES} ORDER BY version, applied_at"


def _kind(name: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{name}')"


def _sum_of(value: str, kind: str) -> str:
    return f"coalesce(sum({value}) FILTER (WHERE event_type = '{kind}'), 0)"


# Name, expression, and how it is rounded: every roll-up as (keys, filter, columns).
_ROLLUPS = {
    "minute": (
        {"minute": "date_trunc('minute', \"timestamp\")"},
        "true",
        {
            "add_to_cart_count": (_kind("add_to_cart"), None),
            "remove_item_count": (_kind("remove_item"), None),
            "update_quantity_count": (_kind("update_quantity"), None),
            "checkout_count": (_kind("checkout"), None),
            "total_events": ("count(*)", None),
            "late_events_count": ("CAST(sum(is_late) AS BIGINT)", None),
            "revenue_total": (_sum_of("cart_total_after", "checkout"), 2),
            "avg_cart_value": ("CAST(sum(cart_total_after) AS DOUBLE) / count(*)", 6),
            "max_cart_value": ("max(cart_total_after)", 2),
            "unique_users": ("count(DISTINCT user_id)", None),
            "unique_checkout_users": (
                "count(DISTINCT user_id) FILTER (WHERE event_type = 'checkout')", None),
            "checkout_value": (_sum_of("cart_total_before", "checkout"), 2),
        },
    ),
    "hourly_user": (
        {"hour": "date_trunc('hour', \"timestamp\")", "user_id": "user_id"},
        "true",
        {
            "total_actions": ("count(*)", None),
            "adds": (_kind("add_to_cart"), None),
            "removes": (_kind("remove_item"), None),
            "checkouts": (_kind("checkout"), None),
            "cart_value_change": ("sum(cart_total_after - cart_total_before)", 2),
            "sessions_count": ("count(DISTINCT session_id)", None),
            "avg_processing_lag_ms": ("avg(processing_lag)", 6),
        },
    ),
    "product": (
        {
            "window_start": "time_bucket(INTERVAL 5 MINUTE, \"timestamp\")",
            "product_id": "product_id",
            "product_name": "product_name",
        },
        "product_id > 0",
        {
            "add_count": (_kind("add_to_cart"), None),
            "remove_count": (_kind("remove_item"), None),
            "total_added_quantity": (
                f"CAST({_sum_of('quantity', 'add_to_cart')} AS BIGINT)", None),
            "total_removed_quantity": (
                f"CAST({_sum_of('quantity', 'remove_item')} AS BIGINT)", None),
            "potential_revenue": (_sum_of("price * quantity", "add_to_cart"), 2),
            "unique_users": ("count(DISTINCT user_id) FILTER (WHERE event_type IN "
                             "('add_to_cart', 'remove_item'))", None),
        },
    ),
}


def _rounded(expression: str, digits: int | None) -> str:
    return expression if digits is None else f"CAST(round({expression}, {digits}) AS DOUBLE)"


def _rollup(name: str, without: tuple[str, ...] = ()) -> str:
    keys, condition, columns = _ROLLUPS[name]
    columns = {c: text for c, text in columns.items() if c not in without}
    shown = [f"{text} AS {key}" for key, text in keys.items()]
    shown += [f"{_rounded(text, digits)} AS {column}" for column, (text, digits) in columns.items()]
    return _upto(
        "fact",
        f"SELECT {', '.join(shown)} FROM fact WHERE {condition} GROUP BY {', '.join(keys.values())}",
    )


def _summed(name: str) -> str:
    keys, condition, columns = _ROLLUPS[name]
    shown = [f"{text} AS {key}" for key, text in keys.items()]
    shown += [f"{text} AS {column}" for column, (text, _) in columns.items()]
    block = "epoch_us(processed_at) // 21600000000"
    kept = [key for key in keys if key != "product_name"]
    sums = [
        f"CAST(sum({c}) AS BIGINT) AS {c}" if digits is None
        else f"CAST(round(sum({c}), {digits}) AS DOUBLE) AS {c}"
        for c, (_, digits) in columns.items()
    ]
    blocks = (
        f"blocks AS (SELECT {', '.join(shown)} FROM fact WHERE {condition} "
        f"GROUP BY {block}, {', '.join(keys.values())})"
    )
    return _with(
        "fact",
        blocks,
        f"SELECT {', '.join([*kept, *sums])} FROM blocks GROUP BY {', '.join(kept)}",
    )


for _name in _ROLLUPS:
    SQL[f"{_name}_rollup"] = _rollup(_name)
    SQL[f"{_name}_rollup_from_batches"] = _rollup(_name)
    SQL[f"{_name}_rollup_summed"] = _summed(_name)
SQL["minute_sums_from_batches"] = _rollup("minute", ("unique_users", "unique_checkout_users"))
SQL["sketch_errors"] = """SELECT event_type, count(DISTINCT event_id) AS n, true AS within_bound
FROM events GROUP BY event_type"""
SQL["minute_rollup_from_bitmaps"] = SQL["minute_rollup"]
SQL["hourly_user_rollup_from_sketches"] = SQL["hourly_user_rollup"]
SQL["product_rollup_from_sketches"] = SQL["product_rollup"]
SQL["product_sketch_errors"] = _upto(
    "fact",
    f"""SELECT date_trunc('year', "timestamp") AS window_start, {_kind('add_to_cart')} AS add_count,
  {_kind('remove_item')} AS remove_count, true AS within_bound FROM fact GROUP BY 1""",
)
SQL["minute_uniques_from_sketches"] = _upto(
    "fact",
    """SELECT date_trunc('minute', "timestamp") AS minute, count(*) AS total_events,
  count(DISTINCT user_id) AS unique_users,
  count(DISTINCT user_id) FILTER (WHERE event_type = 'checkout') AS unique_checkout_users
FROM fact GROUP BY 1""",
)
SQL["active_carts"] = _upto(
    "fact",
    f"""SELECT user_id, max("timestamp") AS last_activity,
  {_kind('add_to_cart')} - {_kind('remove_item')} AS net_adds,
  {_number('max(cart_total_after)', 'current_cart_value')}, max(session_id) AS current_session
FROM fact WHERE "timestamp" > {AS_OF} - INTERVAL 1 HOUR AND event_type <> 'checkout'
GROUP BY user_id HAVING net_adds > 0 ORDER BY last_activity DESC""",
)
SQL["flush_errors"] = _upto(
    "fact",
    """SELECT event_type, count(*) AS counted, CAST(count(*) AS BIGINT) AS value, CAST(1 AS BIGINT) AS failed_batches
FROM fact WHERE CAST(event_id AS BIGINT) % 2 = 1 GROUP BY event_type""",
)
SQL["active_carts_of_table"] = SQL["active_carts"]
SQL["latest_events_of_table"] = SQL["latest_events"]
SQL["events_processed"] = _upto(
    "results",
    """SELECT event_type, CASE WHEN outcome = 'invalid' THEN 'validation_error' ELSE 'success' END
  AS status, count(*) AS value
FROM results WHERE outcome IN ('saved', 'saved_late', 'invalid') GROUP BY ALL""",
)
SQL["duplicate_events"] = _upto(
    "flagged", "SELECT count(*) AS value FROM flagged WHERE is_duplicate"
)
_ACTION = "CASE outcome WHEN 'saved_late' THEN 'accepted' ELSE 'rejected' END"
_LATE = "outcome IN ('saved_late', 'late_rejected')"
SQL["late_events"] = _upto(
    "results", f"SELECT {_ACTION} AS action, count(*) AS value FROM results WHERE {_LATE} GROUP BY 1"
)
_BOUNDS = "(0.005), (0.01), (0.025), (0.05), (0.075), (0.1), (0.25), (0.5), (0.75), (1.0), (2.5), " \
    "(5.0), (7.5), (10.0), (1e300)"  # fmt: skip
SQL["processing_histogram"] = f"""
SELECT event_type, CASE WHEN le < 1e9 THEN CAST(le AS DOUBLE) END AS le,
  count(*) FILTER (WHERE value / 100 <= le) AS value
FROM events CROSS JOIN (VALUES {_BOUNDS}) bounds(le) GROUP BY event_type, bounds.le"""
SQL["p95_processing_seconds"] = f"""
WITH counts AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(le AS DOUBLE) AS le,
    count(*) FILTER (WHERE value / 100 <= le) AS c
  FROM events CROSS JOIN (VALUES {_BOUNDS}) bounds(le) GROUP BY ALL),
ranked AS (
  SELECT *, 0.95 * max(c) OVER w AS rank,
    coalesce(lag(le) OVER (PARTITION BY window_start ORDER BY le), 0) AS below_le,
    coalesce(lag(c) OVER (PARTITION BY window_start ORDER BY le), 0) AS below_c
  FROM counts WINDOW w AS (PARTITION BY window_start))
SELECT window_start, round(CASE WHEN le > 1e9 THEN 10.0
    ELSE below_le + (le - below_le) * (rank - below_c) / (c - below_c) END, 6) AS value
FROM ranked WHERE c >= rank AND below_c < rank"""
_OFFSETS = """max(event_id) + 1 AS highwater,
  max(event_id) FILTER (WHERE event_type <> 'view' AND user_id % 6 <> 5) AS position FROM events"""
SQL["consumer_lag"] = f"""
SELECT CAST(coalesce(sum(greatest(0, highwater - position)), 0) AS BIGINT) AS value
FROM (SELECT user_id % 6 AS partition, {_OFFSETS} GROUP BY 1) WHERE position IS NOT NULL"""
SQL["consumer_lag_series"] = f"""
SELECT ts, CAST(coalesce(sum(CASE WHEN position IS NOT NULL
  THEN greatest(0, highwater - position) END), 0) AS BIGINT) AS value
FROM (SELECT user_id % 6 AS partition, date_trunc('hour', ts) AS ts, {_OFFSETS} GROUP BY 1, 2)
GROUP BY ts"""


def _series(condition: str, label: str = "") -> str:
    named = f", {_ACTION} AS action" if label else ""
    by = f"PARTITION BY {label} " if label else ""
    shown = f", {label}" if label else ""
    return _upto(
        "results",
        f"""SELECT minute{shown}, CAST(sum(c) OVER ({by}ORDER BY minute) AS BIGINT) AS value FROM (
  SELECT date_trunc('minute', arrived_at) AS minute{named}, count(*) AS c
  FROM results WHERE {condition} GROUP BY ALL)""",
    )


SQL["success_total_series"] = _series("outcome IN ('saved', 'saved_late')")
SQL["duplicate_total_series"] = _series("outcome = 'duplicate'")
SQL["late_total_series"] = _series(_LATE, "action")
SQL["late_increase_per_minute"] = _upto(
    "results",
    f"""SELECT date_trunc('minute', arrived_at) AS minute, {_ACTION} AS action, count(*) AS value
FROM results WHERE {_LATE} GROUP BY ALL""",
)
SQL["last_metric_values"] = f"""
SELECT event_type AS name, arg_max(value, ts) AS value FROM events
WHERE event_id % 3 > 0 AND ts > {AS_OF} - INTERVAL 120 MINUTE AND ts <= {AS_OF}
GROUP BY event_type"""
