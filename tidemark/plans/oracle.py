"""The registered queries as plain SQL over the same tables, to check results independently."""

from __future__ import annotations

ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
CENTS = "CAST(round(value * 100) AS BIGINT)"
SECOND = "(epoch_us(ts) // 1000000)"


def _ts(seconds: str) -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


def _sliding(source: str, keys: str, size: int, slide: int, values: str = "count(*) AS count") -> str:
    """Aggregates per key and sliding window, every row put into each of its windows."""
    head = f"{keys}, " if keys else ""
    return f"""
        SELECT {head}{_ts('s')} AS window_start, {_ts(f's + {size}')} AS window_end, {values}
        FROM (SELECT *, unnest(generate_series(({SECOND} - {size}) // {slide} * {slide} + {slide},
                                               {SECOND} // {slide} * {slide}, {slide})) AS s
              FROM ({source}))
        GROUP BY {head}s"""


VIEWS = f"SELECT event_id, ts, user_id, {ITEM} AS item_id FROM events WHERE event_type = 'view'"
CLICKS = "SELECT event_id, ts, user_id FROM events WHERE event_type = 'click'"
ITEM_COUNTS = _sliding(VIEWS, "item_id", 3600, 300)


def _ranked(counts: str, entry: str, n: int) -> str:
    return f"""
        SELECT * FROM (
            SELECT window_end, {entry}, count, CAST(row_number() OVER (
                PARTITION BY window_end ORDER BY count DESC, {entry}) AS INTEGER) AS rank
            FROM ({counts})) WHERE rank <= {n}"""


HOT_ITEMS = _ranked(ITEM_COUNTS, "item_id", 3)

REQUESTS = """
    SELECT e.ts, CASE WHEN e.event_type = 'signup' THEN 'POST' ELSE 'GET' END AS method,
           p.url || CASE WHEN e.event_id % 4 = 0 THEN '.css' ELSE '' END AS url
    FROM events e JOIN pages p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id"""
URL_COUNTS = _sliding(
    rf"SELECT * FROM ({REQUESTS}) WHERE method = 'GET' AND NOT regexp_matches(url, '\.(css|js|png|ico)$')",
    "url",
    600,
    60,
)
HOT_URLS = _ranked(URL_COUNTS, "url", 5)


def _report(ranked: str, header: str, entry: str, entry_text: str, metric_text: str, footer: str) -> str:
    return f"""
        SELECT window_end, '{header}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
               string_agg('NO' || rank || '{entry_text}' || {entry} || '{metric_text}' || count,
                          chr(10) ORDER BY rank) || chr(10) || '{footer}' AS report
        FROM ({ranked}) GROUP BY window_end"""


HOUR = _ts(f"{SECOND} // 3600 * 3600")
HOUR_END = _ts(f"{SECOND} // 3600 * 3600 + 3600")
POSITION = """list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
                                         lambda c: CAST(ord(c) AS BIGINT)),
                          lambda a, b: (a * 61 + b) % 268435456)"""


def _per_hour(source: str, values: str) -> str:
    return f"""SELECT {HOUR} AS window_start, {HOUR_END} AS window_end, {values}
               FROM ({source}) GROUP BY ALL"""


CAPPED = f"""
    SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS n
    FROM ({CLICKS})"""

LOGIN_STEPS = """
    SELECT user_id, ts, event_type = 'error' AS fail,
           lag(event_type = 'error') OVER w AS fail_1, lag(ts) OVER w AS ts_1,
           lag(event_type = 'error', 2) OVER w AS fail_2, lag(ts, 2) OVER w AS ts_2,
           lag(event_type = 'error', 3) OVER w AS fail_3
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def _next_time(after: str, user: str, kind: str) -> str:
    return f"(SELECT min(n.ts) FROM events n WHERE n.user_id = {user} AND n.event_type = '{kind}' AND n.ts > {after})"


PAYS = "(SELECT o_orderkey AS order_id, o_orderdate AS pay_ts FROM orders)"
RECEIPTS = "(SELECT l_orderkey AS order_id, l_linenumber AS line, l_shipdate AS receipt_ts FROM lineitem)"
IN_RANGE = """p.order_id = r.order_id AND r.receipt_ts >= p.pay_ts - INTERVAL 3 DAY
              AND r.receipt_ts <= p.pay_ts + INTERVAL 5 DAY"""
DAYS_15, DAYS_5 = 15 * 86400, 5 * 86400


def _starts(ts: str, size: int, slide: int) -> str:
    second = f"(epoch_us({ts}) // 1000000)"
    return f"""unnest(generate_series(({second} - {size}) // {slide} * {slide} + {slide},
                                      {second} // {slide} * {slide}, {slide}))"""


def _window_join(size: int, slide: int) -> str:
    return f"""
        SELECT {_ts('p.s')} AS window_start, {_ts(f'p.s + {size}')} AS window_end,
               p.order_id, p.pay_ts, r.line, r.receipt_ts
        FROM (SELECT *, {_starts('pay_ts', size, slide)} AS s FROM {PAYS}) p
        JOIN (SELECT *, {_starts('receipt_ts', size, slide)} AS s FROM {RECEIPTS}) r
          ON p.order_id = r.order_id AND p.s = r.s"""


LINE_HEAD = f"user_id || ',' || {ITEM} || ',' || {ITEM} % 7"

ORACLE: dict[str, str] = {
    "hot_items": HOT_ITEMS,
    "corrected_hot_items": HOT_ITEMS,
    "unique_visitors_merged": f"""
        SELECT {_ts(f"{SECOND} // 86400 * 86400")} AS window_start, {_ts(f"{SECOND} // 86400 * 86400 + 86400")} AS window_end,
               count(DISTINCT {POSITION}) AS count
        FROM ({VIEWS}) GROUP BY ALL""",
    "event_times": f"SELECT event_id, {_ts(SECOND)} AS by_s, make_timestamp(epoch_us(ts) // 1000 * 1000) AS by_ms FROM events",
    "paid_transactions": """
        SELECT event_id AS pay_event_id, user_id AS pay_order_id, 'pay' AS pay_event_type, 'tx' || event_id AS tx_id, ts AS pay_ts
        FROM events WHERE event_type = 'purchase' AND event_id % 3 = 1""",
    "side_outputs": f"""
        SELECT CASE WHEN n = 1 THEN 'passed' ELSE 'warned' END AS output, user_id, count(*) AS count
        FROM ({CAPPED}) WHERE n <= 2 GROUP BY ALL""",
    "item_window_counts": ITEM_COUNTS,
    "top_n_report": _report(HOT_ITEMS, "时间: ", "item_id", ":商品ID", "点击量=", "=" * 14),
    "hot_urls": HOT_URLS,
    "hot_urls_report": _report(HOT_URLS, "时间", "url", ": URL=", " 点击量=", "=" * 15),
    "late_corrected_counts": f"""
        SELECT item_id, {HOUR_END} AS window_end, count(*) AS count
        FROM ({VIEWS}) GROUP BY ALL""",
    "parse_access_log": f"""
        SELECT '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
               CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts, 'GET' AS method,
               '/item/' || {ITEM} AS url
        FROM events""",
    "parse_delimited": f"""
        SELECT user_id, {ITEM} AS item_id, CAST({ITEM} % 7 AS INTEGER) AS category_id,
               event_type AS behavior, {SECOND} AS epoch
        FROM events WHERE event_type <> 'error'""",
    "parse_rejects": f"SELECT {LINE_HEAD} AS value FROM events WHERE event_type = 'error'",
    "static_asset_filter": r"""
        SELECT * FROM (
            SELECT page_id, url || ['.css', '.css?x', '.js', '.PNG', '.ico', '.png', ''][page_id % 7 + 1] AS url
            FROM pages)
        WHERE NOT regexp_matches(url, '\.(css|js|png|ico)$')""",
    "page_views": _per_hour(VIEWS, "'pv' AS label, count(*) AS count"),
    "unique_visitors": _per_hour(VIEWS, "count(DISTINCT user_id) AS count"),
    "unique_items": _per_hour(VIEWS, "count(DISTINCT item_id) AS count"),
    "unique_visitors_approx": _per_hour(VIEWS, "count(DISTINCT user_id) AS exact, true AS is_near"),
    "unique_visitors_bitmap": _per_hour(VIEWS, f"count(DISTINCT {POSITION}) AS count"),
    "unique_visitors_running": f"""
        SELECT window_end, id, first_seen,
               row_number() OVER (PARTITION BY window_end ORDER BY first_seen, event_id) AS count
        FROM (SELECT {HOUR_END} AS window_end, {POSITION} AS id, ts AS first_seen, event_id,
                     row_number() OVER (PARTITION BY {HOUR_END}, {POSITION} ORDER BY ts, event_id) AS sight
              FROM ({VIEWS}))
        WHERE sight = 1""",
    "bitmap_positions": f"SELECT DISTINCT user_id, {POSITION} AS position FROM events",
    "channel_counts": "SELECT window_start, channel, behavior, count FROM ("
    + _sliding(
        f"""SELECT ts, event_type AS behavior, 'channel_' || ({ITEM} % 5) AS channel
            FROM events WHERE event_type <> 'error'""",
        "channel, behavior",
        3600,
        60,
    )
    + ")",
    "ad_clicks_by_province": "SELECT window_end, province, count FROM ("
    + _sliding(
        f"""SELECT c.ts, n_name AS province FROM ({CAPPED}) c
            JOIN customer ON c.user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
            WHERE n <= 2""",
        "province",
        3600,
        60,
    )
    + ")",
    "ad_blacklist": f"""
        SELECT user_id, ts AS at, 'click over2times today' AS message FROM ({CAPPED}) WHERE n = 3""",
    "daily_click_sequence": f"""
        SELECT event_id, ts, user_id, CAST(ts AS DATE) AS day, n AS count FROM ({CAPPED})""",
    "daily_reset_times": """
        SELECT event_id, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS reset_at FROM events""",
    "future_rejects": "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-21 00:00:00'",
    "login_fail_pairs": f"""
        SELECT user_id, ts_1 AS first_fail, ts AS last_fail, 'login fail in 21600 seconds' AS message
        FROM ({LOGIN_STEPS}) WHERE fail AND fail_1 AND ts - ts_1 < INTERVAL 6 HOUR""",
    "login_fail_runs": f"""
        SELECT user_id, ts_1 AS first_fail, ts AS last_fail, 'login fail in 86400 seconds' AS message
        FROM ({LOGIN_STEPS})
        WHERE fail AND fail_1 AND NOT coalesce(fail_2, false) AND ts - ts_1 < INTERVAL 24 HOUR""",
    "login_fail_runs_of_three": """
        WITH marked AS (
            SELECT user_id, ts, event_id, event_type = 'error' AS fail,
                   count(*) FILTER (event_type <> 'error') OVER (
                       PARTITION BY user_id ORDER BY ts, event_id) AS run
            FROM events),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS n
            FROM marked WHERE fail)
        SELECT user_id, min(ts) AS first_fail, max(ts) AS last_fail,
               'login fail in 432000 seconds' AS message
        FROM numbered WHERE n <= 3 GROUP BY user_id, run
        HAVING count(*) = 3 AND max(ts) - min(ts) < INTERVAL 5 DAY""",
    "login_fail_cep": """
        SELECT user_id, ts AS first_fail, next_ts AS last_fail, 'login fail in 21600 seconds' AS message
        FROM (SELECT user_id, ts, event_type, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type = 'error' AND next_type = 'error' AND next_ts - ts < INTERVAL 6 HOUR""",
    "order_timeout_cep": """
        SELECT user_id, create_ts, CASE WHEN paid THEN next_pay END AS pay_ts,
               CASE WHEN paid THEN 'payed successfully' ELSE 'time out' END AS result
        FROM (SELECT *, coalesce(next_pay - create_ts < INTERVAL 12 HOUR, false) AS paid
              FROM (SELECT user_id, ts AS create_ts, event_type, min(CASE WHEN event_type = 'purchase' THEN ts END)
                        OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pay
                    FROM events)
              WHERE event_type = 'click')""",
    "three_step_sequence": f"""
        SELECT user_id, click_ts,
               CASE WHEN v - click_ts < INTERVAL 2 DAY THEN v END AS view_ts,
               CASE WHEN p - click_ts < INTERVAL 2 DAY THEN p END AS purchase_ts,
               CASE WHEN p - click_ts < INTERVAL 2 DAY THEN 'matched' ELSE 'timeout' END AS output
        FROM (SELECT *, {_next_time('x.v', 'x.user_id', 'purchase')} AS p
              FROM (SELECT c.user_id, c.ts AS click_ts, {_next_time('c.ts', 'c.user_id', 'view')} AS v
                    FROM events c WHERE c.event_type = 'click') x)""",
    "strict_then_relaxed_sequence": f"""
        SELECT user_id, click_ts, CASE WHEN next_in THEN next_ts END AS view_ts,
               CASE WHEN next_in AND p - click_ts < INTERVAL 3 DAY THEN p END AS purchase_ts,
               CASE WHEN next_in AND p - click_ts < INTERVAL 3 DAY THEN 'matched' ELSE 'timeout' END AS output
        FROM (SELECT *, coalesce(next_ts - click_ts < INTERVAL 3 DAY, false) AS next_in,
                     CASE WHEN next_type = 'view' THEN {_next_time('x.next_ts', 'x.user_id', 'purchase')} END AS p
              FROM (SELECT user_id, ts AS click_ts, event_type, lead(event_type) OVER w AS next_type,
                           lead(ts) OVER w AS next_ts
                    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x
              WHERE event_type = 'click')
        WHERE NOT next_in OR next_type = 'view'""",
    "order_pay_status": """
        SELECT user_id, create_ts, pay_ts, result FROM (
            SELECT user_id,
                   CASE WHEN event_type = 'click' THEN ts WHEN before = 'click' THEN before_ts END AS create_ts,
                   CASE WHEN event_type = 'purchase' THEN ts END AS pay_ts,
                   CASE WHEN event_type = 'purchase' AND before IS DISTINCT FROM 'click'
                            THEN 'already payed but not found created log'
                        WHEN event_type = 'purchase' AND ts - before_ts < INTERVAL 12 HOUR THEN 'payed successfully'
                        WHEN event_type = 'purchase' THEN 'payed but already timeout'
                        WHEN after IS NULL OR (after = 'click' AND after_ts - ts >= INTERVAL 12 HOUR)
                            THEN 'time out' END AS result
            FROM (SELECT *, lag(event_type) OVER w AS before, lag(ts) OVER w AS before_ts,
                         lead(event_type) OVER w AS after, lead(ts) OVER w AS after_ts
                  FROM events WHERE event_type IN ('click', 'purchase')
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type, event_id)))
        WHERE result IS NOT NULL""",
    "tx_interval_join": f"""
        SELECT p.order_id, p.pay_ts, r.line, r.receipt_ts FROM {PAYS} p JOIN {RECEIPTS} r ON {IN_RANGE}""",
    "tx_window_join": _window_join(DAYS_15, DAYS_15),
    "tx_sliding_window_join": _window_join(DAYS_15, DAYS_5),
    "tx_match": f"""
        SELECT coalesce(p.order_id, r.order_id) AS order_id, p.pay_ts, r.line, r.receipt_ts,
               CASE WHEN r.order_id IS NULL THEN 'unmatched_pay' WHEN p.order_id IS NULL THEN 'unmatched_receipt'
                    ELSE 'matched' END AS output
        FROM {PAYS} p FULL JOIN {RECEIPTS} r ON {IN_RANGE}""",
    "avg_value": _per_hour(f"SELECT ts, {CENTS} AS cents FROM events", "avg(cents) AS avg_cents"),
    "avg_value_sliding": _sliding(
        f"SELECT ts, {CENTS} AS cents, event_type AS behavior FROM events",
        "behavior",
        7200,
        1800,
        "avg(cents) AS avg_cents",
    ),
    "window_profile": _sliding(
        f"SELECT ts, value, event_type AS behavior, {ITEM} AS item_id FROM events",
        "behavior",
        3600,
        1200,
        "min(value) AS lowest, max(value) AS highest, count(DISTINCT item_id) AS items",
    ),
}
