"""The same results as plain SQL over the same tables, written from the definitions: every row goes
into every window that covers it, neighbours are taken over a user's whole history, joins are range
joins. None of the library's shortcuts (panes, blocks, slices, runs) appear here."""

from __future__ import annotations

_ITEM = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
_SECOND = "date_trunc('second', ts)"
_EPOCH = "TIMESTAMP '1970-01-01'"
_PV = "event_type = 'view'"
_BEHAVIOR = "CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END"
_LOGIN = "CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END"
_ORDER = "CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END"
_IP = "'10.0.0.' || (user_id % 256)"
_PROVINCE = ("events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey")


def _hop(keys: str, source: str, size: int, slide: int) -> str:
    """Sliding count with one row per window, in seconds."""
    return f"""SELECT {keys}, time_bucket(INTERVAL '{slide} seconds', ts, {_EPOCH})
       + (k + 1) * INTERVAL '{slide} seconds' AS window_end, count(*) AS cnt
FROM ({source}) AS src CROSS JOIN range({size // slide}) AS panes(k) GROUP BY ALL"""


def _runs(keys: str, source: str, size: int, slide: int) -> str:
    """Consecutive windows with one count."""
    return f"""WITH hop AS ({_hop(keys, source, size, slide)}),
numbered AS (SELECT *, CAST(epoch_us(window_end) // {slide * 10**6} AS BIGINT) AS w FROM hop),
islands AS (SELECT *, w - row_number() OVER (PARTITION BY {keys}, cnt ORDER BY w) AS island FROM numbered)
SELECT {keys}, min(window_end) AS first_window_end, max(window_end) AS last_window_end,
       count(*) AS windows, cnt
FROM islands GROUP BY {keys}, cnt, island"""


def _top(counts: str, key: str) -> str:
    return f"""WITH counts AS ({counts}), ranked AS (SELECT *, row_number() OVER (
    PARTITION BY window_end ORDER BY cnt DESC, {key}) AS rk FROM counts)
SELECT window_end, CAST(rk AS INTEGER) AS rank, {key}, cnt FROM ranked WHERE rk <= 5"""


_VIEWS = f"SELECT ts, {_ITEM} AS item_id FROM events WHERE {_PV}"
_GETS = f"SELECT ts, '/k/' || {_ITEM} AS url FROM events WHERE event_type <> 'error'"
_HOT_ITEMS = _hop("item_id", _VIEWS, 3600, 300)
_HOT_URLS = _hop("url", _GETS, 600, 5)
_CHANNELS = f"SELECT ts, 'channel-' || ({_ITEM} % 4) AS channel, event_type AS behavior FROM events"
_HOUR_END = "time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour'"


def _clicks(extra: str = "", source: str = "events") -> str:
    return f"""SELECT event_id, ts, user_id, ad_id, {extra} day, row_number() OVER (
    PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS rn
FROM (SELECT *, {_ITEM} % 2 AS ad_id, CAST(ts + INTERVAL '8 hours' AS DATE) AS day
      FROM {source} WHERE event_type = 'click') AS c"""


_DAY_TEXT = "strftime(day, '%Y-%m-%d') AS day"

_LOGINS = f"""SELECT user_id, event_id, ts, {_LOGIN} AS kind FROM events"""


def _fail_run(n: int, within: str) -> str:
    return f"""WITH l AS ({_LOGINS}), s AS (SELECT *,
    lag(ts, {n - 1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_ts,
    sum(CASE WHEN kind = 'fail' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS fails FROM l)
SELECT user_id, first_ts, ts AS last_ts, CAST(fails AS BIGINT) AS n FROM s
WHERE fails = {n} AND ts - first_ts < INTERVAL '{within}'"""


_EPISODES = f"""WITH RECURSIVE l AS (SELECT user_id, ts, kind,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS total FROM ({_LOGINS}) AS x),
walk AS (
  SELECT user_id, rn, total, CASE WHEN kind = 'fail' THEN ts END AS t0,
         CASE WHEN kind = 'fail' THEN ts END AS t1, CASE WHEN kind = 'fail' THEN 1 ELSE 0 END AS n,
         CAST(NULL AS TIMESTAMP) AS done0, CAST(NULL AS TIMESTAMP) AS done1, 0 AS done_n
  FROM l WHERE rn = 1
  UNION ALL
  SELECT l.user_id, l.rn, l.total,
         CASE WHEN kind <> 'fail' THEN NULL WHEN ts <= t0 + INTERVAL '12 hours' THEN t0 ELSE ts END,
         CASE WHEN kind <> 'fail' THEN NULL ELSE ts END,
         CASE WHEN kind <> 'fail' THEN 0 WHEN ts <= t0 + INTERVAL '12 hours' THEN n + 1 ELSE 1 END,
         CASE WHEN ts > t0 + INTERVAL '12 hours' THEN t0 END,
         CASE WHEN ts > t0 + INTERVAL '12 hours' THEN t1 END,
         CASE WHEN ts > t0 + INTERVAL '12 hours' THEN n ELSE 0 END
  FROM walk JOIN l ON l.user_id = walk.user_id AND l.rn = walk.rn + 1)
SELECT user_id, done0 AS first_ts, done1 AS last_ts, CAST(done_n AS BIGINT) AS n FROM walk WHERE done_n >= 2
UNION ALL
SELECT user_id, t0, t1, CAST(n AS BIGINT) FROM walk WHERE rn = total AND n >= 2"""

_ORDERS = f"""SELECT event_id, ts, user_id AS order_id, {_ORDER} AS kind
FROM events WHERE event_type IN ('signup', 'purchase')"""
_FIRST_PAY = f"""WITH o AS ({_ORDERS}), f AS (SELECT c.order_id, c.event_id AS create_id,
    c.ts AS create_ts, min(p.ts) AS pay_ts
  FROM o AS c LEFT JOIN o AS p ON p.order_id = c.order_id AND p.kind = 'pay'
    AND (p.ts > c.ts OR (p.ts = c.ts AND p.event_id > c.event_id)) AND p.ts < c.ts + INTERVAL '12 hours'
  WHERE c.kind = 'create' GROUP BY ALL)"""

# One pass over each order's history: the open create is the last create with no pay since.
_STATUS = f"""WITH o AS ({_ORDERS}), h AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts, event_id) AS rn
  FROM o), opened AS (SELECT *, max(CASE WHEN kind = 'create' THEN rn END) OVER past AS create_rn,
    max(CASE WHEN kind = 'pay' THEN rn END) OVER past AS pay_rn FROM h
  WINDOW past AS (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pays AS (SELECT p.order_id, c.event_id AS create_id, c.ts AS create_ts, p.event_id AS pay_id, p.ts AS pay_ts
  FROM opened AS p LEFT JOIN h AS c ON c.order_id = p.order_id AND c.rn = p.create_rn
    AND p.create_rn > coalesce(p.pay_rn, 0) AND p.ts <= c.ts + INTERVAL '12 hours'
  WHERE p.kind = 'pay'),
status AS (SELECT *, CASE WHEN create_id IS NULL THEN 'late_or_orphan' ELSE 'paid' END AS status FROM pays
  UNION ALL
  SELECT order_id, event_id, ts, NULL, NULL, 'no_pay' FROM o WHERE kind = 'create'
    AND event_id NOT IN (SELECT create_id FROM pays WHERE create_id IS NOT NULL))"""

_PAY = "SELECT event_id AS pay_id, ts AS pay_ts, user_id AS tx_id FROM events WHERE event_type = 'purchase'"
_RECEIPT = ("SELECT event_id AS receipt_id, ts AS receipt_ts, user_id AS tx_id FROM events "
            "WHERE event_type = 'click'")
_IN_REACH = ("p.tx_id = r.tx_id AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL '3 hours' "
             "AND p.pay_ts + INTERVAL '5 hours'")

_CHANGELOG = f"""WITH v AS ({_VIEWS}), hits AS (
  SELECT item_id, CAST(epoch_us(ts) // 300000000 AS BIGINT) AS pane, w.k FROM v CROSS JOIN range(12) AS w(k)),
states AS (SELECT item_id, pane + 1 + k AS win, s.step, count(*) AS cnt
  FROM hits JOIN range(12) AS g(j) ON g.j <= hits.k,
    LATERAL (SELECT hits.pane + g.j AS step) AS s
  GROUP BY ALL),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY win, step ORDER BY cnt DESC, item_id) AS rk FROM states) AS r WHERE rk <= 5),
added AS (SELECT a.win, a.step AS shown, '+' AS change, a.rk, a.item_id, a.cnt FROM ranked AS a
  WHERE NOT EXISTS (SELECT 1 FROM ranked AS b WHERE b.win = a.win AND b.step = a.step - 1
    AND b.item_id = a.item_id AND b.rk = a.rk AND b.cnt = a.cnt)),
dropped AS (SELECT a.win, a.step + 1 AS shown, '-' AS change, a.rk, a.item_id, a.cnt FROM ranked AS a
  WHERE a.step + 1 < a.win AND NOT EXISTS (SELECT 1 FROM ranked AS b WHERE b.win = a.win
    AND b.step = a.step + 1 AND b.item_id = a.item_id AND b.rk = a.rk AND b.cnt = a.cnt))
SELECT {_EPOCH} + win * INTERVAL '5 minutes' AS window_end,
       {_EPOCH} + (shown + 1) * INTERVAL '5 minutes' AS as_of, change, CAST(rk AS INTEGER) AS rank, item_id, cnt
FROM (SELECT * FROM added UNION ALL SELECT * FROM dropped) AS c"""

ORACLE: dict[str, str] = {
    "parse_behavior_log": f"""SELECT user_id, {_ITEM} AS item_id, CAST({_ITEM} % 10 AS INTEGER) AS category_id,
       {_BEHAVIOR} AS behavior, {_SECOND} AS ts FROM events""",
    "parse_login_log": f"SELECT user_id, {_IP} AS ip, {_LOGIN} AS event_type, {_SECOND} AS ts FROM events",
    "parse_order_log": f"""SELECT user_id AS order_id, {_ORDER} AS event_type,
       CASE WHEN event_type = 'purchase' THEN 'tx' || event_id ELSE '' END AS tx_id, {_SECOND} AS ts
FROM events WHERE event_type IN ('signup', 'purchase')""",
    "parse_receipt_log": f"""SELECT 'tx' || user_id AS tx_id,
       CASE WHEN event_id % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel, {_SECOND} AS ts
FROM events WHERE event_type = 'click'""",
    "parse_ad_log": f"""SELECT user_id, {_ITEM} % 2 AS ad_id, n_name AS province,
       'city-' || (user_id % 10) AS city, {_SECOND} AS ts FROM {_PROVINCE} WHERE event_type = 'click'""",
    "parse_access_log": f"""SELECT {_IP} AS ip, CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_type = 'error' THEN 'POST' ELSE 'GET' END AS method, '/k/' || {_ITEM} AS url,
       {_SECOND} AS ts FROM events""",
    "pv_filter": f"""SELECT event_id, ts, user_id, {_ITEM} AS item_id,
       CAST({_ITEM} % 10 AS INTEGER) AS category_id, 'pv' AS behavior FROM events WHERE {_PV}""",
    "get_requests": f"""SELECT event_id, ts, {_IP} AS ip, CAST(user_id AS VARCHAR) AS user_id,
       'GET' AS method, '/k/' || {_ITEM} AS url FROM events WHERE event_type <> 'error'""",
    "hot_items_hop_count": _HOT_ITEMS,
    "hot_items_topn": _top(_HOT_ITEMS, "item_id"),
    "hot_items_sql": f"""SELECT window_end, rank AS row_num, item_id, cnt FROM ({_top(_HOT_ITEMS, 'item_id')}) AS t""",
    "topn_report": f"""SELECT window_end, repeat('=', 13) || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0'
       || repeat('=', 13) || chr(10) || string_agg('Top' || rank || ' ItemId:' || item_id || ' Count:' || cnt
       || chr(10), '' ORDER BY rank) AS report FROM ({_top(_HOT_ITEMS, 'item_id')}) AS t GROUP BY window_end""",
    "topn_changelog": _CHANGELOG,
    "hot_urls_hop_count": _runs("url", _GETS, 600, 5),
    "hot_urls_topn": _top(_HOT_URLS, "url"),
    "pv_hourly": f"SELECT {_HOUR_END} AS window_end, count(*) AS cnt FROM events WHERE {_PV} GROUP BY 1",
    "pv_hourly_salted": f"SELECT {_HOUR_END} AS window_end, count(*) AS cnt FROM events WHERE {_PV} GROUP BY 1",
    "uv_hourly_approx": f"""SELECT {_HOUR_END} AS window_end, TRUE AS close
FROM events WHERE {_PV} GROUP BY ALL""",
    "uv_hourly": f"""SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE {_PV} GROUP BY 1""",
    "uv_hourly_bitmap": f"""WITH u AS (SELECT {_HOUR_END} AS window_end, CAST(user_id AS VARCHAR) AS id
  FROM events WHERE {_PV}), c AS (SELECT window_end, id, length(id) AS len FROM u),
bits AS (SELECT window_end, id, sum(ascii(substr(id, CAST(i + 1 AS INTEGER), 1))
    * CAST(pow(32, len - 1 - i) AS HUGEINT)) % 1073741824 AS bit
  FROM (SELECT DISTINCT * FROM c) AS d JOIN range(20) AS r(i) ON i < len GROUP BY window_end, id)
SELECT window_end, count(DISTINCT bit) AS uv FROM bits GROUP BY 1""",
    "uv_running": f"""WITH v AS (SELECT event_id, ts, user_id, {_HOUR_END} AS window_end FROM events WHERE {_PV}),
s AS (SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) AS visit FROM v)
SELECT event_id, window_end, CAST(sum(CASE WHEN visit = 1 THEN 1 ELSE 0 END) OVER (
    PARTITION BY window_end ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv FROM s""",
    "channel_behavior_hop_count": _runs("channel, behavior", _CHANNELS, 3600, 5),
    "ad_click_capped": f"""SELECT event_id, ts, user_id, ad_id, {_DAY_TEXT}, CAST(rn AS INTEGER) AS nth
FROM ({_clicks()}) AS c WHERE rn < 2""",
    "ad_blacklist": f"""SELECT user_id, ad_id, {_DAY_TEXT}, ts AS alert_ts, 'blacklisted' AS warning
FROM ({_clicks()}) AS c WHERE rn = 2""",
    "ad_clicks_by_province": _runs(
        "province", f"SELECT ts, n_name AS province FROM ({_clicks('n_name,', _PROVINCE)}) AS c WHERE rn < 2",
        3600, 5),
    "login_fail_pair": f"""WITH l AS ({_LOGINS}), s AS (SELECT *, lag(kind) OVER w AS prev_kind, lag(ts) OVER w AS first_ts
  FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, first_ts, ts AS last_ts FROM s
WHERE kind = 'fail' AND prev_kind = 'fail' AND ts - first_ts <= INTERVAL '12 hours'""",
    "login_fail_episode": _EPISODES,
    "login_fail_run": _fail_run(3, "24 hours"),
    "login_fail_two_step": _fail_run(2, "12 hours"),
    "order_pay_match": f"{_FIRST_PAY} SELECT * FROM f WHERE pay_ts IS NOT NULL",
    "order_pay_timeout": f"{_FIRST_PAY} SELECT order_id, create_id, create_ts FROM f WHERE pay_ts IS NULL",
    "order_status": f"{_STATUS} SELECT order_id, create_ts, pay_ts, status FROM status",
    "order_late_payment": f"{_STATUS} SELECT order_id, pay_id, pay_ts FROM status WHERE status = 'late_or_orphan'",
    "pay_receipt_interval_join": f"""SELECT p.tx_id, pay_id, pay_ts, receipt_id, receipt_ts
FROM ({_PAY}) AS p JOIN ({_RECEIPT}) AS r ON {_IN_REACH}""",
    "pay_receipt_reconcile": f"""SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, pay_ts, receipt_ts,
       CASE WHEN receipt_id IS NULL THEN 'pay_only' WHEN pay_id IS NULL THEN 'receipt_only'
            ELSE 'matched' END AS status
FROM ({_PAY}) AS p FULL OUTER JOIN ({_RECEIPT}) AS r ON {_IN_REACH}""",
    "pay_without_receipt": f"""SELECT p.tx_id, pay_id, pay_ts FROM ({_PAY}) AS p
WHERE NOT EXISTS (SELECT 1 FROM ({_RECEIPT}) AS r WHERE {_IN_REACH})""",
    "receipt_without_pay": f"""SELECT r.tx_id, receipt_id, receipt_ts FROM ({_RECEIPT}) AS r
WHERE NOT EXISTS (SELECT 1 FROM ({_PAY}) AS p WHERE {_IN_REACH})""",
}

# A streaming twin must end with the rows of its batch query.
ORACLE |= {twin: ORACLE[batch] for twin, batch in {
    "stream_pv": "pv_hourly",
    "stream_pv_salted": "pv_hourly",
    "stream_uv": "uv_hourly",
    "stream_uv_bitmap": "uv_hourly_bitmap",
    "stream_uv_running": "uv_hourly",
    "stream_hot_items_topn": "hot_items_topn",
    "stream_topn_changelog": "hot_items_topn",
    "stream_topn_report": "topn_report",
    "stream_channel_behavior": "channel_behavior_hop_count",
    "stream_hot_urls": "hot_urls_topn",
    "stream_ad_clicks_by_province": "ad_clicks_by_province",
    "stream_login_fail": "login_fail_episode",
    "stream_login_fail_pair": "login_fail_pair",
    "stream_login_fail_run": "login_fail_run",
    "stream_login_fail_two_step": "login_fail_two_step",
    "stream_order_pay_match": "order_pay_match",
    "stream_order_pay_timeout": "order_pay_timeout",
    "stream_order_status": "order_status",
    "stream_reconcile": "pay_receipt_reconcile",
}.items()}
ORACLE["stream_ad_guard"] = f"""SELECT user_id, ad_id, {_DAY_TEXT}, ts,
       CASE WHEN rn < 2 THEN 'kept' ELSE 'blacklisted' END AS status
FROM ({_clicks()}) AS c WHERE rn <= 2"""

# Each transaction's rows in time order, with the one row that waits (side, time) carried along.
_STILL_WAITS = ("w_side IS NOT NULL AND kind <> w_side AND ts <= w_ts + CASE WHEN w_side = 'pay' "
                "THEN INTERVAL '5 hours' ELSE INTERVAL '3 hours' END")
ORACLE["stream_reconcile_one_to_one"] = f"""WITH RECURSIVE l AS (SELECT tx_id, ts, kind,
    row_number() OVER (PARTITION BY tx_id ORDER BY ts, id) AS rn, count(*) OVER (PARTITION BY tx_id) AS total
  FROM (SELECT user_id AS tx_id, ts, event_id AS id,
    CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'receipt' END AS kind
    FROM events WHERE event_type IN ('purchase', 'click')) AS x),
walk AS (SELECT tx_id, rn, total, kind AS w_side, ts AS w_ts, CAST(NULL AS VARCHAR) AS status,
    CAST(NULL AS TIMESTAMP) AS pay_ts, CAST(NULL AS TIMESTAMP) AS receipt_ts FROM l WHERE rn = 1
  UNION ALL
  SELECT l.tx_id, l.rn, l.total, CASE WHEN {_STILL_WAITS} THEN NULL ELSE kind END,
    CASE WHEN {_STILL_WAITS} THEN NULL ELSE ts END,
    CASE WHEN {_STILL_WAITS} THEN 'matched' WHEN w_side IS NOT NULL THEN w_side || '_only' END,
    CASE WHEN w_side = 'pay' THEN w_ts WHEN {_STILL_WAITS} THEN ts END,
    CASE WHEN w_side = 'receipt' THEN w_ts WHEN {_STILL_WAITS} THEN ts END
  FROM walk JOIN l ON l.tx_id = walk.tx_id AND l.rn = walk.rn + 1)
SELECT tx_id, pay_ts, receipt_ts, status FROM walk WHERE status IS NOT NULL
UNION ALL
SELECT tx_id, CASE WHEN w_side = 'pay' THEN w_ts END, CASE WHEN w_side = 'receipt' THEN w_ts END,
  w_side || '_only' FROM walk WHERE rn = total AND w_side IS NOT NULL"""
ORACLE["pay_receipt_one_to_one"] = ORACLE["stream_reconcile_one_to_one"]

# Results from log lines: times in whole seconds, a row's id from its line.
_SECONDS = "CAST(epoch(date_trunc('second', ts)) AS BIGINT)"


def _logged(line: str, rows: str = "events") -> str:
    return f"""SELECT CAST('0x' || substr(md5({line}), 1, 15) AS BIGINT) AS event_id, {_SECOND} AS ts, user_id, event_type
FROM {rows}"""


_LOGIN_LOG = _logged(f"user_id || ',' || {_IP} || ',' || {_LOGIN} || ',' || {_SECONDS}")
_ORDER_LOG = _logged(f"""user_id || ',' || {_ORDER} || ',' || CASE WHEN event_type = 'purchase' THEN 'tx' || event_id ELSE '' END
    || ',' || {_SECONDS}""")


def _from_log(name: str, log: str) -> str:
    return ORACLE[name].replace("FROM events", f"FROM ({log}) AS events")


ORACLE["parse_market_log"] = f"""SELECT user_id, event_type AS behavior, 'channel-' || ({_ITEM} % 4) AS channel,
    date_trunc('millisecond', ts) AS ts FROM events"""
ORACLE["login_fail_pair_from_log"] = _from_log("login_fail_pair", _LOGIN_LOG)
ORACLE["stream_login_fail_from_log"] = _from_log("login_fail_episode", _LOGIN_LOG)
ORACLE["order_status_from_log"] = _from_log("order_status", _ORDER_LOG)
_SIDES = """WITH p AS (SELECT 'tx' || user_id AS tx_id, user_id AS order_id, date_trunc('second', ts) AS pay_ts
  FROM events WHERE event_type = 'purchase'),
r AS (SELECT 'tx' || user_id AS tx_id, CASE WHEN event_id % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
    date_trunc('second', ts) AS receipt_ts FROM events WHERE event_type = 'click')"""
ORACLE["reconcile_from_log"] = f"""{_SIDES}
SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, pay_ts, receipt_ts, CASE WHEN receipt_ts IS NULL THEN 'pay_only'
    WHEN pay_ts IS NULL THEN 'receipt_only' ELSE 'matched' END AS status
FROM p FULL OUTER JOIN r ON {_IN_REACH}"""
ORACLE["interval_join_from_log"] = f"""{_SIDES}
SELECT p.tx_id, order_id, pay_ts, pay_channel, receipt_ts FROM p JOIN r ON {_IN_REACH}"""
ORACLE["uv_sliding_approx"] = f"SELECT DISTINCT window_end, TRUE AS close FROM ({_HOT_ITEMS}) AS h"
ORACLE["stream_uv_sliding_approx"] = ORACLE["uv_sliding_approx"]
ORACLE["uv_daily_approx"] = f"""SELECT DISTINCT date_trunc('day', ts) + INTERVAL '1 day' AS window_end, TRUE AS close
FROM events WHERE {_PV}"""
