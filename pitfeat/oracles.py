"""DuckDB SQL equivalents of the registered queries (same names, same columns).

Conventions (SURVEY 5): money as DECIMAL(18,2) until the end, then DOUBLE;
averages as DOUBLE(sum) / DOUBLE(count); counts as BIGINT; windows as RANGE
frames over a day number.
"""

from __future__ import annotations

from itertools import combinations
from math import factorial

# -- shared fixture CTEs (FIXTURES.md part 2) --------------------------------
TXN_ORDERS = """txn_orders AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS account_id,
         CAST(o_orderdate AS DATE) AS txn_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         o_orderpriority = '1-URGENT' AS label, o_orderstatus <> 'P' AS card_present
  FROM orders)"""

ROLLUPS = """rollup_daily AS (
  SELECT account_id, txn_date, SUM(amount) AS s,
         MAX(CASE WHEN amount > 0 THEN 1 ELSE 0 END) AS a,
         datediff('day', DATE '1970-01-01', txn_date) AS g
  FROM txn_orders GROUP BY account_id, txn_date),
rollups AS (
  SELECT account_id, txn_date AS date,
    CAST(SUM(s) OVER (PARTITION BY account_id ORDER BY g RANGE BETWEEN 13 PRECEDING AND CURRENT ROW) AS DOUBLE) AS "14_day_total",
    CAST(SUM(s) OVER (PARTITION BY account_id ORDER BY g RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS "7_day_total",
    CAST(SUM(a) OVER (PARTITION BY account_id ORDER BY g RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS "7_day_transaction_count"
  FROM rollup_daily)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["rolling_7_14"] = with_(TXN_ORDERS, ROLLUPS) + "SELECT * FROM rollups"

TXN_LINES = """txn_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS account_id,
         l_suppkey AS merchant_id, CAST(o_orderdate AS DATE) AS txn_date,
         CAST(l_shipdate AS DATE) AS ship_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_linenumber AS pos_entry_mode,
         l_returnflag = 'R' AS label, l_linestatus = 'F' AS card_present
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EOL = """eol AS (
  SELECT transaction_id, CAST(account_id AS BIGINT) AS primary_account_number,
         CAST(merchant_id AS BIGINT) AS merchant_id, txn_date AS observation_date,
         label, CAST(amount AS DOUBLE) AS amount
  FROM txn_lines WHERE card_present)"""

MERCHANTS = """merchants AS (
  SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
         CAST(s_nationkey AS BIGINT) AS merchant_zone
  FROM supplier WHERE s_suppkey % 10 <> 0)"""

ACCOUNTS = """accounts AS (
  SELECT account_id, account_name, version,
         CAST((c_nationkey + 7 * version) % 25 AS BIGINT) AS zone,
         DATE '1995-01-01' + CAST(CASE WHEN version = 0 THEN 0
                                       ELSE version * 700 + account_id % 97 END AS INTEGER) AS valid_from,
         CASE WHEN version < account_id % 3
              THEN DATE '1995-01-01' + CAST((version + 1) * 700 + account_id % 97 AS INTEGER) END AS valid_to,
         CAST(version = account_id % 3 AS BIGINT) AS is_current
  FROM (SELECT c_custkey AS account_id, c_name AS account_name, c_nationkey,
               UNNEST(generate_series(0, c_custkey % 3)) AS version FROM customer))"""

REQUESTS = """requests AS (
  SELECT primary_account_number, merchant_id, DATE '2000-06-15' AS observation_date, amount
  FROM eol WHERE observation_date = '2000-06-15')"""

DIST = "CAST(1 + ((7919 * {a} + 104729 * {b}) % 250) AS DOUBLE)"


def asof_rollups(spine: str, out: str) -> str:
    """As-of join of a spine CTE with rollups on (primary_account_number, observation_date)."""
    return f"""{out} AS (
  SELECT * EXCLUDE (__rid, __rn) FROM (
    SELECT s.*, r."14_day_total", r."7_day_total", r."7_day_transaction_count",
           row_number() OVER (PARTITION BY s.__rid ORDER BY r.date DESC NULLS LAST) AS __rn
    FROM (SELECT *, row_number() OVER () AS __rid FROM {spine}) s
    LEFT JOIN rollups r ON r.account_id = s.primary_account_number AND r.date <= s.observation_date)
  WHERE __rn = 1)"""


def asof_accounts(spine: str, out: str, cols: str = "a.zone, a.account_name") -> str:
    return f"""{out} AS (
  SELECT * EXCLUDE (__rid, __rn) FROM (
    SELECT s.*, {cols},
           row_number() OVER (PARTITION BY s.__rid ORDER BY a.valid_from DESC NULLS LAST,
                              (a.valid_to IS NULL) DESC, a.valid_to DESC) AS __rn
    FROM (SELECT *, row_number() OVER () AS __rid FROM {spine}) s
    LEFT JOIN accounts a ON a.account_id = s.primary_account_number AND a.valid_from <= s.observation_date)
  WHERE __rn = 1)"""


ORACLES["spine_view"] = with_(TXN_LINES, EOL) + "SELECT * FROM eol"
ORACLES["request_day"] = with_(TXN_LINES, EOL, REQUESTS) + "SELECT * FROM requests"
ORACLES["date_bounds"] = with_(TXN_LINES) + "SELECT max(txn_date) AS max, min(txn_date) AS min FROM txn_lines"
ORACLES["daily_totals"] = with_(TXN_LINES) + """SELECT account_id, txn_date,
  CAST(SUM(amount) AS DOUBLE) AS daily_total,
  CAST(MAX(CASE WHEN amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS transaction_occurred
FROM txn_lines GROUP BY account_id, txn_date"""
ORACLES["lookup_exact"] = with_(TXN_LINES, EOL, MERCHANTS) + """SELECT e.*, m.merchant_name, m.merchant_zone
FROM eol e LEFT JOIN merchants m ON e.merchant_id = m.merchant_id"""
ORACLES["lookup_asof_features"] = with_(
    TXN_ORDERS, ROLLUPS, TXN_LINES,
    """ship AS (SELECT transaction_id, account_id AS primary_account_number,
                ship_date AS observation_date FROM txn_lines)""",
    asof_rollups("ship", "out")) + "SELECT * FROM out"
ORACLES["lookup_asof_scd2"] = with_(TXN_LINES, EOL, ACCOUNTS, asof_accounts("eol", "out")) + "SELECT * FROM out"
ORACLES["lookup_asof_scd2_broadcast"] = ORACLES["lookup_asof_scd2"]
ORACLES["lookup_interval"] = with_(TXN_LINES, EOL, ACCOUNTS) + """SELECT e.*, a.zone, a.account_name
FROM eol e LEFT JOIN accounts a ON a.account_id = e.primary_account_number
  AND a.valid_from <= e.observation_date AND (a.valid_to IS NULL OR e.observation_date < a.valid_to)"""

FRAUD = [TXN_ORDERS, ROLLUPS, TXN_LINES, EOL, MERCHANTS, ACCOUNTS,
         asof_rollups("eol", "f1"),
         """f2 AS (SELECT f1.*, m.merchant_zone FROM f1 LEFT JOIN merchants m ON f1.merchant_id = m.merchant_id)""",
         asof_accounts("f2", "f3", "a.zone"),
         f"""f4 AS (SELECT *, {DIST.format(a='zone', b='merchant_zone')} AS merchant_distance_from_home FROM f3)"""]

ORACLES["function_feature"] = with_(
    TXN_LINES, EOL, MERCHANTS, ACCOUNTS,
    """g2 AS (SELECT e.*, m.merchant_zone FROM eol e LEFT JOIN merchants m ON e.merchant_id = m.merchant_id)""",
    asof_accounts("g2", "g3", "a.zone")) + f"""SELECT *, {DIST.format(a='zone', b='merchant_zone')}
  AS merchant_distance_from_home FROM g3"""
ORACLES["training_set"] = with_(*FRAUD) + """SELECT primary_account_number, amount, "14_day_total", "7_day_total",
  "7_day_transaction_count", merchant_distance_from_home, CAST(label AS DOUBLE) AS label FROM f4"""
ORACLES["inference_set"] = with_(*FRAUD) + """SELECT primary_account_number, merchant_id, amount, "14_day_total",
  "7_day_total", "7_day_transaction_count", merchant_distance_from_home, CAST(label AS DOUBLE) AS label FROM f4"""

# -- windowed aggregates: a range join of points with daily partials ---------
TXN_EVENTS = """txn_events AS (
  SELECT event_id AS transaction_id, user_id AS account_id, ts, CAST(ts AS DATE) AS txn_date,
         CAST(value AS DECIMAL(18,2)) AS amount
  FROM events WHERE event_type = 'purchase')"""


def daily_sql(name: str, src: str, col: str = "amount") -> str:
    return f"""{name} AS (
  SELECT account_id AS k, datediff('day', DATE '1970-01-01', txn_date) AS g,
         SUM({col}) AS s, COUNT({col}) AS c, MIN({col}) AS mn, MAX({col}) AS mx,
         MAX(CASE WHEN {col} > 0 THEN 1 ELSE 0 END) AS a
  FROM {src} WHERE account_id IS NOT NULL AND txn_date IS NOT NULL GROUP BY 1, 2)"""


def frame(d: int, o: int = 0, closed: str = "right") -> tuple[int, int]:
    """Days back (lo, hi) covered: closed right is [p-o-d+1, p-o], closed left [p-o-d, p-o-1]."""
    return (o + d - 1, o) if closed == "right" else (o + d, o + 1)


def feat_expr(name: str, fn: str, d: int, o: int = 0, closed: str = "right") -> str:
    lo, hi = frame(d, o, closed)
    inside = f"x.g BETWEEN p.p - {lo} AND p.p - {hi}"
    if fn == "sum":
        return f'CAST(SUM(CASE WHEN {inside} THEN x.s END) AS DOUBLE) AS "{name}"'
    if fn == "count":
        return f'CAST(COALESCE(SUM(CASE WHEN {inside} THEN x.c END), 0) AS BIGINT) AS "{name}"'
    if fn == "active_days":
        return f'CAST(COALESCE(SUM(CASE WHEN {inside} THEN x.a END), 0) AS BIGINT) AS "{name}"'
    if fn == "min":
        return f'CAST(MIN(CASE WHEN {inside} THEN x.mn END) AS DOUBLE) AS "{name}"'
    if fn == "max":
        return f'CAST(MAX(CASE WHEN {inside} THEN x.mx END) AS DOUBLE) AS "{name}"'
    if fn == "avg":
        s = f"CAST(SUM(CASE WHEN {inside} THEN x.s END) AS DOUBLE)"
        c = f"CAST(SUM(CASE WHEN {inside} THEN x.c END) AS DOUBLE)"
        return f'CASE WHEN {c} > 0 THEN {s} / {c} END AS "{name}"'
    raise ValueError(fn)


def feats_sql(name: str, points: str, daily: str, feats: list[tuple]) -> str:
    """``points`` has (k, d); output (k, d, features...) for each distinct point."""
    reach = max(frame(*f[2:])[0] for f in feats)
    exprs = ",\n    ".join(feat_expr(*f) for f in feats)
    return f"""{name} AS (
  SELECT p.k, p.d, {exprs}
  FROM (SELECT DISTINCT k, d, datediff('day', DATE '1970-01-01', d) AS p FROM {points}
        WHERE k IS NOT NULL AND d IS NOT NULL) p
  LEFT JOIN {daily} x ON x.k = p.k AND x.g BETWEEN p.p - {reach} AND p.p
  GROUP BY p.k, p.d)"""


def names(feats: list[tuple]) -> str:
    return ", ".join(f'f."{f[0]}"' for f in feats)


def spine_feats(spine: str, feats: list[tuple], daily: str, out: str) -> str:
    return (feats_sql("__fx", f"(SELECT primary_account_number AS k, observation_date AS d FROM {spine})",
                      daily, feats)
            + f""",
{out} AS (SELECT s.*, {names(feats).replace('f.', 'fx.')} FROM {spine} s
  LEFT JOIN __fx fx ON fx.k = s.primary_account_number AND fx.d = s.observation_date)""")


def facts_feats(src: str, daily: str, feats: list[tuple], key: str = "account_id",
                time: str = "txn_date") -> str:
    return (feats_sql("__fx", f"(SELECT account_id AS k, txn_date AS d FROM {src})", daily, feats)
            + f'\nSELECT f.k AS {key}, f.d AS {time}, {names(feats)} FROM __fx f')


SEARCH_FEATS = [
    ("amount_avg_15d", "avg", 15), ("amount_sum_15d", "sum", 15),
    ("amount_avg_30d", "avg", 30), ("amount_sum_30d", "sum", 30),
    ("amount_avg_5d_offset_5d", "avg", 5, 5), ("amount_sum_5d_offset_5d", "sum", 5, 5),
    ("amount_avg_5d_offset_10d", "avg", 5, 10), ("amount_sum_5d_offset_10d", "sum", 5, 10),
    ("amount_avg_10d_offset_5d", "avg", 10, 5), ("amount_sum_10d_offset_5d", "sum", 10, 5),
    ("amount_avg_10d_offset_10d", "avg", 10, 10), ("amount_sum_10d_offset_10d", "sum", 10, 10),
]

SEARCH_CTES = [TXN_LINES, EOL, daily_sql("dl", "txn_lines"), spine_feats("eol", SEARCH_FEATS, "dl", "ss")]
ORACLES["search_space_12"] = with_(*SEARCH_CTES) + "SELECT * FROM ss"

ORACLES["window_avg_sum"] = "WITH " + ",\n".join([TXN_EVENTS, daily_sql("de", "txn_events")]) + ",\n" + \
    facts_feats("txn_events", "de", [("amount_avg_30d", "avg", 30), ("amount_sum_30d", "sum", 30)])
ORACLES["window_offset_sum"] = "WITH " + ",\n".join([TXN_EVENTS, daily_sql("de", "txn_events")]) + ",\n" + \
    facts_feats("txn_events", "de", [("amount_sum_5d_offset_2d", "sum", 5, 2)])
ORACLES["window_count"] = "WITH " + ",\n".join([TXN_EVENTS, daily_sql("de", "txn_events")]) + ",\n" + \
    facts_feats("txn_events", "de", [("amount_count_7d", "count", 7), ("amount_active_days_7d", "active_days", 7),
                                     ("amount_min_7d", "min", 7), ("amount_max_7d", "max", 7)])
ORACLES["window_closed_left"] = with_(
    TXN_LINES, EOL, daily_sql("dl", "txn_lines"),
    spine_feats("eol", [("amount_sum_7d", "sum", 7), ("amount_sum_7d_excl", "sum", 7, 0, "left"),
                        ("amount_count_7d", "count", 7), ("amount_count_7d_excl", "count", 7, 0, "left")],
                "dl", "out")) + "SELECT * FROM out"

ORACLES["aggregate_grid"] = "WITH " + ",\n".join([
    TXN_EVENTS, daily_sql("de", "txn_events"),
    """grid AS (SELECT k, CAST(unnest(generate_series(TIMESTAMP '2023-01-01',
                 (SELECT CAST(max(txn_date) AS TIMESTAMP) FROM txn_events), INTERVAL 1 DAY)) AS DATE) AS d
               FROM (SELECT DISTINCT account_id AS k FROM txn_events WHERE account_id IS NOT NULL
                     AND txn_date IS NOT NULL))""",
    feats_sql("__fx", "grid", "de", [("amount_avg_30d", "avg", 30), ("amount_sum_5d_offset_2d", "sum", 5, 2)]),
]) + '\nSELECT k AS account_id, d AS txn_date, "amount_avg_30d", "amount_sum_5d_offset_2d" FROM __fx'

ORACLES["attach_aggregates"] = with_(
    TXN_LINES, EOL, daily_sql("dl", "txn_lines"),
    feats_sql("agg", "(SELECT account_id AS k, txn_date AS d FROM txn_lines)", "dl",
              [("amount_avg_15d", "avg", 15), ("amount_sum_15d", "sum", 15)])) + """SELECT e.*,
  agg.amount_avg_15d, agg.amount_sum_15d FROM eol e
  LEFT JOIN agg ON e.primary_account_number = agg.k AND e.observation_date = agg.d"""

ORACLES["dense_rollups"] = "WITH " + ",\n".join([
    TXN_ORDERS, ACCOUNTS, daily_sql("do_", "txn_orders"),
    """grid AS (SELECT k, CAST(unnest(generate_series(CAST(s AS TIMESTAMP),
                 (SELECT CAST(max(txn_date) AS TIMESTAMP) FROM txn_orders), INTERVAL 1 DAY)) AS DATE) AS d
               FROM (SELECT account_id AS k, min(valid_from) AS s FROM accounts GROUP BY 1))""",
    feats_sql("__fx", "grid", "do_", [("14_day_total", "sum", 14), ("7_day_total", "sum", 7),
                                      ("7_day_transaction_count", "active_days", 7)]),
]) + """
SELECT k AS customer_id, d AS date, COALESCE("14_day_total", 0.0) AS "14_day_total",
  COALESCE("7_day_total", 0.0) AS "7_day_total", "7_day_transaction_count" FROM __fx"""

WIDE = [TXN_ORDERS, *SEARCH_CTES, MERCHANTS, ACCOUNTS,
        """w2 AS (SELECT ss.*, m.merchant_zone FROM ss LEFT JOIN merchants m ON ss.merchant_id = m.merchant_id)""",
        asof_accounts("w2", "w3", "a.zone"),
        f"""w4 AS (SELECT *, {DIST.format(a='zone', b='merchant_zone')} AS merchant_distance_from_home FROM w3)"""]
WIDE_COLS = ", ".join(f'"{f[0]}"' for f in SEARCH_FEATS)
ORACLES["training_set_wide"] = with_(*WIDE) + f"""SELECT primary_account_number, amount, {WIDE_COLS},
  merchant_distance_from_home, CAST(label AS DOUBLE) AS label FROM w4
WHERE {' AND '.join(f'"{f[0]}" IS NOT NULL' for f in SEARCH_FEATS)}
  AND merchant_distance_from_home IS NOT NULL AND primary_account_number IS NOT NULL
  AND amount IS NOT NULL AND label IS NOT NULL"""
ORACLES["training_set_defaults"] = with_(*WIDE) + "SELECT primary_account_number, amount, " + ", ".join(
    f'COALESCE("{f[0]}", 0.0) AS "{f[0]}"' for f in SEARCH_FEATS) + """,
  COALESCE(merchant_distance_from_home, -1.0) AS merchant_distance_from_home,
  CAST(label AS DOUBLE) AS label FROM w4"""

ORACLES["build_scd2"] = """SELECT user_id AS account_id, event_id AS change_id,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS zip, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
  CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS BIGINT) AS is_current
FROM events WHERE event_type = 'signup' AND user_id IS NOT NULL AND ts IS NOT NULL"""
ORACLES["latest_snapshot"] = with_(TXN_ORDERS, ROLLUPS) + """SELECT * EXCLUDE (__rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date DESC) AS __rn FROM rollups) WHERE __rn = 1"""
ORACLES["violations_unique"] = with_(TXN_LINES) + """SELECT transaction_id, COUNT(*) AS n FROM txn_lines
GROUP BY transaction_id HAVING COUNT(*) > 1"""
ORACLES["violations_not_null"] = with_(ACCOUNTS) + """
SELECT 'account_id' AS column_name, CAST(COUNT(*) - COUNT(account_id) AS BIGINT) AS null_rows, COUNT(*) AS total_rows FROM accounts
UNION ALL SELECT 'valid_from', CAST(COUNT(*) - COUNT(valid_from) AS BIGINT), COUNT(*) FROM accounts
UNION ALL SELECT 'valid_to', CAST(COUNT(*) - COUNT(valid_to) AS BIGINT), COUNT(*) FROM accounts"""
ORACLES["orphans"] = with_(TXN_LINES, MERCHANTS) + """SELECT transaction_id, account_id, merchant_id, txn_date
FROM txn_lines t WHERE merchant_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = t.merchant_id)"""
ORACLES["flatten_array"] = with_(ACCOUNTS) + "SELECT * FROM accounts"
ORACLES["account_age_365"] = with_(TXN_ORDERS) + """, m AS (
  SELECT account_id, min(txn_date) AS member_since, (SELECT max(txn_date) FROM txn_orders) AS as_of
  FROM txn_orders GROUP BY account_id),
y AS (SELECT *, CAST(floor(datediff('day', member_since, as_of) / 365.0) AS BIGINT) AS member_years FROM m)
SELECT account_id, member_since, as_of, member_years,
  member_since + CAST(member_years * 365 AS INTEGER) AS last_anniversary,
  as_of - CAST(member_years * 365 AS INTEGER) AS window_start,
  member_years * 50 AS expected_transactions FROM y"""
ORACLES["request_struct"] = ORACLES["request_day"]
PMOD = "((({x}) % {n}) + {n}) % {n}"
SPLIT_BUCKET = PMOD.format(x=PMOD.format(x=PMOD.format(x="primary_account_number + 0", n=2147483647)
                                         + " * 48271", n=2147483647), n=10000)
ORACLES["split_hash"] = with_(TXN_LINES, EOL) + f"""SELECT *,
  CASE WHEN {SPLIT_BUCKET} < 8000 THEN 'train' ELSE 'test' END AS split FROM eol"""
ORACLES["spec_override"] = with_(
    TXN_LINES, MERCHANTS, ACCOUNTS,
    """req AS (SELECT CAST(account_id AS BIGINT) AS primary_account_number, merchant_id, txn_date AS observation_date,
         CAST(amount AS DOUBLE) AS amount,
         CAST(CASE WHEN pos_entry_mode = 1 THEN merchant_id % 25 END AS BIGINT) AS merchant_zone
       FROM txn_lines WHERE card_present)""",
    """r2 AS (SELECT r.* EXCLUDE (merchant_zone), COALESCE(r.merchant_zone, m.merchant_zone) AS merchant_zone
       FROM req r LEFT JOIN merchants m ON r.merchant_id = m.merchant_id)""",
    asof_accounts("r2", "r3", "a.zone")) + f"""SELECT *, {DIST.format(a='zone', b='merchant_zone')}
  AS merchant_distance_from_home FROM r3"""

ORACLES["override_function"] = with_(
    "s AS (" + ORACLES["spec_override"] + ")") + """SELECT * EXCLUDE (merchant_distance_from_home),
  CASE WHEN merchant_id % 2 = 0 THEN -1 ELSE merchant_distance_from_home END AS merchant_distance_from_home FROM s"""

ORACLES["rollups_rounded"] = with_("""txn_orders AS (
  SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) AS txn_date,
         CAST(COALESCE(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2), 0)
              AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""", ROLLUPS) + """
SELECT account_id, date, ROUND("14_day_total", 2) AS "14_day_total", ROUND("7_day_total", 2) AS "7_day_total" FROM rollups"""

ORACLES["stream_publish_latest"] = ORACLES["latest_snapshot"]
ORACLES["stream_enrich"] = """WITH p AS (
  SELECT event_id AS transaction_id, user_id AS account_id, ts,
         CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
         row_number() OVER () AS __rid
  FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id AS account_id, event_id AS change_id, ts AS valid_from,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS zip
      FROM events WHERE event_type = 'signup' AND user_id IS NOT NULL AND ts IS NOT NULL)
SELECT transaction_id, account_id, ts, amount, zip FROM (
  SELECT p.*, s.zip, row_number() OVER (PARTITION BY p.__rid ORDER BY s.valid_from DESC NULLS LAST,
                                        s.change_id DESC NULLS LAST) AS __rn
  FROM p LEFT JOIN s ON s.account_id = p.account_id AND s.valid_from <= p.ts)
WHERE __rn = 1"""
ORACLES["stream_rolling"] = """WITH p AS (
  SELECT user_id AS account_id, ts, CAST(value AS DECIMAL(18,2)) AS amount
  FROM events WHERE event_type = 'purchase'),
w AS (SELECT account_id, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, amount
      FROM p, range(0, 7) r(k))
SELECT account_id, window_start, window_start + INTERVAL 7 DAY AS window_end,
       CAST(SUM(amount) AS DOUBLE) AS amount_sum, COUNT(amount) AS amount_count
FROM w GROUP BY account_id, window_start"""

# Approximate distinct counts: an HLL sketch keeps exact coupons while a set is
# small (here at most a few dozen merchants per 30-day window), so its
# estimate equals COUNT(DISTINCT) at these cardinalities.
ORACLES["window_approx_distinct"] = with_(
    TXN_LINES, EOL,
    """pts AS (SELECT DISTINCT primary_account_number AS k, observation_date AS d,
             datediff('day', DATE '1970-01-01', observation_date) AS p FROM eol
             WHERE primary_account_number IS NOT NULL AND observation_date IS NOT NULL)""",
    """lines AS (SELECT account_id AS k, datediff('day', DATE '1970-01-01', txn_date) AS g, merchant_id
               FROM txn_lines)""",
    """fx AS (SELECT pts.k, pts.d, COUNT(DISTINCT lines.merchant_id) AS n FROM pts LEFT JOIN lines
            ON lines.k = pts.k AND lines.g BETWEEN pts.p - 29 AND pts.p GROUP BY pts.k, pts.d)""") + """
SELECT e.*, CAST(fx.n AS BIGINT) AS merchant_id_approx_count_distinct_30d FROM eol e
LEFT JOIN fx ON fx.k = e.primary_account_number AND fx.d = e.observation_date"""

ORACLES["enrich_batch"] = ORACLES["stream_enrich"]

ORACLES["window_hourly"] = with_(TXN_EVENTS, """hd AS (
  SELECT account_id AS k, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h, SUM(amount) AS s, COUNT(amount) AS c
  FROM txn_events WHERE account_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)""") + """
SELECT p.k AS account_id, make_timestamp(p.h * 3600 * 1000000) AS ts,
  CAST(SUM(CASE WHEN x.h BETWEEN p.h - 5 AND p.h THEN x.s END) AS DOUBLE) AS amount_sum_6h,
  CAST(COALESCE(SUM(CASE WHEN x.h BETWEEN p.h - 23 AND p.h THEN x.c END), 0) AS BIGINT) AS amount_count_24h,
  CASE WHEN SUM(CASE WHEN x.h BETWEEN p.h - 3 AND p.h - 1 THEN x.c END) > 0 THEN
    CAST(SUM(CASE WHEN x.h BETWEEN p.h - 3 AND p.h - 1 THEN x.s END) AS DOUBLE)
    / CAST(SUM(CASE WHEN x.h BETWEEN p.h - 3 AND p.h - 1 THEN x.c END) AS DOUBLE) END AS amount_avg_3h_offset_1h
FROM (SELECT DISTINCT k, h FROM hd) p JOIN hd x ON x.k = p.k AND x.h BETWEEN p.h - 23 AND p.h
GROUP BY p.k, p.h"""

ORACLES["violations_versions"] = """WITH v AS (
  SELECT event_id AS change_id, user_id AS account_id, ts AS changed_at, CAST(json_extract_string(props, '$.k') AS BIGINT) AS zip,
         ts + INTERVAL 5 DAY AS valid_to, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_valid_from
  FROM events WHERE event_type = 'signup' AND user_id IS NOT NULL AND ts IS NOT NULL)
SELECT * FROM v WHERE valid_to > next_valid_from"""

ORACLES["stream_partials_rolling"] = ORACLES["window_avg_sum"]

ORACLES["violations_timeseries_key"] = with_(TXN_LINES) + """SELECT account_id, txn_date, COUNT(*) AS n
FROM txn_lines GROUP BY account_id, txn_date HAVING COUNT(*) > 1"""

ORACLES["view_spine"] = ORACLES["spine_view"]
ORACLES["saved_training_set"] = ORACLES["training_set"]
ORACLES["input_example"] = "SELECT * FROM (" + ORACLES["training_set"] + ") ORDER BY ALL ASC NULLS FIRST LIMIT 2"
ORACLES["chained_lookup"] = with_(
    ACCOUNTS, """lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_shipdate AS DATE) AS observation_date,
         o_custkey AS primary_account_number FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)""",
    asof_accounts("lines", "zoned", "a.zone")) + """SELECT z.*, n_name AS zone_name FROM zoned z
LEFT JOIN nation ON n_nationkey = z.zone"""
ORACLES["stream_publish_merchants"] = with_(MERCHANTS) + "SELECT * FROM merchants"

SCORED = ", true AS score_in_range, true AS prediction_by_score FROM "
ORACLES["score_batch"] = with_(*FRAUD[:4], REQUESTS, *FRAUD[4:6], asof_rollups("requests", "f1"), *FRAUD[7:]) + "SELECT *" + SCORED + "f4"
ORACLES["score_supplied"] = "SELECT *" + SCORED + "(" + ORACLES["inference_set"] + ")"

ORACLES["select_features"] = f"""SELECT unnest({[f[0] for f in SEARCH_FEATS]}) AS feature, true AS rank_in_permutation,
  true AS selected_by_rank, true AS else_eliminated, true AS scores_in_range"""

ORACLES["lookup_interval_join"] = ORACLES["lookup_interval"]

FRAUD_STRICT = [c.replace("r.date <= s.observation_date", "r.date < s.observation_date") for c in FRAUD]
ORACLES["training_set_strict"] = with_(*FRAUD_STRICT) + """SELECT primary_account_number, amount, "14_day_total",
  "7_day_total", "7_day_transaction_count", merchant_distance_from_home, CAST(label AS DOUBLE) AS label FROM f4"""

# -- models --------------------------------------------------------------------


def tree_value(nodes, known: frozenset, names, at: int = 0) -> str:
    """A tree's value with only some features known: splits on the others average their children by cover."""
    f, t, left, right, value, cover = nodes[at]
    if left < 0:
        return f"CAST({value!r} AS DOUBLE)"
    a, b = tree_value(nodes, known, names, left), tree_value(nodes, known, names, right)
    if f in known:
        return f"CASE WHEN {names[f]} <= {t!r} THEN {a} ELSE {b} END"
    return f"({nodes[left][5] / cover!r} * {a} + {nodes[right][5] / cover!r} * {b})"


def shapley_sql(trees, weights, names, feature: int) -> str:
    """The Shapley value by its definition: gains over all coalitions of the other features."""
    others, n = [i for i in range(len(names)) if i != feature], len(names)
    terms = []
    for nodes, w in zip(trees, weights):
        for size in range(n):
            share = w * factorial(size) * factorial(n - size - 1) / factorial(n)
            for coalition in combinations(others, size):
                with_, without = (tree_value(nodes, frozenset(c), names) for c in ((*coalition, feature), coalition))
                terms.append(f"{share!r} * ({with_} - {without})")
    return " + ".join(terms)


def shap_oracle() -> str:
    from .workloads import CHECK_TREES, CHECK_WEIGHTS
    names = ("l_quantity", "l_extendedprice", "l_discount")
    cols = [f"round({shapley_sql(CHECK_TREES, CHECK_WEIGHTS, names, i)}, 9) + 0.0 AS shap_{n}" for i, n in enumerate(("quantity", "price", "discount"))]
    margin = " + ".join(f"{w!r} * {tree_value(t, frozenset(range(3)), names)}" for t, w in zip(CHECK_TREES, CHECK_WEIGHTS))
    return f"SELECT l_orderkey, l_linenumber, {', '.join(cols)}, round({margin}, 9) + 0.0 AS margin FROM lineitem"


ORACLES["tree_shap"] = shap_oracle()


def binned_tree_ctes(train: str, inputs, bins: int = 32, weight: str = "1") -> list[str]:
    """CTEs that fit a tree of two levels on the CTE ``train`` (label, inputs): the split of node 1, 2 and 3, and leaves' shares."""
    q = [f'"{f}"' for f in inputs]
    ends = ", ".join(f"min(CAST({f} AS DOUBLE)) AS a{i}, max(CAST({f} AS DOUBLE)) AS b{i}" for i, f in enumerate(q))
    out = [f"ends AS (SELECT {ends} FROM {train} WHERE label IS NOT NULL)",
           f"binned AS (SELECT CAST(label AS BIGINT) * {weight} AS y, {weight} AS w, " + ", ".join(f"{binned_sql(f, i, bins)} AS f{i}" for i, f in enumerate(q))
           + f" FROM {train} CROSS JOIN ends WHERE label IS NOT NULL)"]

    def best(name: str, rows: str) -> str:
        hist = " UNION ALL ".join(f"SELECT {i} AS f, f{i} AS bin, sum(w) AS n, sum(y) AS p FROM {rows} GROUP BY f{i}" for i in range(len(q)))
        purity = lambda p, n: f"(CAST({p} AS DOUBLE) * {p} + CAST({n} - {p} AS DOUBLE) * ({n} - {p})) / {n}"
        return f"""{name} AS (
  SELECT f, bin FROM (
    SELECT *, {purity('pl', 'nl')} + {purity('(p - pl)', '(n - nl)')} AS purity, {purity('p', 'n')} AS own FROM (
      SELECT f, bin, sum(n) OVER (PARTITION BY f ORDER BY bin) AS nl, sum(p) OVER (PARTITION BY f ORDER BY bin) AS pl,
             sum(n) OVER (PARTITION BY f) AS n, sum(p) OVER (PARTITION BY f) AS p FROM ({hist}))
    WHERE nl < n)
  WHERE purity > own ORDER BY purity DESC, f, bin LIMIT 1)"""

    def goes_left(split: str) -> str:
        return "CASE (SELECT f FROM " + split + ") " + " ".join(f"WHEN {i} THEN f{i}" for i in range(len(q))) + f" END <= (SELECT bin FROM {split})"

    out += [best("split1", "binned"), f"level2 AS (SELECT *, CASE WHEN {goes_left('split1')} THEN 2 ELSE 3 END AS node FROM binned)",
            best("split2", "(SELECT * FROM level2 WHERE node = 2)"), best("split3", "(SELECT * FROM level2 WHERE node = 3)")]
    leaf = (f"CASE WHEN {goes_left('split1')} THEN CASE WHEN (SELECT count(*) FROM split2) = 0 THEN 2 WHEN {goes_left('split2')} THEN 4 ELSE 5 END "
            f"ELSE CASE WHEN (SELECT count(*) FROM split3) = 0 THEN 3 WHEN {goes_left('split3')} THEN 6 ELSE 7 END END")
    out.append(f"leaves AS (SELECT {leaf} AS leaf, CAST(sum(y) AS DOUBLE) / sum(w) AS score FROM binned GROUP BY 1)")
    return [*out, leaf]


def binned_sql(column: str, i: int, bins: int) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return (f"CASE WHEN {column} IS NULL THEN -1 WHEN b{i} = a{i} THEN 0 "
            f"ELSE CAST(greatest(0, least(floor(({x} - a{i}) / ((b{i} - a{i}) / {bins})), {bins - 1})) AS INTEGER) END")


def binned_oracle(requests: list[str], name: str, weight: str = "1") -> str:
    """Rows of the CTE ``name`` with the score of the tree that is fitted on the training set."""
    from .workloads import TREE_INPUTS
    *ctes, leaf = binned_tree_ctes("train", TREE_INPUTS, weight=weight)
    cols = ", ".join(f'{binned_sql(chr(34) + f + chr(34), i, 32)} AS f{i}' for i, f in enumerate(TREE_INPUTS))
    drop = ", ".join(f"f{i}" for i in range(len(TREE_INPUTS)))
    ends = ", ".join(f"a{i}, b{i}" for i in range(len(TREE_INPUTS)))
    return ("WITH train AS (" + ORACLES["training_set"] + "),\n" + ",\n".join([*ctes, *requests])
            + f",\nasked AS (SELECT *, {cols} FROM {name} CROSS JOIN ends),\nplaced AS (SELECT *, {leaf} AS leaf FROM asked)\n"
            + f"SELECT p.* EXCLUDE ({drop}, {ends}, leaf), s.score, CAST(s.score > 0.5 AS DOUBLE) AS prediction "
            + "FROM placed p JOIN leaves s ON p.leaf = s.leaf")


ORACLES["score_binned_supplied"] = binned_oracle(["requested AS (" + ORACLES["inference_set"] + ")"], "requested")
ORACLES["score_binned_batch"] = binned_oracle(
    ["requested AS (" + with_(*FRAUD[:4], REQUESTS, *FRAUD[4:6], asof_rollups("requests", "f1"), *FRAUD[7:]) + "SELECT * FROM f4)"], "requested")

ORACLES["split_hash_text"] = """SELECT c_custkey, c_name,
  CASE WHEN CAST('0x' || substr(md5('0|' || c_name), 1, 13) AS BIGINT) % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
FROM customer"""

# -- hot keys, long windows, overlapping versions --------------------------------
ORACLES["build_scd2_hot"] = """SELECT CAST(1 AS BIGINT) AS account_id, event_id AS change_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS zip, ts AS valid_from,
  lead(ts) OVER (ORDER BY ts, event_id) AS valid_to,
  CAST(lead(ts) OVER (ORDER BY ts, event_id) IS NULL AS BIGINT) AS is_current
FROM events WHERE event_type = 'signup'"""
ORACLES["enrich_batch_hot"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT p.event_id AS transaction_id, p.user_id % 3 AS account_id, p.ts, CAST(p.value AS DOUBLE) AS amount, c.zip,
         row_number() OVER (PARTITION BY p.event_id ORDER BY c.ts DESC NULLS LAST, c.event_id DESC) AS rn
  FROM events p LEFT JOIN (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS zip FROM events WHERE event_type = 'signup') c
    ON c.user_id % 3 = p.user_id % 3 AND c.ts <= p.ts
  WHERE p.event_type = 'purchase') WHERE rn = 1"""
ORACLES["enrich_chunks"] = ORACLES["enrich_batch_hot"]
ORACLES["lookup_interval_overlapping"] = with_(TXN_LINES, """orders_open AS (
  SELECT account_id, transaction_id // 10 AS order_id, min(txn_date) AS placed, max(ship_date) AS closed
  FROM txn_lines GROUP BY account_id, transaction_id // 10)""") + """SELECT l.transaction_id, l.account_id, l.ship_date, CAST(o.order_id AS BIGINT) AS order_id
FROM txn_lines l LEFT JOIN orders_open o ON l.account_id = o.account_id AND o.placed <= l.ship_date AND l.ship_date < o.closed"""
ORACLES["window_long"] = with_(TXN_ORDERS, """d AS (
  SELECT account_id, txn_date, datediff('day', DATE '1970-01-01', txn_date) AS g, SUM(amount) AS s, count(amount) AS n,
         MAX(CASE WHEN amount > 0 THEN 1 ELSE 0 END) AS a
  FROM txn_orders GROUP BY account_id, txn_date)""") + """SELECT account_id, txn_date,
  CAST(SUM(s) OVER y AS DOUBLE) AS amount_sum_365d, CAST(SUM(s) OVER y AS DOUBLE) / CAST(SUM(n) OVER y AS DOUBLE) AS amount_avg_365d,
  CAST(SUM(n) OVER q AS BIGINT) AS amount_count_90d, CAST(SUM(s) OVER o AS DOUBLE) AS amount_sum_90d_offset_30d,
  CAST(COALESCE(SUM(a) OVER b, 0) AS BIGINT) AS active_365_before
FROM d WINDOW y AS (PARTITION BY account_id ORDER BY g RANGE BETWEEN 364 PRECEDING AND CURRENT ROW),
  q AS (PARTITION BY account_id ORDER BY g RANGE BETWEEN 89 PRECEDING AND CURRENT ROW),
  o AS (PARTITION BY account_id ORDER BY g RANGE BETWEEN 119 PRECEDING AND 30 PRECEDING),
  b AS (PARTITION BY account_id ORDER BY g RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)"""

LINE_DAYS = """line_days AS (SELECT DISTINCT merchant_id, datediff('day', DATE '1970-01-01', txn_date) AS g, txn_date, account_id FROM txn_lines),
line_points AS (SELECT DISTINCT merchant_id AS m, g AS p, txn_date FROM line_days),
line_sums AS (SELECT merchant_id, datediff('day', DATE '1970-01-01', txn_date) AS g, sum(amount) AS s FROM txn_lines GROUP BY ALL),
line_windows AS (SELECT merchant_id, g, CAST(SUM(s) OVER (PARTITION BY merchant_id ORDER BY g RANGE BETWEEN 364 PRECEDING AND CURRENT ROW) AS DOUBLE) AS amount_sum FROM line_sums)"""
ORACLES["window_distinct_checked"] = with_(TXN_LINES, LINE_DAYS) + """SELECT p.m AS merchant_id, p.txn_date,
  count(DISTINCT d.account_id) AS x0, count(DISTINCT CASE WHEN d.g BETWEEN p.p - 96 AND p.p - 7 THEN d.account_id END) AS x1,
  true AS near_0, true AS near_1, any_value(w.amount_sum) AS amount_sum
FROM line_points p JOIN line_days d ON d.merchant_id = p.m AND d.g BETWEEN p.p - 364 AND p.p
JOIN line_windows w ON w.merchant_id = p.m AND w.g = p.p GROUP BY p.m, p.txn_date"""
ORACLES["grid_refresh"] = ORACLES["aggregate_grid"]
ORACLES["expand_versions"] = with_(ACCOUNTS) + "SELECT account_id, account_name, CAST(version AS INTEGER) AS version, zone, valid_from, valid_to, is_current FROM accounts"
MERCHANT_STATES = MERCHANTS + """,
moved AS (SELECT merchant_id, merchant_name, merchant_zone + CASE WHEN merchant_id % 5 = 0 THEN 100 ELSE 0 END AS merchant_zone FROM merchants),
s0 AS (SELECT * FROM merchants WHERE merchant_id % 11 <> 1), s1 AS (SELECT * FROM moved WHERE merchant_id % 7 <> 0),
s2 AS (SELECT * FROM moved WHERE merchant_id % 14 <> 0)"""


def changes_sql(old: str, new: str, number: int) -> str:
    return f"""SELECT n.merchant_id, n.merchant_name, n.merchant_zone, 'upsert' AS change, CAST({number} AS BIGINT) AS change_number
FROM {new} n LEFT JOIN {old} o ON n.merchant_id = o.merchant_id
WHERE o.merchant_id IS NULL OR o.merchant_name <> n.merchant_name OR o.merchant_zone <> n.merchant_zone
UNION ALL SELECT merchant_id, NULL, NULL, 'delete', {number} FROM {old} WHERE merchant_id NOT IN (SELECT merchant_id FROM {new})"""


ORACLES["published_changes"] = with_(MERCHANT_STATES) + """SELECT *, 'upsert' AS change, CAST(0 AS BIGINT) AS change_number FROM s0
UNION ALL """ + changes_sql("s0", "s1", 1) + "\nUNION ALL " + changes_sql("s1", "s2", 2)
ORACLES["published_snapshot"] = with_(MERCHANT_STATES) + "SELECT * FROM s2"
ORACLES["stream_rolling_ring"] = ORACLES["stream_rolling"]
ORACLES["catalog_tables"] = with_(MERCHANTS) + """SELECT 'merchants' AS table_name, 'merchant_id,merchant_name,merchant_zone' AS columns,
  CAST(merchant_id AS BIGINT) AS id, merchant_name AS name FROM merchants
UNION ALL SELECT 'zones', 'n_nationkey,n_name', CAST(n_nationkey AS BIGINT), n_name FROM nation"""
ORACLES["local_zones"] = with_(MERCHANTS) + """SELECT *, CASE merchant_zone WHEN 0 THEN 'north' WHEN 1 THEN 'south' END AS zone_name FROM merchants"""
ORACLES["registered_function"] = with_(TXN_EVENTS, """d AS (
  SELECT account_id, txn_date, datediff('day', DATE '1970-01-01', txn_date) AS g, min(amount) AS lo, max(amount) AS hi
  FROM txn_events WHERE account_id IS NOT NULL AND txn_date IS NOT NULL GROUP BY account_id, txn_date)""") + """SELECT account_id, txn_date,
  CAST(max(hi) OVER w AS DOUBLE) - CAST(min(lo) OVER w AS DOUBLE) AS amount_spread_30d, CAST(max(hi) OVER w AS DOUBLE) AS amount_max_30d
FROM d WINDOW w AS (PARTITION BY account_id ORDER BY g RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)"""
ORACLES["weighted_tree"] = ("SELECT primary_account_number, amount, label, score FROM ("
                            + binned_oracle(["requested AS (" + ORACLES["training_set"] + ")"], "requested", "(CASE WHEN label = 1 THEN 5 ELSE 1 END)") + ")")
