"""DuckDB SQL for the queries of ``catalog_series``."""

from __future__ import annotations

from caldim.plans import catalog_series as S
from caldim.plans.catalog import AS_OF, PRIOR_AS_OF
from caldim.plans.oracle import FIN, FLAGS, MONEY, _base, _bounds, _d, _dim, _fin_only, _spine, _ts, _wc, _with


def to_date_all_days_sql() -> str:
    mmdd = "d.mmdd <= a.mmdd"
    rules = {
        "wtd": "d.wc = a.wc AND d.day <= a.day",
        "mtd": "d.month = a.month AND d.day <= a.day",
        "ptd": "d.fy = a.fy AND d.fp = a.fp AND d.day <= a.day",
        "qtd": "d.y = a.y AND d.q = a.q AND d.day <= a.day",
        "ytd": "d.y = a.y AND d.day <= a.day",
        "lw_wtd": f"{_wc('a.day - 7')} <= d.day AND d.day <= a.day - 7",
        "ly_wtd": f"{_wc('a.day - 364')} <= d.day AND d.day <= a.day - 364",
        "ly_ptd": f"d.fy = a.fy - 1 AND d.fp = a.fp AND {mmdd}",
        "ly_qtd": f"d.y = a.y - 1 AND d.q = a.q AND {mmdd}",
        "ly_ytd": f"d.y = a.y - 1 AND {mmdd}",
    }
    aggs = ",\n  ".join(
        f"CAST(coalesce(sum(CASE WHEN {rules[k]} THEN d.n END), 0) AS BIGINT) AS {k}_rows, "
        f"CAST(sum(CASE WHEN {rules[k]} THEN d.sales END) AS DOUBLE) AS {k}_sales"
        for k, _ in FLAGS
    )
    some = " OR ".join(f"({r})" for r in rules.values())
    return f"""{_fin_only(fixed=True)},
days AS (
  SELECT calendar_date AS day, {_wc('calendar_date')} AS wc, strftime(calendar_date, '%Y-%m') AS month,
         year(calendar_date) AS y, quarter(calendar_date) AS q, strftime(calendar_date, '%m%d') AS mmdd,
         CAST(financial_year AS INTEGER) AS fy, substr(financial_period, 8, 2) AS fp
  FROM fin),
daily AS (
  SELECT o_orderpriority, d.*, n, sales FROM (
    SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n, sum({MONEY.format('o_totalprice')}) AS sales
    FROM orders GROUP BY 1, 2) o JOIN days d USING (day))
SELECT d.o_orderpriority, a.day AS as_of,
  {aggs}
FROM days a JOIN daily d ON d.day <= a.day + 31 AND d.day > a.day - 800
WHERE a.day BETWEEN {_d(S.ALL_FIRST)} AND {_d(S.ALL_LAST)} AND ({some})
GROUP BY 1, 2"""


def customers_to_date_sql() -> str:
    parts = []
    for k, a in enumerate((AS_OF, PRIOR_AS_OF)):
        for flag, column in FLAGS:
            parts.append(f"""
SELECT {_d(a)} AS as_of, '{flag}' AS flag, o_orderpriority, count(*) AS n_rows,
       count(DISTINCT o_custkey) >= {S.MANY_CUSTOMERS} AS many,
       coalesce(count_if(o_totalprice < {S.PRICE_LIMIT}) * 2 >= count(o_totalprice) AND count(o_totalprice) > 0, false) AS half_below
FROM orders o JOIN dim{k} f ON CAST(o.o_orderdate AS DATE) = f.calendar_date WHERE f.{column} = 'YES' GROUP BY 3""")
    dims = [_dim(f"dim{k}", "base", a, "roll", S.dt.datetime(1998, 7, 15)) for k, a in enumerate((AS_OF, PRIOR_AS_OF))]
    ctes = _with(_bounds(True), _spine("spine", "start_d", "end_d"), FIN, _base("spine", "base"), *dims)
    return ctes + " UNION ALL ".join(parts)


def effective_sql() -> str:
    week, q = "CAST(substr(financial_week, 6, 2) AS INTEGER)", "financial_quarter"
    period = f"""(({q} - 1) * 3 + CASE WHEN {week} - ({q} - 1) * 13 <= 5 THEN 1 WHEN {week} - ({q} - 1) * 13 <= 9 THEN 2 ELSE 3 END)"""
    return f"""{_fin_only(fixed=True)},
restated AS (
  SELECT *, financial_year || '-P-' || lpad(CAST({period} AS VARCHAR), 2, '0') AS new_period FROM fin),
versions AS (
  SELECT calendar_date, financial_period, 1 AS version, (SELECT start_d FROM bounds) AS valid_from FROM fin
  UNION ALL
  SELECT calendar_date, new_period, 2, {_d(S.RESTATED_FROM)} FROM restated
  WHERE calendar_date >= {_d(S.RESTATED_FROM)} AND new_period <> financial_period),
o AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t, CAST(o_orderdate AS DATE) + {S.DELIVERY_DAYS} AS delivery_date
  FROM orders WHERE o_orderdate IS NOT NULL)
SELECT o_orderkey, CAST(delivery_date AS DATE) AS delivery_date, financial_period, CAST(version AS INTEGER) AS version, valid_from
FROM o ASOF LEFT JOIN versions v ON v.calendar_date = o.delivery_date AND o.t >= v.valid_from"""


def bands_sql() -> str:
    table = ", ".join(f"({'NULL' if g is None else repr(g)}, '{b}', {a}, {e})" for g, b, a, e in S.BANDS)
    inside = "CASE WHEN b.a < b.e THEN x.m >= b.a AND x.m < b.e ELSE x.m >= b.a OR x.m < b.e END"
    return f"""
WITH b(g, band, a, e) AS (VALUES {table}),
x AS (SELECT event_type, value, hour(ts) * 60 + minute(ts) AS m FROM events)
SELECT x.event_type, b.band, count(*) AS n_rows, CAST(sum({MONEY.format('value')}) AS DOUBLE) AS value_sum
FROM x LEFT JOIN b ON (b.g IS NULL OR b.g = x.event_type) AND {inside}
GROUP BY 1, 2"""


def gaps_sql(key: str, units: str) -> str:
    """``units`` selects key and unit number u."""
    return f"""
WITH u AS (SELECT DISTINCT k, CAST(u AS BIGINT) AS u FROM ({units}) WHERE u IS NOT NULL),
islands AS (
  SELECT k, min(u) AS a, max(u) AS e FROM (SELECT k, u, u - row_number() OVER (PARTITION BY k ORDER BY u) AS island FROM u) GROUP BY k, island),
gaps AS (SELECT *, lead(a) OVER (PARTITION BY k ORDER BY a) - e - 1 AS gap FROM islands)
SELECT k AS {key}, CAST(sum(e - a + 1) AS BIGINT) AS active, count(*) AS runs, max(e - a + 1) AS longest_run, count(gap) AS gaps,
       coalesce(max(gap), 0) AS longest_gap, arg_max(e + 1, (gap, -e)) FILTER (WHERE gap IS NOT NULL) AS longest_gap_from,
       min(a) AS first, max(e) AS last
FROM gaps GROUP BY k"""


def balance_sql() -> str:
    return f"""
WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum({MONEY.format('l_extendedprice')}) AS movement
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2),
days AS (
  SELECT l_suppkey, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily GROUP BY 1)
SELECT l_suppkey, day, CAST(coalesce(movement, 0) AS DOUBLE) AS movement,
       CAST(sum(movement) OVER w AS DOUBLE) AS balance, CAST(last_value(movement IGNORE NULLS) OVER w AS DOUBLE) AS last_movement
FROM days LEFT JOIN daily USING (l_suppkey, day) WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)"""


def maintained_sql() -> str:
    return f"""
SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, count(*) AS n_rows,
       CAST(sum(CAST(CASE WHEN o_orderkey % 50 = 1 AND CAST(o_orderdate AS DATE) < {_d(S.MARK_2)} THEN o_totalprice + 100 ELSE o_totalprice END
                     AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM orders WHERE NOT (o_orderkey % 50 = 0 AND CAST(o_orderdate AS DATE) < {_d(S.MARK_2)})
GROUP BY 1, 2"""


def batches_sql() -> str:
    d = "CAST(o_orderdate AS DATE)"
    m1, m2 = _d(S.MARK_1), _d(S.MARK_2)
    late = f"(o_orderkey % 10 = 3 AND {d} < {m1})"
    return f"""
WITH changes AS (
  SELECT 1 AS batch, {d} AS day, 1 AS sign, NULL AS mark FROM orders WHERE {d} < {m1} AND NOT {late}
  UNION ALL SELECT 2, {d}, 1, {m1} FROM orders WHERE {late} OR ({d} >= {m1} AND {d} < {m2})
  UNION ALL SELECT 3, {d}, 1, {m2} FROM orders WHERE {d} >= {m2} OR (o_orderkey % 50 = 1 AND {d} < {m2})
  UNION ALL SELECT 3, {d}, -1, {m2} FROM orders WHERE o_orderkey % 50 IN (0, 1) AND {d} < {m2})
SELECT CAST(batch AS INTEGER) AS batch, count_if(sign > 0) AS inserted, count_if(sign < 0) AS deleted,
       count_if(sign > 0 AND coalesce(day < mark, false)) AS late, count_if(day IS NULL) AS without_day, count(DISTINCT day) AS days
FROM changes GROUP BY batch"""


def sessions_sql() -> str:
    cut, late = _ts(S.STREAM_CUT), _ts(S.LATE_BEFORE)
    return f"""
WITH e AS (SELECT event_id, ts, user_id, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE ts IS NOT NULL),
breaks AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM breaks),
found AS (
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events, CAST(sum(value) AS DOUBLE) AS value_sum
  FROM numbered GROUP BY user_id, s)
SELECT 'session' AS kind, * FROM found WHERE session_end <= (SELECT max(ts) FROM e) - INTERVAL 2 HOUR
UNION ALL SELECT 'without_time', NULL, NULL, NULL, count(*), NULL FROM e WHERE ts >= {cut} AND event_id % 25 = 0
UNION ALL SELECT 'late', NULL, NULL, NULL, count(*), NULL FROM e WHERE ts < {late} AND event_id % 20 = 0
UNION ALL SELECT 'repeated', NULL, NULL, NULL, count(*), NULL FROM e WHERE (ts < {cut} AND event_id % 10 = 0) OR (ts >= {cut} AND event_id % 15 = 0)"""


def hierarchy_sql() -> str:
    levels = {
        "financial": ["fin_year", "fin_half", "fin_quarter", "fin_period", "fin_week"],
        "calendar": ["cal_year", "cal_quarter", "month", "day_name"],
    }
    columns = [c for cols in levels.values() for c in cols]
    parts = []
    for name, level, held in [("all", "all", []), *((n, c, cols[: k + 1]) for n, cols in levels.items() for k, c in enumerate(cols))]:
        shown = ", ".join(f"{c} AS {c}" if c in held else f"NULL AS {c}" for c in columns)
        group = f"GROUP BY {', '.join(held)}" if held else ""
        parts.append(f"SELECT '{name}' AS hierarchy, '{level}' AS level, {shown}, count(*) AS n_rows, CAST(sum(sales) AS DOUBLE) AS sales FROM rows {group}")
    return f"""{_fin_only(fixed=True)},
rows AS (
  SELECT f.financial_year AS fin_year, CASE WHEN f.financial_quarter <= 2 THEN 1 WHEN f.financial_quarter > 2 THEN 2 END AS fin_half,
         f.financial_quarter AS fin_quarter, f.financial_period AS fin_period, f.financial_week AS fin_week,
         CAST(year(d) AS INTEGER) AS cal_year, CAST(year(d) AS VARCHAR) || '0' || CAST(quarter(d) AS VARCHAR) AS cal_quarter,
         strftime(d, '%Y-%m') AS month, dayname(d) AS day_name, sales
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, {MONEY.format('o_totalprice')} AS sales FROM orders) o
  LEFT JOIN fin f ON f.calendar_date = o.d)
{" UNION ALL ".join(parts)}"""


def oracle_sql() -> dict[str, str]:
    order = ", ".join(f"{c} NULLS FIRST" for c in S.LINE_ORDER)
    weeks = "SELECT o_custkey AS k, date_diff('day', DATE '1969-12-29', CAST(date_trunc('week', o_orderdate) AS DATE)) // 7 AS u FROM orders"
    periods = f"""{_fin_only(fixed=True)}
SELECT l_partkey AS k, CAST(financial_year AS INTEGER) * 12 + CAST(substr(financial_period, 8, 2) AS INTEGER) - 1 AS u
FROM lineitem JOIN fin ON calendar_date = CAST(l_shipdate AS DATE)"""
    return {
        "orders_to_date_all_days": to_date_all_days_sql(),
        "orders_customers_to_date": customers_to_date_sql(),
        "lineitem_numbered": f"SELECT row_number() OVER (ORDER BY {order}) AS line_key, {', '.join(S.LINE_ORDER)} FROM lineitem",
        "orders_effective_period": effective_sql(),
        "events_by_band": bands_sql(),
        "customer_order_gaps": gaps_sql("o_custkey", weeks),
        "part_idle_periods": gaps_sql("l_partkey", periods),
        "supplier_daily_balance": balance_sql(),
        "orders_rollup_maintained": maintained_sql(),
        "orders_rollup_batches": batches_sql(),
        "events_stream_sessions": sessions_sql(),
        "orders_hierarchy_totals": hierarchy_sql(),
    }
