"""The same questions in SQL for a relational engine, to check the queries against.

The statements go their own way on purpose: extremes by joining back, pairs of
bars for the isolation depth, a range join for the windows, a generated calendar
for the look-back. They are for small data only.
"""

from __future__ import annotations

from fallscan.plans import registry as r

FIRST, LATEST = "DATE '2024-01-23'", "DATE '2024-01-30'"
ASOF = f"DATE '{r.ASOF}'"
ASOF_PAST = f"DATE '{r.ASOF_PAST}'"

BAR = "ticker, trade_date, open, high, low, close, adj_close, volume"


def _ticker(key: str, prefix: str = "T") -> str:
    return f"'{prefix}' || lpad({key}::VARCHAR, greatest(5, length({key}::VARCHAR))::INTEGER, '0')"


def _event_bars(name: str, adj_close: str, extra: str = "") -> str:
    group = ", 9" if extra else ""
    return f"""{name} AS (
  SELECT {_ticker("user_id")} AS ticker, CAST(ts AS DATE) AS trade_date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, {adj_close} AS adj_close,
         count(*)::BIGINT AS volume {extra}
  FROM events GROUP BY 1, 2{group})"""


BARS = _event_bars("bars", "last(value ORDER BY ts, event_id)")
GAPPY = _event_bars(
    "gappy",
    "CASE WHEN last(event_type ORDER BY ts, event_id) <> 'error'"
    " THEN last(value ORDER BY ts, event_id) END",
)
#: Bars without any price for every seventh user.
NULLS = _event_bars(
    "nulls", "CASE WHEN user_id % 7 <> 0 THEN last(value ORDER BY ts, event_id) END", ", user_id"
).replace(", user_id\n", "\n").replace("GROUP BY 1, 2, 9", "GROUP BY 1, 2, user_id")
BATCHES = _event_bars(
    "batches", "last(value ORDER BY ts, event_id)", ", event_type AS batch"
)
LONG = f"""bars_long AS (
  SELECT {_ticker("l_suppkey", "S")} AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
         first(p ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, p) AS open,
         max(p) AS high, min(p) AS low,
         last(p ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, p) AS close,
         last(p ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, p) AS adj_close,
         sum(l_quantity)::BIGINT AS volume
  FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2)"""

COMPANIES = f"""companies AS (
  SELECT {_ticker("c_custkey")} AS ticker, coalesce(c_name, 'N/A') AS name,
         coalesce(c_mktsegment, 'N/A') AS sector, coalesce(n_name, 'N/A') AS industry
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

LISTING = f"listing AS (SELECT {_ticker('c_custkey')} AS ticker FROM customer)"

RUNS = f"""{GAPPY}, runs AS (
  SELECT day(trade_date) AS run_id, ticker FROM gappy WHERE adj_close IS NOT NULL)"""


def _window(source: str, today: bool = False) -> str:
    """CTEs win, extremes and crashed over the bars table ``source``."""
    extra = f"AND min_date = {LATEST}" if today else ""
    return f"""win AS (SELECT * FROM {source} WHERE trade_date BETWEEN {FIRST} AND {LATEST}),
bounds AS (
  SELECT ticker, min(adj_close) AS min_price, max(adj_close) AS max_price
  FROM win WHERE adj_close IS NOT NULL GROUP BY ticker),
extremes AS (
  SELECT b.ticker, b.min_price, lo.d AS min_date, b.max_price, hi.d AS max_date,
         (b.max_price - b.min_price) / nullif(b.max_price, 0) * 100 AS diff_perc
  FROM bounds b
  JOIN (SELECT w.ticker, min(w.trade_date) AS d FROM win w JOIN bounds x
        ON w.ticker = x.ticker AND w.adj_close = x.min_price GROUP BY 1) lo
    ON lo.ticker = b.ticker
  JOIN (SELECT w.ticker, min(w.trade_date) AS d FROM win w JOIN bounds x
        ON w.ticker = x.ticker AND w.adj_close = x.max_price GROUP BY 1) hi
    ON hi.ticker = b.ticker),
crashed AS (
  SELECT * FROM extremes WHERE diff_perc >= 30 AND max_date < min_date {extra})"""


WINDOW_ROWS = f"""SELECT w.*, w.adj_close = c.max_price AS max_value,
       w.adj_close = c.min_price AS min_value
FROM win w JOIN crashed c ON w.ticker = c.ticker"""


def _scored(source: str) -> str:
    """CTEs usable, depths and scored over the bars table ``source``."""
    return f"""usable AS (
  SELECT *, adj_close * volume AS volume_close,
         lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_date,
         lag(adj_close) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM {source} WHERE adj_close * volume IS NOT NULL),
levels AS (SELECT DISTINCT ticker, volume_close AS v FROM usable WHERE n >= 2),
gaps AS (
  SELECT ticker, v AS lo, lead(v) OVER (PARTITION BY ticker ORDER BY v) AS hi FROM levels),
level_depths AS (
  SELECT s.ticker, s.v,
         round(coalesce(sum(CASE WHEN g.lo >= s.v THEN (g.hi - g.lo) / (g.hi - s.v)
                                 ELSE (g.hi - g.lo) / (s.v - g.lo) END), 0), 6) AS depth
  FROM levels s LEFT JOIN gaps g ON g.ticker = s.ticker AND g.hi IS NOT NULL GROUP BY 1, 2),
depths AS (
  SELECT u.ticker, u.trade_date, d.depth AS isolation_depth
  FROM usable u JOIN level_depths d ON d.ticker = u.ticker AND d.v = u.volume_close),
thresholds AS (
  SELECT ticker, quantile_cont(isolation_depth, 0.1) AS t FROM depths GROUP BY ticker),
scored AS (
  SELECT u.* EXCLUDE (n), d.isolation_depth, d.isolation_depth < t.t AS is_anomaly
  FROM usable u JOIN depths d ON u.ticker = d.ticker AND u.trade_date = d.trade_date
  JOIN thresholds t ON t.ticker = u.ticker)"""


#: Levels of a tree on up to 32 rows; the bars made from events have at most 31 days.
_TREE_LEVELS = 5


def _forest(source: str) -> str:
    """CTEs usable and scored: expected path lengths of limited trees, node by node."""
    level = """p{h} AS (
  SELECT ticker, i, j, sum(p) AS p FROM (
    SELECT p.ticker, p.i, g.k AS j, p.p * g.width / (hi.v - lo.v) AS p
    FROM p{b} p JOIN lv lo ON lo.ticker = p.ticker AND lo.k = p.i
    JOIN lv hi ON hi.ticker = p.ticker AND hi.k = p.j
    JOIN lv g ON g.ticker = p.ticker AND g.k >= p.i AND g.k < p.j
    UNION ALL
    SELECT p.ticker, g.k + 1, p.j, p.p * g.width / (hi.v - lo.v)
    FROM p{b} p JOIN lv lo ON lo.ticker = p.ticker AND lo.k = p.i
    JOIN lv hi ON hi.ticker = p.ticker AND hi.k = p.j
    JOIN lv g ON g.ticker = p.ticker AND g.k >= p.i AND g.k < p.j)
  GROUP BY ALL)"""
    levels = ",\n".join(level.format(h=h, b=h - 1) for h in range(1, _TREE_LEVELS + 1))
    every = " UNION ALL ".join(f"SELECT *, {h} AS h FROM p{h}" for h in range(_TREE_LEVELS + 1))
    return f"""usable AS (
  SELECT *, adj_close * volume AS volume_close,
         lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_date,
         lag(adj_close) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM {source} WHERE adj_close * volume IS NOT NULL),
lv AS (
  SELECT ticker, volume_close AS v, count(*) AS times, any_value(n) AS n,
         row_number() OVER (PARTITION BY ticker ORDER BY volume_close) AS k,
         lead(volume_close) OVER (PARTITION BY ticker ORDER BY volume_close) - volume_close AS width
  FROM usable WHERE n >= 2 GROUP BY ticker, volume_close),
trees AS (
  SELECT ticker, max(k) AS m, ceil(log2(any_value(n)))::INTEGER AS tallest FROM lv GROUP BY ticker),
p0 AS (SELECT ticker, 1 AS i, m AS j, 1.0::DOUBLE AS p FROM trees),
{levels},
sized AS (
  SELECT p.ticker, p.i, p.j, p.p, p.h, t.tallest, sum(l.times) AS n
  FROM ({every}) p JOIN trees t ON t.ticker = p.ticker AND p.h <= t.tallest
  JOIN lv l ON l.ticker = p.ticker AND l.k BETWEEN p.i AND p.j GROUP BY ALL),
worths AS (
  SELECT ticker, i, j, sum(p * CASE
           WHEN i < j AND h < tallest THEN 1.0 WHEN n <= 1 THEN 0.0 WHEN n = 2 THEN 1.0
           ELSE 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n END) AS w
  FROM sized GROUP BY ALL),
depths AS (
  SELECT u.ticker, u.trade_date, round(sum(w.w), 6) AS isolation_depth
  FROM usable u JOIN lv l ON l.ticker = u.ticker AND l.v = u.volume_close
  JOIN worths w ON w.ticker = l.ticker AND l.k BETWEEN w.i AND w.j GROUP BY ALL),
thresholds AS (
  SELECT ticker, quantile_cont(isolation_depth, 0.1) AS t FROM depths GROUP BY ticker),
scored AS (
  SELECT u.* EXCLUDE (n), d.isolation_depth, d.isolation_depth < t.t AS is_anomaly
  FROM usable u JOIN depths d ON u.ticker = d.ticker AND u.trade_date = d.trade_date
  JOIN thresholds t ON t.ticker = u.ticker)"""


def _windows(source: str, of: str, days: int = 2) -> str:
    """CTEs joined and drops: windows of the rows of ``of`` over ``source``."""
    return f"""joined AS (
  SELECT a.ticker, a.trade_date AS anomaly_date, b.trade_date, b.adj_close
  FROM {of} a JOIN {source} b ON a.ticker = b.ticker
   AND b.trade_date BETWEEN a.prev_date AND a.trade_date + {days}),
drops AS (
  SELECT ticker, anomaly_date, min(adj_close) - max(adj_close) AS period_max_diff,
         (min(adj_close) - max(adj_close)) / nullif(max(adj_close), 0) * 100
           AS period_percent_max_diff,
         first(trade_date ORDER BY adj_close, trade_date) AS min_value_date,
         min(adj_close) AS min_close,
         first(trade_date ORDER BY adj_close DESC, trade_date) AS max_value_date
  FROM joined WHERE adj_close IS NOT NULL GROUP BY 1, 2)"""


def _crashes(source: str) -> str:
    """CTEs up to ``crashes`` in the published layout."""
    return f"""{_scored(source)}, odd AS (SELECT * FROM scored WHERE is_anomaly),
{_windows(source, "odd")},
crashes AS (
  SELECT o.ticker, o.trade_date AS crash_date, o.adj_close AS crash_close,
         o.volume AS crash_volume, o.volume_close AS crash_volume_close,
         o.prev_date AS precrash_date, o.prev_close AS precrash_close,
         o.close - o.prev_close AS precrash_close_diff,
         (o.close - o.prev_close) / nullif(o.prev_close, 0) * 100 AS precrash_close_percent_diff,
         o.trade_date + 2 AS period_end_date, d.period_max_diff, d.period_percent_max_diff,
         d.min_value_date, d.min_close
  FROM odd o JOIN drops d ON d.ticker = o.ticker AND d.anomaly_date = o.trade_date
  WHERE d.period_percent_max_diff <= -30 AND d.max_value_date < d.min_value_date)"""


def _window_stats(today: bool, tables: str = GAPPY, source: str = "gappy") -> str:
    return f"""WITH {tables}, {_window(source, today)},
valid AS (SELECT ticker, count(adj_close) AS n FROM {source} GROUP BY ticker)
SELECT 'data_download' AS stat, (count(*) FILTER (n >= 2))::BIGINT AS passed,
       (count(*) FILTER (n < 2))::BIGINT AS failed, count(*)::BIGINT AS total FROM valid
UNION ALL
SELECT 'crashes_detected', count(c.ticker)::BIGINT, (count(*) - count(c.ticker))::BIGINT,
       count(*)::BIGINT
FROM valid v LEFT JOIN crashed c ON c.ticker = v.ticker WHERE n >= 2"""


_SET_STEP = """SELECT '{stat}' AS stat, count(k.ticker)::BIGINT AS passed,
       (count(*) - count(k.ticker))::BIGINT AS failed, count(*)::BIGINT AS total
FROM valid v LEFT JOIN (SELECT DISTINCT ticker FROM {keys}) k ON k.ticker = v.ticker
WHERE v.n >= 1"""

_PANEL = """SELECT event_type AS ticker, CAST(ts AS DATE) AS trade_date,
       first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
       last(value ORDER BY ts, event_id) AS close, last(value ORDER BY ts, event_id) AS adj_close,
       count(*)::BIGINT AS volume
FROM events GROUP BY 1, 2"""


#: What the composed jobs load: a month of one sector, five weekdays of the listing.
_MONTH_OF_SECTOR = f"""{GAPPY}, {COMPANIES}, loaded AS (
  SELECT * FROM gappy WHERE trade_date BETWEEN {ASOF} - INTERVAL 1 MONTH AND {ASOF}
     AND ticker IN (SELECT ticker FROM companies WHERE sector = '{r.SECTOR}')),
usable_loaded AS (
  SELECT * FROM loaded WHERE ticker IN (
    SELECT ticker FROM loaded GROUP BY ticker HAVING count(adj_close) >= 2))"""
_WEEK_OF_LISTING = f"""{GAPPY}, {LISTING}, loaded AS (
  SELECT * FROM gappy WHERE trade_date BETWEEN DATE '2024-01-24' AND {ASOF}
     AND ticker IN (SELECT ticker FROM listing))"""


def _outlier_stats(tables: str, source: str) -> str:
    return f"""WITH {tables}, {_crashes(source)},
            valid AS (SELECT ticker, count(adj_close) AS n FROM {source} GROUP BY ticker)
            SELECT 'data_download' AS stat, (count(*) FILTER (n >= 1))::BIGINT AS passed,
                   (count(*) FILTER (n < 1))::BIGINT AS failed, count(*)::BIGINT AS total
            FROM valid
            UNION ALL {_SET_STEP.format(stat="anomalies_detected", keys="odd")}
            UNION ALL {_SET_STEP.format(stat="crashes_detected", keys="crashes")}"""


#: As-of days with the weekday window before them.
_ASOF_WINDOWS = """asofs AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS asof_date,
         CASE WHEN isodow(o_orderdate) = 1 THEN CAST(o_orderdate AS DATE) - 3
              ELSE CAST(o_orderdate AS DATE) - 1 END AS last_day FROM orders),
back AS (
  SELECT asof_date, last_day - i::INTEGER AS d FROM asofs CROSS JOIN generate_series(1, 12) AS s(i)),
windows AS (
  SELECT a.asof_date, b.d AS first_day, a.last_day, NULL AS market
  FROM asofs a JOIN (
    SELECT asof_date, d, row_number() OVER (PARTITION BY asof_date ORDER BY d DESC) AS k
    FROM back WHERE isodow(d) <= 5) b ON b.asof_date = a.asof_date AND b.k = 5)"""

_SESSIONS = f"""{LONG}, markets AS (
  SELECT {_ticker("s_suppkey", "S")} AS ticker, s_nationkey::VARCHAR AS market FROM supplier),
days AS (
  SELECT DISTINCT market, trade_date AS session_date FROM bars_long JOIN markets USING (ticker)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY market ORDER BY session_date) AS session_no FROM days),
asofs AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS asof_date FROM orders),
before AS (
  SELECT n.market, a.asof_date, max(n.session_no) AS latest
  FROM asofs a JOIN numbered n ON n.session_date < a.asof_date GROUP BY ALL),
windows AS (
  SELECT b.market, b.asof_date, f.session_date AS first_day, l.session_date AS last_day
  FROM before b JOIN numbered l ON l.market = b.market AND l.session_no = b.latest
  JOIN numbered f ON f.market = b.market AND f.session_no = b.latest - {r.SESSIONS_BACK})"""


def _every_day(tables: str, market: str, today: str) -> str:
    return f"""WITH {tables}, inside AS (
  SELECT b.ticker, w.asof_date, w.first_day, w.last_day, b.trade_date, b.adj_close
  FROM bars_long b {market} JOIN windows w
    ON b.trade_date BETWEEN w.first_day AND w.last_day {"AND w.market = m.market" if market else ""}
  WHERE b.adj_close IS NOT NULL),
points AS (
  SELECT ticker, asof_date, first_day, last_day, min(adj_close) AS min_price,
         first(trade_date ORDER BY adj_close, trade_date) AS min_date, max(adj_close) AS max_price,
         first(trade_date ORDER BY adj_close DESC, trade_date) AS max_date
  FROM inside GROUP BY ALL)
SELECT *, (max_price - min_price) / max_price * 100 AS diff_perc FROM points
WHERE (max_price - min_price) / max_price * 100 >= 30 AND max_date < min_date {today}"""


def oracle_statements() -> dict[str, str]:
    run_set = f"SELECT ticker FROM runs WHERE run_id = {r.RUN_A} {{}} " \
              f"SELECT ticker FROM runs WHERE run_id = {r.RUN_B}"
    odd = f"WITH {BARS}, {_scored('bars')}, odd AS (SELECT * FROM scored WHERE is_anomaly)"
    return {
        "bars": f"WITH {BARS} SELECT * FROM bars",
        "bars_gappy": f"WITH {GAPPY} SELECT * FROM gappy",
        "bars_long": f"WITH {LONG} SELECT * FROM bars_long",
        "listing_parse": f"""SELECT {_ticker("c_custkey")} AS ticker, c_name AS security_name,
            c_mktsegment AS other_info, 'Q' AS market, 'N' AS test_issue,
            'N' AS financial_status FROM customer""",
        "bars_load_window": f"""WITH {BARS} SELECT * FROM bars
            WHERE trade_date BETWEEN {ASOF} - 5 AND {ASOF}""",
        "bars_load_months": f"""WITH {BARS} SELECT * FROM bars
            WHERE trade_date BETWEEN {ASOF} - INTERVAL 1 MONTH AND {ASOF}""",
        "bars_load_asof_past": f"""WITH {BARS} SELECT * FROM bars
            WHERE trade_date BETWEEN {ASOF_PAST} - 5 AND {ASOF_PAST}""",
        "bars_load_weekdays": f"""WITH {BARS}, days AS (
              SELECT {ASOF_PAST} - i::INTEGER AS d FROM generate_series(1, 14) AS s(i)),
            start AS (SELECT min(d) AS d FROM (
              SELECT d FROM days WHERE isodow(d) <= 5 ORDER BY d DESC LIMIT 5))
            SELECT * FROM bars
            WHERE trade_date BETWEEN (SELECT d FROM start) AND {ASOF_PAST}""",
        "panel_to_long": f"""WITH long AS ({_PANEL})
            SELECT t.ticker, d.trade_date, open, high, low, close, adj_close, volume
            FROM (SELECT DISTINCT trade_date FROM long) d
            CROSS JOIN (SELECT DISTINCT event_type AS ticker FROM events) t
            LEFT JOIN long l ON l.ticker = t.ticker AND l.trade_date = d.trade_date""",
        "panel_wide_to_long": f"""WITH {BARS}
            SELECT t.ticker, d.trade_date, open, high, low, close, adj_close, volume
            FROM (SELECT DISTINCT trade_date FROM bars) d
            CROSS JOIN (SELECT DISTINCT ticker FROM bars) t
            LEFT JOIN bars b ON b.ticker = t.ticker AND b.trade_date = d.trade_date""",
        "bars_of_region": f"""WITH {LONG} SELECT * FROM bars_long WHERE ticker IN (
            SELECT {_ticker("s_suppkey", "S")} FROM supplier
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            WHERE r_name = '{r.REGION}')""",
        "load_differences": f"""WITH {BARS}, {GAPPY}, sides AS (
              SELECT ticker, trade_date, adj_close, 1 AS a, 0 AS b FROM bars UNION ALL
              SELECT ticker, trade_date, adj_close, 0, 1 FROM gappy)
            SELECT ticker, trade_date, adj_close, sum(a)::BIGINT AS n_first,
                   sum(b)::BIGINT AS n_second
            FROM sides GROUP BY ticker, trade_date, adj_close HAVING sum(a) <> sum(b)""",
        "company_info": f"WITH {COMPANIES} SELECT * FROM companies",
        "bars_latest_batch": f"""WITH {BATCHES} SELECT * FROM batches
            QUALIFY row_number() OVER (PARTITION BY ticker, trade_date ORDER BY batch DESC) = 1""",
        "tickers_latest_batch": f"""WITH {BATCHES} SELECT * FROM batches b
            WHERE batch = (SELECT max(batch) FROM batches x WHERE x.ticker = b.ticker)""",
        "bars_union_batches": f"""WITH {BARS}, {BATCHES}
            SELECT *, NULL::VARCHAR AS batch FROM bars UNION ALL SELECT * FROM batches""",
        "bars_loaded_in_batches": f"""WITH {BATCHES} SELECT * FROM batches
            QUALIFY row_number() OVER (PARTITION BY ticker, trade_date ORDER BY batch DESC) = 1""",
        "market_sessions": f"WITH {_SESSIONS} SELECT * FROM numbered",
        "session_windows": f"WITH {_SESSIONS} SELECT * FROM windows",
        "window_crashes_every_day": _every_day(f"{LONG}, {_ASOF_WINDOWS}", "", ""),
        "window_crashes_every_session": _every_day(
            _SESSIONS, "JOIN markets m ON m.ticker = b.ticker", "AND min_date = last_day"
        ),
        "isolation_score_forest": f"""WITH {GAPPY}, {_forest("gappy")}
            SELECT ticker, trade_date, volume_close, isolation_depth FROM scored""",
        "anomalies_forest": f"WITH {GAPPY}, {_forest('gappy')} SELECT * FROM scored WHERE is_anomaly",
        "anomaly_window_wide": f"""WITH {LONG}, usable AS (
              SELECT *, lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_date
              FROM bars_long WHERE adj_close * volume IS NOT NULL),
            {_windows("bars_long", "usable", r.WIDE_DAYS)}
            SELECT ticker, anomaly_date AS trade_date,
                   anomaly_date + {r.WIDE_DAYS} AS period_end_date,
                   * EXCLUDE (ticker, anomaly_date) FROM drops""",
        "write_crash_tables": f"WITH {BARS}, {_window('bars')} {WINDOW_ROWS}",
        "dollar_volume": f"""WITH {GAPPY}
            SELECT ticker, trade_date, adj_close * volume AS volume_close FROM gappy""",
        "bars_complete": f"""WITH {GAPPY} SELECT *, adj_close * volume AS volume_close FROM gappy
            WHERE adj_close IS NOT NULL AND volume IS NOT NULL""",
        "bars_in_window": f"""WITH {BARS}
            SELECT * FROM bars WHERE trade_date BETWEEN {FIRST} AND {LATEST}""",
        "anomaly_change": f"""{odd}
            SELECT ticker, trade_date, close, prev_close, close - prev_close AS close_diff,
                   (close - prev_close) / nullif(prev_close, 0) * 100 AS close_percent_diff
            FROM odd""",
        "anomaly_change_adjusted": f"""WITH {GAPPY}, {_scored("gappy")}
            SELECT ticker, trade_date, adj_close, prev_close, adj_close - prev_close AS close_diff,
                   (adj_close - prev_close) / nullif(prev_close, 0) * 100 AS close_percent_diff
            FROM scored WHERE is_anomaly""",
        "company_sector_filter": f"""WITH {COMPANIES}
            SELECT * FROM companies WHERE sector = '{r.SECTOR}'""",
        "latest_trading_days": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS asof_date,
            CASE WHEN isodow(o_orderdate) = 1 THEN CAST(o_orderdate AS DATE) - 3
                 ELSE CAST(o_orderdate AS DATE) - 1 END AS latest_date FROM orders""",
        "weekday_back_n": """WITH asofs AS (
              SELECT DISTINCT CAST(o_orderdate AS DATE) AS asof_date,
                     CASE WHEN isodow(o_orderdate) = 1 THEN CAST(o_orderdate AS DATE) - 3
                          ELSE CAST(o_orderdate AS DATE) - 1 END AS latest FROM orders),
            days AS (
              SELECT asof_date, latest - i::INTEGER AS d
              FROM asofs CROSS JOIN generate_series(1, 12) AS s(i)),
            numbered AS (
              SELECT asof_date, d, row_number() OVER (PARTITION BY asof_date ORDER BY d DESC) AS k
              FROM days WHERE isodow(d) <= 5)
            SELECT asof_date, d AS period_start FROM numbered WHERE k = 5""",
        "ticker_quality": f"""WITH {GAPPY} SELECT ticker, count(*)::BIGINT AS n_bars,
            count(adj_close)::BIGINT AS n_valid, count(adj_close) >= 2 AS is_usable
            FROM gappy GROUP BY ticker""",
        "ticker_all_null": f"""WITH {NULLS} SELECT ticker FROM nulls GROUP BY ticker
            HAVING count(adj_close) = 0""",
        "usable_bars": f"""WITH {GAPPY} SELECT * FROM gappy WHERE ticker IN (
            SELECT ticker FROM gappy WHERE adj_close IS NOT NULL
            GROUP BY ticker HAVING count(*) > 1)""",
        "usable_bars_outlier": f"""WITH {NULLS} SELECT * FROM nulls WHERE ticker IN (
            SELECT ticker FROM nulls WHERE adj_close IS NOT NULL)""",
        "stat_data_download": f"""WITH {GAPPY},
            valid AS (SELECT ticker, count(adj_close) AS n FROM gappy GROUP BY ticker)
            SELECT 'data_download' AS stat, (count(*) FILTER (n >= 2))::BIGINT AS passed,
                   (count(*) FILTER (n < 2))::BIGINT AS failed, count(*)::BIGINT AS total
            FROM valid""",
        "step_stats": _window_stats(today=False),
        "step_stats_today": _window_stats(today=True),
        "step_stats_outlier": _outlier_stats(GAPPY, "gappy"),
        "report_window_stats": _window_stats(False, _MONTH_OF_SECTOR, "loaded"),
        "report_window_crashes": f"""WITH {_MONTH_OF_SECTOR},
            {_window("usable_loaded")} {WINDOW_ROWS}""",
        "report_outlier_stats": _outlier_stats(_WEEK_OF_LISTING, "loaded"),
        "report_outlier_crashes": f"WITH {_WEEK_OF_LISTING}, {_crashes('loaded')} SELECT * FROM crashes",
        "window_extremes": f"WITH {GAPPY}, {_window('gappy')} SELECT * FROM extremes",
        "window_crashes": f"WITH {BARS}, {_window('bars')} {WINDOW_ROWS}",
        "window_crashes_today": f"WITH {BARS}, {_window('bars', today=True)} {WINDOW_ROWS}",
        "window_crashes_gappy": f"WITH {GAPPY}, {_window('gappy')} {WINDOW_ROWS}",
        "window_crashes_last_traded": f"WITH {GAPPY}, {_window('gappy', today=True)} {WINDOW_ROWS}",
        "bar_lag": f"""WITH {GAPPY}, {_scored("gappy")}
            SELECT ticker, trade_date, prev_date, prev_close FROM usable""",
        "isolation_score": f"""WITH {GAPPY}, {_scored("gappy")}
            SELECT ticker, trade_date, volume_close, isolation_depth FROM scored""",
        "isolation_score_long": f"""WITH {LONG}, {_scored("bars_long")}
            SELECT ticker, trade_date, volume_close, isolation_depth FROM scored""",
        "isolation_score_mixed": f"""WITH {GAPPY}, {LONG},
            mixed AS (SELECT * FROM gappy UNION ALL SELECT * FROM bars_long), {_scored("mixed")}
            SELECT ticker, trade_date, volume_close, isolation_depth FROM scored""",
        "anomaly_flag": f"""WITH {GAPPY}, {_scored("gappy")}
            SELECT ticker, trade_date, is_anomaly FROM scored""",
        "anomalies": f"WITH {GAPPY}, {_scored('gappy')} SELECT * FROM scored WHERE is_anomaly",
        "anomaly_counts": f"""WITH {GAPPY}, {_scored("gappy")}
            SELECT u.ticker, (count(*) FILTER (s.is_anomaly))::BIGINT AS n_anomalies,
                   count(*)::BIGINT AS n_rows
            FROM usable u LEFT JOIN scored s
              ON s.ticker = u.ticker AND s.trade_date = u.trade_date GROUP BY u.ticker""",
        "anomaly_window_join": f"{odd}, {_windows('bars', 'odd')} SELECT * FROM joined",
        "window_close_list": f"""{odd}, {_windows("bars", "odd")}
            SELECT ticker, anomaly_date,
                   row_number() OVER (PARTITION BY ticker, anomaly_date ORDER BY trade_date) - 1
                     AS position,
                   adj_close AS close
            FROM joined WHERE adj_close IS NOT NULL""",
        "anomaly_drop": f"{odd}, {_windows('bars', 'odd')} SELECT * FROM drops",
        "anomaly_window_range": f"""WITH {GAPPY}, {_scored("gappy")},
            {_windows("gappy", "usable")}
            SELECT ticker, anomaly_date AS trade_date, anomaly_date + 2 AS period_end_date,
                   * EXCLUDE (ticker, anomaly_date) FROM drops""",
        "anomaly_crashes": f"WITH {BARS}, {_crashes('bars')} SELECT * FROM crashes",
        "anomaly_crashes_gappy": f"WITH {GAPPY}, {_crashes('gappy')} SELECT * FROM crashes",
        "anomaly_crashes_long": f"WITH {LONG}, {_crashes('bars_long')} SELECT * FROM crashes",
        "crash_recent": f"""WITH {BARS}, {_crashes("bars")} SELECT * FROM crashes
            WHERE min_value_date BETWEEN {ASOF} - {r.MAX_DAYS_IN_PAST} AND {ASOF}""",
        "crash_company_info": f"""WITH {BARS}, {_window("bars")}, {COMPANIES}
            SELECT * FROM companies WHERE ticker IN (SELECT ticker FROM crashed)""",
        "report_crash_table": f"""WITH {BARS}, {_crashes("bars")}
            SELECT * FROM crashes ORDER BY ticker, crash_date""",
        "bars_of_sector": f"""WITH {BARS}, {COMPANIES} SELECT * FROM bars
            WHERE ticker IN (SELECT ticker FROM companies WHERE sector = '{r.SECTOR}')""",
        "collate_bars_crashes": f"""WITH {BARS}, {_crashes("bars")}
            SELECT b.*, c.* EXCLUDE (ticker) FROM bars b LEFT JOIN crashes c
              ON c.ticker = b.ticker AND c.min_value_date = b.trade_date""",
        "chart_series": f"""WITH {BARS}, {_window("bars")}, rows AS ({WINDOW_ROWS})
            SELECT ticker, ticker || ' Crash Detection' AS title, 'Adj Close' AS series,
                   trade_date AS x, adj_close AS y FROM rows
            UNION ALL
            SELECT ticker, ticker || ' Crash Detection', 'Crash', trade_date, adj_close
            FROM rows WHERE min_value""",
        "chart_series_outlier": f"""WITH {BARS}, {_crashes("bars")}
            SELECT ticker, ticker || ' Crash Detection' AS title, 'Adj Close' AS series,
                   trade_date AS x, adj_close AS y
            FROM bars WHERE ticker IN (SELECT ticker FROM crashes)
            UNION ALL
            SELECT ticker, ticker || ' Crash Detection', 'Crash', min_value_date, min_close
            FROM crashes""",
        "tickers_missing": f"""WITH {LISTING}, {BARS} SELECT ticker FROM listing
            WHERE ticker NOT IN (SELECT ticker FROM bars)""",
        "tickers_first_n": f"""WITH {LISTING}
            SELECT ticker FROM listing ORDER BY ticker LIMIT {r.FIRST_N}""",
        "tickers_slice": f"""WITH {LISTING} SELECT ticker FROM listing
            ORDER BY ticker LIMIT {r.SLICE_LENGTH} OFFSET {r.SLICE_OFFSET}""",
        "tickers_first_n_plus": f"""WITH {LISTING}
            (SELECT ticker FROM listing ORDER BY ticker LIMIT {r.FIRST_N})
            UNION SELECT '{r.EXTRA_TICKER}'""",
        "load_stability": f"""WITH {RUNS}
            SELECT ticker, count(DISTINCT run_id)::BIGINT AS n_runs,
                   count(DISTINCT run_id) = (SELECT count(DISTINCT run_id) FROM runs) AS is_stable
            FROM runs GROUP BY ticker""",
        "run_tickers_except": f"WITH {RUNS} {run_set.format('EXCEPT ALL')}",
        "run_tickers_intersect": f"WITH {RUNS} {run_set.format('INTERSECT')}",
    }
