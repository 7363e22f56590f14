"""The registered queries as SQL for DuckDB over the same parquet tables."""

from __future__ import annotations

from statistics import NormalDist

# Two-sided normal quantile of the 0.95 interval.
Z = repr(NormalDist().inv_cdf(0.975))


def _bars(symbol: str, ts: str, price: str, order: str, source: str, where: str = "") -> str:
    return f"""SELECT CAST({symbol} AS VARCHAR) AS symbol, CAST({ts} AS DATE) AS dt,
  arg_min({price}, {order}) AS open, max({price}) AS high, min({price}) AS low,
  arg_max({price}, {order}) AS close, count(*) AS volume
FROM {source} {where} GROUP BY ALL"""


def _events(symbol: str, where: str = "") -> str:
    return _bars(symbol, "ts", "value", "event_id", "events", where)


EV = _events("event_type")
USR = _events("user_id")
ORD = _bars("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey", "orders")
MARKET = _events("'market'")

# The day after the last event, as a run that takes all of them derives it.
AFTER_EVENTS = "(SELECT max(CAST(ts AS DATE)) + 1 FROM events)"


def _gaps(bars: str) -> str:
    """Some days without a day, a close or a volume, and some opens of zero."""
    return f"""SELECT symbol, CASE WHEN day(dt) % 13 <> 7 THEN dt END AS dt,
  CASE WHEN day(dt) % 5 = 1 THEN 0 ELSE open END AS open, high, low,
  CASE WHEN day(dt) % 7 <> 3 THEN close END AS close, CASE WHEN day(dt) % 11 <> 5 THEN volume END AS volume
FROM ({bars})"""


BARS = "symbol, CAST(dt AS VARCHAR) AS dt, open, high, low, close, volume"

EARLIER = f"SELECT * FROM ({EV}) WHERE dt < DATE '2024-01-28'"
INCOMING = f"""SELECT symbol, dt, open + 1 AS open, high + 1 AS high, low + 1 AS low, close + 1 AS close,
  volume + 1 AS volume FROM ({EV}) WHERE dt >= DATE '2024-01-25'
UNION ALL SELECT * FROM ({MARKET}) WHERE dt >= DATE '2024-01-25'"""

UPSERTED = f"""WITH old AS ({EARLIER}), inc AS ({INCOMING}), merged AS (
  SELECT coalesce(i.symbol, o.symbol) AS symbol, coalesce(i.dt, o.dt) AS dt,
    CASE WHEN i.symbol IS NULL THEN o.open ELSE i.open END AS open,
    CASE WHEN i.symbol IS NULL THEN o.high ELSE i.high END AS high,
    CASE WHEN i.symbol IS NULL THEN o.low ELSE i.low END AS low,
    CASE WHEN i.symbol IS NULL THEN o.close ELSE i.close END AS close,
    CASE WHEN i.symbol IS NULL THEN o.volume ELSE i.volume END AS volume
  FROM old o FULL JOIN inc i ON o.symbol = i.symbol AND o.dt = i.dt)
SELECT {BARS} FROM merged"""


def _summary(bars: str) -> str:
    return f"""SELECT symbol, dt, open, high, low, close, volume,
  high - low AS daily_range, ((close - open) / nullif(open, 0)) * 100 AS daily_return_pct,
  avg(close) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7_day,
  avg(close) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma_30_day
FROM ({bars}) WHERE dt IS NOT NULL AND close IS NOT NULL"""


SUMMARY_COLUMNS = f"""{BARS}, daily_range, daily_return_pct,
  round(ma_7_day, 6) AS ma_7_day, round(ma_30_day, 6) AS ma_30_day"""


def _summary_shown(bars: str) -> str:
    return f"SELECT {SUMMARY_COLUMNS} FROM ({_summary(bars)})"


def _indicator(column: str) -> str:
    return f"SELECT symbol, CAST(dt AS VARCHAR) AS dt, {column} FROM ({_summary(ORD)})"


def _ends(where: str = "") -> str:
    return f"""SELECT symbol, CAST(min(dt) AS VARCHAR) AS first_dt, CAST(max(dt) AS VARCHAR) AS last_dt,
  arg_min(close, dt) AS first_close, arg_max(close, dt) AS last_close,
  (arg_max(close, dt) / nullif(arg_min(close, dt), 0) - 1) * 100 AS total_return_pct
FROM ({ORD}) {where} GROUP BY symbol"""


# --- forecasts ----------------------------------------------------------------------------------


def _fit(bars: str, start: str) -> str:
    """Ordinary least squares from plain sums about the means, and the steps between rows."""
    return f"""
train AS (SELECT symbol, dt, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS step
  FROM ({bars}) WHERE dt >= {start} AND close IS NOT NULL),
firsts AS (SELECT symbol, min(dt) AS first_dt, max(dt) AS last_dt, count(*) AS n, arg_min(close, dt) AS y1,
  arg_max(close, dt) AS yn, stddev_samp(step) AS step_sd, avg(close) AS my FROM train GROUP BY symbol),
points AS (SELECT t.symbol, t.close AS y, CAST(t.dt - f.first_dt AS DOUBLE) AS x
  FROM train t JOIN firsts f USING (symbol)),
means AS (SELECT symbol, avg(x) AS mx FROM points GROUP BY symbol),
sums AS (SELECT p.symbol, sum((x - mx) * (x - mx)) AS sxx, sum((x - mx) * (y - my)) AS sxy,
  sum((y - my) * (y - my)) AS syy
  FROM points p JOIN means USING (symbol) JOIN firsts USING (symbol) GROUP BY p.symbol),
fit AS (SELECT *, sxy / nullif(sxx, 0) AS b, my - sxy / nullif(sxx, 0) * mx AS a,
  (yn - y1) / nullif(n - 1, 0) AS d, CASE WHEN n >= 3 AND sxx > 0 THEN 'ok' ELSE 'skipped' END AS status
  FROM firsts JOIN means USING (symbol) JOIN sums USING (symbol))"""


_EVERY_DAY = """steps AS (SELECT *, last_dt + CAST(h AS INTEGER) AS day FROM fit, range(1, 15) hs(h)
  WHERE status = 'ok')"""
# Weekdays by counting them off: the h-th Monday-to-Friday day after the last one.
_WEEKDAYS = """days AS (SELECT symbol, last_dt + CAST(g AS INTEGER) AS day,
    row_number() OVER (PARTITION BY symbol ORDER BY g) AS h
  FROM fit, range(1, 40) gs(g) WHERE isodow(last_dt + CAST(g AS INTEGER)) <= 5),
steps AS (SELECT fit.*, days.h, days.day FROM fit JOIN days USING (symbol)
  WHERE days.h <= 14 AND status = 'ok')"""


_TREND = """pred AS (SELECT symbol, day, a + b * CAST(day - first_dt AS DOUBLE) AS p,
  sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2))
  * sqrt(1 + 1.0::DOUBLE / n + power(CAST(day - first_dt AS DOUBLE) - mx, 2) / sxx) AS se FROM steps)"""
_DRIFT = """pred AS (SELECT symbol, day, yn + h * d AS p,
  step_sd * sqrt(h * (1 + h::DOUBLE / (n - 1))) AS se FROM steps)"""


def _forecast(bars: str, start: str, method: str = _TREND, steps: str = _EVERY_DAY) -> str:
    """Common table expressions that end in pred (symbol, day, p, se)."""
    return ",\n".join([_fit(bars, start).strip(), steps, method])


def _predictions(digits: int = 6, pred: str = "round(p, {})") -> str:
    return f"""SELECT symbol, CAST(CAST(day AS TIMESTAMP) AS VARCHAR) AS ts, {pred.format(digits)} AS close_pred,
  round(p - {Z} * se, {digits}) AS lower_bound, round(p + {Z} * se, {digits}) AS upper_bound,
  CAST(day AS VARCHAR) AS prediction_for, '2024-01-31 06:00:00' AS created_at FROM pred"""


EV_START, ORD_START = "DATE '2023-08-04'", "DATE '2001-02-03'"
EV_BEFORE = f"SELECT * FROM ({EV}) WHERE dt < DATE '2024-01-28'"
EV_FORECAST = f"WITH {_forecast(EV, EV_START)} {_predictions()}"
EV_EARLIER_FORECAST = f"WITH {_forecast(EV_BEFORE, EV_START)} {_predictions()}"
REPLACED = f"""SELECT * FROM ({EV_EARLIER_FORECAST}) WHERE prediction_for < '2024-01-31'
UNION ALL SELECT * FROM ({EV_FORECAST})"""


def _final(
    upper: str = "upper_bound_forecast",
    lower: str = "lower_bound_forecast",
    bars: str = EV,
    as_of: str = "DATE '2024-01-31'",
) -> str:
    start = f"{as_of} - 180"
    return f"""WITH bars AS ({bars}), {_forecast("SELECT * FROM bars", start)}
SELECT symbol, CAST(dt AS VARCHAR) AS dt, open, high, low, close, CAST(volume AS DOUBLE) AS volume, 'RAW' AS source,
  NULL::DOUBLE AS close_forecast, NULL::DOUBLE AS {upper}, NULL::DOUBLE AS {lower},
  '2024-01-31 06:00:00' AS created_at
FROM bars WHERE dt >= {start}
UNION ALL
SELECT symbol, CAST(day AS VARCHAR), NULL, NULL, NULL, NULL, NULL, 'FORECAST', round(p, 6),
  round(p + {Z} * se, 6), round(p - {Z} * se, 6), '2024-01-31 06:00:00'
FROM pred WHERE day >= {as_of}"""


OUTCOMES = f"""WITH {_forecast(USR, "DATE '2024-01-28'")},
made AS (SELECT symbol, count(*) AS k FROM pred WHERE day >= DATE '2024-01-31' GROUP BY symbol)
SELECT symbol, 'train' AS stage, status, n AS n_rows,
  CASE WHEN status = 'ok' THEN 'ok (train_rows=' || n || ')'
       WHEN n < 3 THEN 'skipped: too few rows (' || n || ')'
       ELSE 'skipped: all rows on one day' END AS message
FROM fit
UNION ALL
SELECT symbol, 'forecast', status, coalesce(k, 0),
  CASE WHEN status = 'ok' THEN 'ok (pred_rows=' || coalesce(k, 0) || ')' ELSE 'skipped: no model' END
FROM fit LEFT JOIN made USING (symbol)"""


# --- Holt, by recursion from row to row ---------------------------------------------------------

_WEIGHTS = ", ".join(
    f"({i}, {a}::DOUBLE, {b}::DOUBLE)"
    for i, (a, b) in enumerate((a, b) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.2, 0.5))
)
_SERIES = f"""SELECT symbol, dt, close, row_number() OVER (PARTITION BY symbol ORDER BY dt) AS i
  FROM ({{bars}}) WHERE dt >= {EV_START} AND close IS NOT NULL"""


def _holt(train: str) -> str:
    """Common table expressions: f (state after each row, for each weight), best (the weights kept, with the state)."""
    error = "(t.close - f.level - f.trend)"
    return f"""RECURSIVE train AS ({train}),
n AS (SELECT symbol, count(*) AS n, max(dt) AS last_dt FROM train GROUP BY symbol),
grid(gi, a, b) AS (VALUES {_WEIGHTS}),
f(symbol, gi, a, b, i, level, trend, sse) AS (
  SELECT t.symbol, gi, a, b, t.i, t.close, t.close - z.close, 0::DOUBLE
  FROM train t JOIN train z ON z.symbol = t.symbol AND z.i = 1 AND t.i = 2 CROSS JOIN grid
  UNION ALL
  SELECT f.symbol, gi, a, b, t.i, level + trend + a * {error}, trend + a * b * {error}, sse + {error} * {error}
  FROM f JOIN train t ON t.symbol = f.symbol AND t.i = f.i + 1),
best AS (
  SELECT * FROM f JOIN n USING (symbol) WHERE f.i = n.n AND n.n >= 3
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY sse, gi) = 1)"""


_HOLT_SE = """sqrt(sse / (n - 2)) * sqrt(
  1 + a * a * (({h} - 1) + b * ({h} - 1) * {h} + b * b * ({h} - 1) * {h} * (2 * {h} - 1) / 6.0))"""


def _conformal(horizon: int) -> str:
    """After _holt: bounds (symbol, h, p, w, m, se); w is the width, NULL with too few errors."""
    return f"""e AS (
  SELECT k.symbol, h, abs(t.close - f.level - h * f.trend) AS e
  FROM best k JOIN f ON f.symbol = k.symbol AND f.gi = k.gi, range(1, {horizon + 1}) hs(h)
  JOIN train t ON t.symbol = k.symbol AND t.i = f.i + h),
l AS (SELECT symbol, h, list_sort(list(e)) AS es FROM e GROUP BY symbol, h),
bounds AS (
  SELECT k.symbol, hs.h, level + hs.h * trend AS p, coalesce(len(es), 0) AS m, k.n,
    CASE WHEN ceil((len(es) + 1) * 0.8 - 1e-9) <= len(es) THEN es[CAST(ceil((len(es) + 1) * 0.8 - 1e-9) AS BIGINT)] END AS w,
    {_HOLT_SE.format(h="hs.h")} AS se
  FROM best k CROSS JOIN range(1, {horizon + 1}) hs(h) LEFT JOIN l ON l.symbol = k.symbol AND l.h = hs.h)"""


HOLT_FORECAST = f"""WITH {_holt(_SERIES.format(bars=EV))},
pred AS (SELECT symbol, last_dt + CAST(h AS INTEGER) AS day, level + h * trend AS p, {_HOLT_SE.format(h="h")} AS se
  FROM best, range(1, 15) hs(h))
{_predictions()}"""
HOLT_USERS = f"""WITH {_holt(_SERIES.format(bars=USR))}
SELECT n.symbol, n.n AS train_rows, CASE WHEN n.n >= 3 THEN 'ok' ELSE 'skipped' END AS status, a AS alpha, b AS beta,
  round(level, 5) AS level, round(trend, 5) AS trend, round(sse, 5) AS sse
FROM n LEFT JOIN best USING (symbol)"""
CONFORMAL = f"""WITH {_holt(_SERIES.format(bars=USR))}, {_conformal(7)}
SELECT symbol, CAST(h AS INTEGER) AS h, round(p, 5) AS close_pred, round(p - w, 5) AS lower_bound,
  round(p + w, 5) AS upper_bound, CAST(m AS INTEGER) AS n_errors FROM bounds"""
_SHORTENED = f"""SELECT * FROM (
  SELECT *, count(*) OVER (PARTITION BY symbol) AS rows FROM ({_SERIES.format(bars=USR)})) WHERE rows >= 8"""
Z80 = repr(NormalDist().inv_cdf(0.9))
COVERAGE = f"""WITH {_holt(f"SELECT symbol, dt, close, i FROM ({_SHORTENED}) WHERE i <= rows - 5")}, {_conformal(5)},
held AS (SELECT symbol, i - rows + 5 AS h, close FROM ({_SHORTENED}) WHERE i > rows - 5)
SELECT CAST(h AS INTEGER) AS h, count(*) AS n_held_out, count(w) AS n_bounded,
  count(*) FILTER (abs(close - p) <= w) AS n_inside, count(*) FILTER (abs(close - p) <= {Z80} * se) AS n_inside_normal
FROM held JOIN bounds USING (symbol, h) GROUP BY h"""


def _made(day: str) -> str:
    bars = f"SELECT * FROM ({EV}) WHERE dt < DATE '{day}'"
    return f"SELECT *, TIMESTAMP '{day}' AS made FROM (WITH {_forecast(bars, EV_START)} SELECT symbol, day, p, se FROM pred)"


ACCURACY = f"""WITH made AS ({" UNION ALL ".join(_made(day) for day in ("2024-01-18", "2024-01-22", "2024-01-26"))}),
a AS (SELECT symbol, dt, close, CAST(dt AS TIMESTAMP) AS at FROM ({EV}))
SELECT a.symbol, CAST(dt AS VARCHAR) AS dt, close, round(p, 6) AS close_pred, CAST(made AS VARCHAR) AS created_at,
  round(close - p, 6) AS error, round((close - p) / nullif(close, 0) * 100, 6) AS error_pct,
  close BETWEEN p - {Z} * se AND p + {Z} * se AS inside
FROM a ASOF LEFT JOIN made ON made.symbol = a.symbol AND made.day = a.dt AND a.at > made.made"""

_UNPRICED = f"""SELECT symbol, dt, CASE WHEN day(dt) % 4 <> 2 THEN open END AS open,
  CASE WHEN day(dt) % 3 <> 1 THEN close END AS close FROM ({_gaps(ORD)}) WHERE dt IS NOT NULL"""
GAPPY_KPIS = f"""SELECT symbol, CAST(max(dt) AS VARCHAR) AS dt, arg_max(close, dt) AS close,
  CAST(min(dt) AS VARCHAR) AS first_dt, CAST(max(dt) AS VARCHAR) AS last_dt, arg_min(close, dt) AS first_close,
  round((arg_max(close, dt) / nullif(arg_min(close, dt), 0) - 1) * 100, 6) AS total_return_pct,
  round(stddev_samp((close - open) / nullif(open, 0) * 100), 6) AS volatility
FROM ({_UNPRICED}) WHERE close IS NOT NULL GROUP BY symbol"""
RANGE_KPIS = f"""SELECT symbol, CAST(min(dt) AS VARCHAR) AS first_dt, CAST(max(dt) AS VARCHAR) AS last_dt,
  arg_min(close, dt) AS first_close, arg_max(close, dt) AS last_close,
  round((arg_max(close, dt) / nullif(arg_min(close, dt), 0) - 1) * 100, 9) AS total_return_pct,
  round(stddev_samp((close - open) / nullif(open, 0) * 100), 9) AS volatility
FROM ({ORD}) WHERE dt BETWEEN DATE '1998-03-15' AND DATE '2001-05-10' GROUP BY symbol"""


# --- history ------------------------------------------------------------------------------------

FIRST = _summary(EARLIER)


def _second(by: int) -> str:
    return _summary(
        f"""SELECT symbol, dt, open, high, low,
  CASE WHEN symbol = 'view' AND dt = DATE '2024-01-25' THEN close + {by} ELSE close END AS close, volume
FROM ({EV}) WHERE symbol <> 'click'"""
    )


RUN = "'2024-01-31 06:00:00'"


def _history(check: bool, by: int = 1) -> str:
    """Versions after the second run: kept or closed ones of the first, then the opened ones.

    The restated row is the last correction's (``by``); rows that appeared are as the first one opened them.
    """
    restated = "s.symbol IS NOT NULL AND s.close <> f.close" if check else "FALSE"
    reopened = (
        f"""
UNION ALL
SELECT c.*, md5(c.symbol || c.dt || '|' || {RUN}), CAST(c.dt AS VARCHAR), {RUN}, NULL::VARCHAR
FROM c JOIN f ON c.symbol = f.symbol AND c.dt = f.dt WHERE c.close <> f.close"""
        if check
        else ""
    )
    return f"""WITH f AS ({FIRST}), s AS ({_second(1)}), c AS ({_second(by)}), versions AS (
SELECT f.*, md5(f.symbol || f.dt || '|' || f.dt) AS scd_id, CAST(f.dt AS VARCHAR) AS updated_at,
  CAST(CAST(f.dt AS TIMESTAMP) AS VARCHAR) AS valid_from,
  CASE WHEN s.symbol IS NULL OR ({restated}) THEN {RUN} END AS valid_to
FROM f LEFT JOIN s ON s.symbol = f.symbol AND s.dt = f.dt
UNION ALL
SELECT s.*, md5(s.symbol || s.dt || '|' || s.dt), CAST(s.dt AS VARCHAR),
  CAST(CAST(s.dt AS TIMESTAMP) AS VARCHAR), NULL::VARCHAR
FROM s LEFT JOIN f ON s.symbol = f.symbol AND s.dt = f.dt WHERE f.symbol IS NULL{reopened})
SELECT {SUMMARY_COLUMNS}, scd_id, updated_at, valid_from, valid_to FROM versions"""


def _first_history(bars: str) -> str:
    return f"""SELECT {SUMMARY_COLUMNS}, md5(t.symbol || t.dt || '|' || t.dt) AS scd_id,
  CAST(t.dt AS VARCHAR) AS updated_at, CAST(CAST(t.dt AS TIMESTAMP) AS VARCHAR) AS valid_from,
  NULL::VARCHAR AS valid_to
FROM ({_summary(bars)}) t"""


def _restated(by: int) -> str:
    return _summary(
        f"""SELECT symbol, dt, open, high, low,
  CASE WHEN date_trunc('month', dt) = DATE '2000-07-01' THEN close + {by} ELSE close END AS close, volume FROM ({ORD})"""
    )


RESTATED_MONTH = f"""WITH f AS ({_restated(0)}), s AS ({_restated(1)}), versions AS (
SELECT f.*, md5(f.symbol || f.dt || '|' || f.dt) AS scd_id, CAST(f.dt AS VARCHAR) AS updated_at,
  CAST(CAST(f.dt AS TIMESTAMP) AS VARCHAR) AS valid_from,
  CASE WHEN date_trunc('month', f.dt) = DATE '2000-07-01' THEN {RUN} END AS valid_to FROM f
UNION ALL
SELECT s.*, md5(s.symbol || s.dt || '|' || {RUN}), CAST(s.dt AS VARCHAR), {RUN}, NULL::VARCHAR
FROM s WHERE date_trunc('month', s.dt) = DATE '2000-07-01')
SELECT {SUMMARY_COLUMNS}, scd_id, updated_at, valid_from, valid_to FROM versions"""

_UPPER = f"SELECT upper(symbol) AS symbol, * EXCLUDE (symbol) FROM ({EV})"

ORACLES: dict[str, str] = {
    "bars_events_daily": f"SELECT {BARS} FROM ({EV})",
    "bars_orders_daily": f"SELECT {BARS} FROM ({ORD})",
    "bars_users_daily": f"SELECT {BARS} FROM ({USR})",
    "ingest_bars": f"SELECT {BARS} FROM ({ORD})",
    "ingest_bars_csv": f"SELECT {BARS} FROM ({ORD})",
    "ingest_bars_json": f"SELECT {BARS} FROM ({ORD})",
    "normalize_bars": f"SELECT {BARS} FROM ({ORD})",
    "normalize_records": f"""SELECT symbol, CAST(dt AS VARCHAR) AS dt, open, high, low, close,
  CAST(volume AS DOUBLE) AS volume FROM ({_UPPER})""",
    "outcomes_missing_cols": f"""SELECT symbol, 'extract' AS stage,
  CASE WHEN symbol = 'ERROR' THEN 'missing' ELSE 'ok' END AS status, count(*) AS n_rows,
  CASE WHEN symbol = 'ERROR' THEN 'missing columns: volume' ELSE 'ok (rows=' || count(*) || ')' END AS message
FROM ({_UPPER}) GROUP BY symbol
UNION ALL SELECT 'MARKET', 'extract', 'empty', 0, 'no data returned'""",
    "cast_bars": f"SELECT {BARS} FROM ({ORD})",
    "rows_per_symbol": f"SELECT symbol, count(*) AS n_rows FROM ({USR}) GROUP BY symbol",
    "safe_symbol": """SELECT symbol, count(*) AS n_rows,
  regexp_replace(symbol, '[^A-Za-z0-9_]', '_', 'g') AS safe_name
FROM (SELECT p_brand AS symbol FROM part UNION ALL SELECT o_orderpriority FROM orders) GROUP BY symbol""",
    "parse_symbols": """SELECT symbol, 2 * count(*) AS n_rows
FROM (SELECT upper(trim(p_type)) AS symbol FROM part UNION ALL SELECT upper(trim(p_brand)) FROM part)
GROUP BY symbol""",
    "ensure_tables": f"""SELECT 'raw_bars' AS table_name, count(*) AS n_rows FROM ({USR})
UNION ALL SELECT 'forecasts', 0 UNION ALL SELECT 'final', 0""",
    "upsert_bars": UPSERTED,
    "upsert_idempotent": UPSERTED,
    "upsert_orders": f"""SELECT symbol, CAST(dt AS VARCHAR) AS dt, open, high, low, close,
  CASE WHEN dt >= {ORD_START} THEN volume + 1 ELSE volume END AS volume FROM ({ORD})""",
    "load_counts": f"""SELECT (SELECT count(*) FROM ({EARLIER})) + (SELECT count(*) FROM ({INCOMING})) AS loaded_rows,
  (SELECT count(*) FROM (SELECT symbol, dt FROM ({EARLIER}) UNION SELECT symbol, dt FROM ({INCOMING})))
  AS stored_rows""",
    "materialize_table": _summary_shown(USR),
    "delete_bars": f"SELECT {BARS} FROM ({EARLIER})",
    "stg_bars": f"""SELECT symbol, CAST(dt AS VARCHAR) AS dt, open, high, low, close, CAST(volume AS DOUBLE) AS volume
FROM ({_gaps(ORD)}) WHERE dt IS NOT NULL AND close IS NOT NULL""",
    "lookback_bars": f"SELECT {BARS} FROM ({ORD}) WHERE dt >= {ORD_START}",
    "daily_range": _indicator("daily_range"),
    "daily_return_pct": _indicator("daily_return_pct"),
    "ma_7_day": _indicator("round(ma_7_day, 6) AS ma_7_day"),
    "ma_30_day": _indicator("round(ma_30_day, 6) AS ma_30_day"),
    "stock_summary": _summary_shown(EV),
    "stock_summary_orders": _summary_shown(ORD),
    "stock_summary_users": _summary_shown(USR),
    "stock_summary_union": _summary_shown(f"SELECT * FROM ({EV}) UNION ALL SELECT * FROM ({ORD})"),
    "summary_latest_30": f"""SELECT {SUMMARY_COLUMNS}
FROM (SELECT * FROM ({_summary(ORD)}) WHERE symbol = '1-URGENT' ORDER BY dt DESC LIMIT 30)""",
    "kpi_latest_price": f"""SELECT symbol, CAST(max(dt) AS VARCHAR) AS dt, arg_max(close, dt) AS close
FROM ({ORD}) GROUP BY symbol""",
    "kpi_total_return": _ends(),
    "kpi_total_return_range": _ends("WHERE dt BETWEEN DATE '2000-08-02' AND DATE '2001-08-02'"),
    "volatility_by_symbol": f"""SELECT symbol, round(stddev_samp(daily_return_pct), 6) AS volatility
FROM ({_summary(USR)}) GROUP BY symbol""",
    "volatility_30_day": f"""SELECT symbol, CAST(dt AS VARCHAR) AS dt, round(stddev_samp(daily_return_pct) OVER
  (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS volatility_30_day
FROM ({_summary(ORD)})""",
    "train_view": f"""SELECT symbol, CAST(CAST(dt AS TIMESTAMP) AS VARCHAR) AS ts, close
FROM ({ORD}) WHERE dt >= {ORD_START} AND close IS NOT NULL""",
    "train_counts": f"SELECT symbol, count(*) AS train_rows FROM ({USR}) WHERE dt >= {EV_START} GROUP BY symbol",
    "model_params": f"""WITH {_fit(EV, EV_START).strip()}
SELECT symbol, n AS train_rows, CAST(first_dt AS VARCHAR) AS first_dt, CAST(last_dt AS VARCHAR) AS last_dt,
  y1 AS first_close, yn AS last_close, status, round(b, 4) AS slope, round(a, 4) AS intercept,
  round(mx, 4) AS mean_x, round(sxx, 4) AS sxx, round(sxy, 4) AS sxy, round(syy, 4) AS syy,
  round(d, 4) AS step, round(step_sd, 4) AS step_sd FROM fit""",
    "forecast_trend": EV_FORECAST,
    "forecast_drift": f"WITH {_forecast(EV, EV_START, _DRIFT)} {_predictions(6, 'p')}",
    "forecast_trend_orders": f"WITH {_forecast(ORD, ORD_START)} {_predictions(4)}",
    "forecast_drift_orders": f"WITH {_forecast(ORD, ORD_START, _DRIFT)} {_predictions(4, 'p')}",
    "forecast_trend_users": f"WITH {_forecast(USR, EV_START)} {_predictions(4)}",
    "forecast_business_days": f"WITH {_forecast(EV, EV_START, _TREND, _WEEKDAYS)} {_predictions()}",
    "forecasts_from_as_of": f"SELECT * FROM ({EV_EARLIER_FORECAST}) WHERE prediction_for >= '2024-01-31'",
    "pred_counts": f"""SELECT symbol, count(*) AS pred_rows FROM ({EV_EARLIER_FORECAST})
WHERE prediction_for >= '2024-01-31' GROUP BY symbol""",
    "forecast_outcomes": OUTCOMES,
    "forecast_replace": REPLACED,
    "final_union": _final(bars=_gaps(EV)),
    "final_union_legacy": _final("open_bound_forecast", "lowerbound_forecast"),
    "actual_vs_predicted": f"SELECT * FROM ({_final()}) ORDER BY dt DESC",
    "check_not_null": f"""SELECT 'not_null' AS check_name, column_name, failures FROM (
  SELECT unnest(['symbol', 'dt', 'close', 'volume', 'daily_return_pct']) AS column_name,
    unnest([count(*) FILTER (symbol IS NULL), count(*) FILTER (dt IS NULL), count(*) FILTER (close IS NULL),
      count(*) FILTER (volume IS NULL), count(*) FILTER (daily_return_pct IS NULL)]) AS failures
  FROM ({_summary(_gaps(USR))}))""",
    "check_accepted_values": f"""SELECT symbol AS value, count(*) AS n_records FROM ({_summary(EV)})
WHERE symbol NOT IN ('click', 'view') GROUP BY symbol""",
    "check_unique_key": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_summary": f"""WITH twice AS (SELECT * FROM ({EV}) UNION ALL
  SELECT * FROM ({EV}) WHERE dt >= DATE '2024-01-28'),
rows_twice AS (SELECT * FROM ({_gaps("SELECT * FROM twice")}) WHERE dt IS NOT NULL AND close IS NOT NULL)
SELECT 'not_null' AS check_name, 'symbol' AS column_name, count(*) FILTER (symbol IS NULL) AS failures FROM rows_twice
UNION ALL SELECT 'not_null', 'dt', count(*) FILTER (dt IS NULL) FROM rows_twice
UNION ALL SELECT 'not_null', 'close', count(*) FILTER (close IS NULL) FROM rows_twice
UNION ALL SELECT 'not_null', 'volume', count(*) FILTER (volume IS NULL) FROM rows_twice
UNION ALL SELECT 'accepted_values', 'symbol', count(DISTINCT symbol) FROM rows_twice
  WHERE symbol NOT IN ('click', 'view')
UNION ALL SELECT 'unique', 'symbol, dt', count(*) FROM (
  SELECT symbol, dt FROM rows_twice GROUP BY symbol, dt HAVING count(*) > 1)""",
    "snapshot_initial": _first_history(ORD),
    "snapshot_second_run": _history(check=False),
    "snapshot_second_run_check": _history(check=True),
    "snapshot_two_corrections": _history(check=True, by=2),
    "snapshot_hard_delete": f"SELECT * FROM ({_history(check=False)}) WHERE valid_to IS NOT NULL",
    "snapshot_as_of": f"""SELECT * FROM ({_history(check=True)})
WHERE valid_from <= '2024-01-29 12:00:00' AND (valid_to IS NULL OR valid_to > '2024-01-29 12:00:00')""",
    "etl_run": f"SELECT {BARS} FROM ({_UPPER}) WHERE symbol <> 'ERROR'",
    "forecast_run": REPLACED,
    "forecast_rerun_gap": EV_EARLIER_FORECAST,
    "final_run": _final(),
    "models_run": _first_history(EV),
    "summary_refreshed": _summary_shown(
        f"""SELECT symbol, dt, open, high, low,
  CASE WHEN dt >= {ORD_START} THEN close + 1 ELSE close END AS close, volume
FROM (WITH o AS ({ORD}) SELECT * FROM o
  UNION ALL SELECT 'YOUNG', * EXCLUDE (symbol) FROM o WHERE symbol = '1-URGENT' AND dt >= DATE '2001-07-23'
  UNION ALL SELECT 'THIN', * EXCLUDE (symbol) FROM o WHERE symbol = '2-HIGH' AND day(dt) = 15)"""
    ),
    "full_run": _final(bars=_UPPER, as_of=AFTER_EVENTS),
    "stream_upsert": UPSERTED,
    "stream_out_of_order": UPSERTED,
    "snapshot_restated_month": RESTATED_MONTH,
    "etl_quarantine": f"""SELECT symbol, count(*) AS n_rows, CAST(max(dt) AS VARCHAR) AS dt,
  (SELECT count(*) FROM ({EV}) WHERE day(dt) = 5) AS n_rejected, (SELECT count(*) FROM ({EV}) WHERE day(dt) = 5) AS n_counted
FROM ({_UPPER}) WHERE day(dt) <> 5 GROUP BY symbol""",
    "bars_from_parts": f"SELECT {BARS} FROM ({EV})",
    "summary_symbols_changed": _summary_shown(
        f"SELECT * FROM ({ORD}) WHERE symbol IN ('2-HIGH', '3-MEDIUM', '5-LOW')"
    ),
    "kpi_with_gaps": GAPPY_KPIS,
    "kpi_range_from_months": RANGE_KPIS,
    "forecast_holt": HOLT_FORECAST,
    "forecast_holt_users": HOLT_USERS,
    "forecast_conformal": CONFORMAL,
    "conformal_coverage": COVERAGE,
    "forecast_function": f"""SELECT symbol, prediction_for, close_pred, lower_bound, upper_bound
FROM ({EV_FORECAST}) WHERE symbol = 'click'""",
    "forecast_accuracy": ACCURACY,
}
