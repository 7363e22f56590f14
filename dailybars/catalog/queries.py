"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one is a short use of the library on bars made from the given tables. Results are shown with
days and times as text, and with averages, deviations and forecasts rounded, so that they can be
compared with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.catalog import inputs as data
from dailybars.functions.symbols import safe_symbol as safe
from dailybars.functions.symbols import symbols_in_text
from dailybars.operators import bars as ops
from dailybars.operators import checks, history, holt, ranges, report
from dailybars.operators import forecast as fc
from dailybars.operators.merge import duplicate_keys, merge_rows, replace_forecasts
from dailybars.plans import etl, forecasts, full, models
from dailybars.session import work_dir
from dailybars.settings import DEFAULT_HORIZON_DAYS as HORIZON
from dailybars.settings import DEFAULT_LOOKBACK_DAYS as LOOKBACK
from dailybars.settings import DEFAULT_PREDICTION_INTERVAL as INTERVAL
from dailybars.sources import landed
from dailybars.sources.materialize import materialize
from dailybars.streaming.landing import landed_stream, load_new_files, restate_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AVERAGES = ("ma_7_day", "ma_30_day")
PREDICTIONS = ("close_pred", "lower_bound", "upper_bound")
FINAL_PREDICTIONS = ("close_forecast", "upper_bound_forecast", "lower_bound_forecast")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def shown(rows: DataFrame, rounded: tuple[str, ...] = (), digits: int = 6) -> DataFrame:
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if field.name in rounded:
            column = F.round(column, digits)
        elif field.dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


# --- bars, ingest, cast -------------------------------------------------------------------------


@query
def bars_events_daily(spark, sf_dir):
    return shown(data.event_bars(spark, sf_dir))


@query
def bars_orders_daily(spark, sf_dir):
    return shown(data.order_bars(spark, sf_dir))


@query
def bars_users_daily(spark, sf_dir):
    return shown(data.user_bars(spark, sf_dir))


def _ingest(spark, sf_dir, fmt):
    """Csv days are written without leading zeros, which must not lose a row."""
    path = work_dir(spark, "landing")
    orders = data.order_bars(spark, sf_dir)
    writer = data.as_landed(orders, "yyyy-M-d" if fmt == "csv" else "yyyy-MM-dd").write
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    settings = data.run_settings(
        data.day_after(orders), symbols=(*data.ORDER_SYMBOLS, "ABSENT"), ingest_lookback_days=36500
    )
    bars = landed.read_bars(
        spark, path, fmt, settings.symbols, settings.ingest_start, settings.as_of
    )
    return shown(landed.cast_bars(bars))


@query
def ingest_bars(spark, sf_dir):
    return _ingest(spark, sf_dir, "parquet")


@query
def ingest_bars_csv(spark, sf_dir):
    return _ingest(spark, sf_dir, "csv")


@query
def ingest_bars_json(spark, sf_dir):
    return _ingest(spark, sf_dir, "json")


@query
def normalize_bars(spark, sf_dir):
    loose = data.order_bars(spark, sf_dir).select(
        F.col("dt").cast("timestamp_ntz").alias("Date"),
        F.col("open").alias("('Open', 'X')"),
        F.col("high").alias("HIGH"),
        F.struct(F.col("low").alias("X")).alias("Low"),
        F.col("close").alias("close"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Symbol"),
    )
    return landed.normalize_frame(loose).select(*landed.WANTED)


@query
def normalize_records(spark, sf_dir):
    records = landed.read_records(spark, data.land_records(spark, data.event_bars(spark, sf_dir)))
    return landed.normalize_records(records).select(
        "symbol", "dt", *(F.col(name).cast("double").alias(name) for name in schemas.VALUE_COLUMNS)
    )


@query
def outcomes_missing_cols(spark, sf_dir):
    path = data.land_records(spark, data.event_bars(spark, sf_dir), without_volume="error")
    bars = landed.normalize_records(landed.read_records(spark, path), with_absent=True)
    expected = data.event_bars(spark, sf_dir).unionByName(data.market_bars(spark, sf_dir))
    return landed.record_outcomes(bars, expected.select(F.upper("symbol").alias("symbol")))


@query
def cast_bars(spark, sf_dir):
    """Texts that are unusual but valid: days without leading zeros, blanks around numbers, decimals in volumes."""
    text = data.order_bars(spark, sf_dir).select(
        "symbol",
        F.date_format("dt", "yyyy-M-d").alias("dt"),
        *(F.concat(F.lit(" "), F.col(name).cast("string"), F.lit(" ")).alias(name) for name in schemas.PRICE_COLUMNS),
        F.concat(F.col("volume").cast("string"), F.lit(".9999999")).alias("volume"),
    )
    return shown(landed.cast_bars(text))


@query
def rows_per_symbol(spark, sf_dir):
    return ops.rows_per_symbol(data.user_bars(spark, sf_dir))


@query
def safe_symbol(spark, sf_dir):
    names = data.table(spark, sf_dir, "part").select("p_brand").union(
        data.table(spark, sf_dir, "orders").select("o_orderpriority")
    )
    counted = names.toDF("symbol").groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("safe_name", safe(F.col("symbol")))


@query
def parse_symbols(spark, sf_dir):
    part = data.table(spark, sf_dir, "part")
    listed = part.select(F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ,, "), "p_brand").alias("text"))
    as_json = part.select(F.to_json(F.array(F.lower("p_type"), F.concat("p_brand", F.lit(" ")))))
    symbols = listed.union(as_json).select(F.explode(symbols_in_text(F.col("text"))).alias("symbol"))
    return symbols.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"))


# --- stored tables ------------------------------------------------------------------------------


def _stored_events(spark, sf_dir):
    store = data.new_store(spark)
    store.upsert("raw_bars", data.event_bars(spark, sf_dir))
    return store


@query
def ensure_tables(spark, sf_dir):
    """Ensuring creates what is missing, empty, and leaves what is there."""
    store = data.new_store(spark)
    store.ensure()
    store.upsert("raw_bars", data.user_bars(spark, sf_dir))
    store.ensure()
    counts = [
        store.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in ("raw_bars", "forecasts", "final")
    ]
    return counts[0].union(counts[1]).union(counts[2])


@query
def upsert_bars(spark, sf_dir):
    return shown(merge_rows(data.earlier_bars(spark, sf_dir), data.incoming_bars(spark, sf_dir)))


@query
def upsert_idempotent(spark, sf_dir):
    """The same load twice, through the stored table."""
    store = data.new_store(spark)
    store.upsert("raw_bars", data.earlier_bars(spark, sf_dir))
    store.upsert("raw_bars", data.incoming_bars(spark, sf_dir))
    store.upsert("raw_bars", data.incoming_bars(spark, sf_dir))
    return shown(store.read("raw_bars"))


@query
def upsert_orders(spark, sf_dir):
    """Years of months: the second load rewrites the last seven."""
    store = data.new_store(spark)
    store.upsert("raw_bars", data.order_bars(spark, sf_dir))
    since = data.ORDERS_AS_OF - timedelta(days=LOOKBACK)
    revised = data.order_bars(spark, sf_dir, start=since).withColumn("volume", F.col("volume") + 1)
    store.upsert("raw_bars", revised)
    return shown(store.read("raw_bars"))


@query
def load_counts(spark, sf_dir):
    """The number of incoming rows a load reports, next to the rows stored."""
    store = data.new_store(spark)
    loaded = store.upsert("raw_bars", data.earlier_bars(spark, sf_dir))
    loaded += store.upsert("raw_bars", data.incoming_bars(spark, sf_dir))
    return store.read("raw_bars").agg(
        F.lit(loaded).cast("bigint").alias("loaded_rows"), F.count(F.lit(1)).alias("stored_rows")
    )


@query
def materialize_table(spark, sf_dir):
    store = data.new_store(spark)
    return shown(
        materialize(ops.summary(data.user_bars(spark, sf_dir)), "stock_summary", "table", store), AVERAGES
    )


@query
def delete_bars(spark, sf_dir):
    store = _stored_events(spark, sf_dir)
    store.delete("raw_bars", F.col("dt") >= F.lit(data.FIRST_AS_OF))
    return shown(store.read("raw_bars"))


# --- staging, indicators, summary ---------------------------------------------------------------


@query
def stg_bars(spark, sf_dir):
    staged = ops.stage_bars(data.with_gaps(data.order_bars(spark, sf_dir)))
    return shown(staged.withColumn("volume", F.col("volume").cast("double")))


@query
def lookback_bars(spark, sf_dir):
    return shown(ops.lookback(data.order_bars(spark, sf_dir), data.ORDERS_AS_OF, LOOKBACK))


def _indicator(name):
    def run(spark, sf_dir):
        rows = ops.summary(data.order_bars(spark, sf_dir)).select("symbol", "dt", name)
        return shown(rows, AVERAGES)

    run.__name__ = name
    return query(run)


for _name in ("daily_range", "daily_return_pct", "ma_7_day", "ma_30_day"):
    _indicator(_name)


@query
def stock_summary(spark, sf_dir):
    return shown(ops.summary(data.event_bars(spark, sf_dir)), AVERAGES)


@query
def stock_summary_orders(spark, sf_dir):
    return shown(ops.summary(data.order_bars(spark, sf_dir)), AVERAGES)


@query
def stock_summary_users(spark, sf_dir):
    return shown(ops.summary(data.user_bars(spark, sf_dir)), AVERAGES)


@query
def stock_summary_union(spark, sf_dir):
    """Staged bars of several inputs in one summary."""
    staged = ops.stage_bars(data.event_bars(spark, sf_dir)).unionByName(
        ops.stage_bars(data.order_bars(spark, sf_dir))
    )
    return shown(ops.summary(staged), AVERAGES)


@query
def summary_latest_30(spark, sf_dir):
    rows = ops.summary(data.order_bars(spark, sf_dir))
    return shown(report.latest_rows(rows, "1-URGENT"), AVERAGES)


# --- dashboard ----------------------------------------------------------------------------------


@query
def kpi_latest_price(spark, sf_dir):
    return shown(report.latest_price(data.order_bars(spark, sf_dir)))


@query
def kpi_total_return(spark, sf_dir):
    return shown(report.total_return(data.order_bars(spark, sf_dir)))


@query
def kpi_total_return_range(spark, sf_dir):
    since = data.ORDERS_AS_OF - timedelta(days=365)
    return shown(report.total_return(data.order_bars(spark, sf_dir), since, data.ORDERS_AS_OF))


@query
def volatility_by_symbol(spark, sf_dir):
    return shown(report.volatility(data.user_bars(spark, sf_dir)), ("volatility",))


@query
def volatility_30_day(spark, sf_dir):
    return shown(ops.rolling_deviation(data.order_bars(spark, sf_dir)), ("volatility_30_day",))


@query
def kpi_with_gaps(spark, sf_dir):
    """Days without a close or an open, some of them NaN; all three KPIs."""
    day = F.dayofmonth("dt")
    bars = data.with_gaps(data.order_bars(spark, sf_dir)).where(F.col("dt").isNotNull())
    bars = bars.withColumn("close", F.when(day % 3 == 1, float("nan")).otherwise(F.col("close")))
    bars = bars.withColumn("open", F.when(day % 4 == 2, float("nan")).otherwise(F.col("open")))
    kpis = report.latest_price(bars).join(report.total_return(bars).drop("last_close"), "symbol")
    return shown(kpis.join(report.volatility(bars), "symbol"), ("volatility", "total_return_pct"))


@query
def kpi_range_from_months(spark, sf_dir):
    """A range of years from stored parts by month; only the two months that it cuts are read as bars."""
    store, bars = data.new_store(spark), data.order_bars(spark, sf_dir)
    store.upsert("raw_bars", bars)
    store.upsert("kpi_months", ranges.month_parts(bars))
    found = ranges.range_kpis(
        lambda since, until: store.read("raw_bars", since, until),
        store.read("kpi_months", data.RANGE[0].replace(day=1), data.RANGE[1]),
        *data.RANGE,
    )
    return shown(found, ("total_return_pct", "volatility"), digits=9)


# --- forecasts ----------------------------------------------------------------------------------


def _train(bars, as_of, days=LOOKBACK):
    return fc.train_rows(bars, as_of, days)


def _event_forecast(spark, sf_dir, method="trend", end=None, business_days=False):
    train = _train(data.event_bars(spark, sf_dir, end=end), data.EVENTS_AS_OF)
    fitted = fc.fit(train, with_steps=method == "drift")
    return fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS, method, business_days)


def _order_forecast(spark, sf_dir, method):
    since = data.ORDERS_AS_OF - timedelta(days=LOOKBACK)
    train = _train(data.order_bars(spark, sf_dir, start=since), data.ORDERS_AS_OF)
    fitted = fc.fit(train, with_steps=method == "drift")
    return fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS, method)


@query
def train_view(spark, sf_dir):
    return shown(_train(data.order_bars(spark, sf_dir), data.ORDERS_AS_OF))


@query
def train_counts(spark, sf_dir):
    return fc.train_counts(_train(data.user_bars(spark, sf_dir), data.EVENTS_AS_OF))


@query
def model_params(spark, sf_dir):
    fitted = fc.fit(_train(data.event_bars(spark, sf_dir), data.EVENTS_AS_OF))
    return shown(
        fitted, ("slope", "intercept", "mean_x", "sxx", "sxy", "syy", "step", "step_sd"), digits=4
    )


@query
def forecast_trend(spark, sf_dir):
    return shown(_event_forecast(spark, sf_dir), PREDICTIONS)


@query
def forecast_drift(spark, sf_dir):
    return shown(_event_forecast(spark, sf_dir, "drift"), PREDICTIONS[1:])


@query
def forecast_trend_orders(spark, sf_dir):
    return shown(_order_forecast(spark, sf_dir, "trend"), PREDICTIONS, digits=4)


@query
def forecast_drift_orders(spark, sf_dir):
    return shown(_order_forecast(spark, sf_dir, "drift"), PREDICTIONS[1:], digits=4)


@query
def forecast_trend_users(spark, sf_dir):
    fitted = fc.fit(_train(data.user_bars(spark, sf_dir), data.EVENTS_AS_OF), with_steps=False)
    return shown(fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS), PREDICTIONS, digits=4)


@query
def forecast_business_days(spark, sf_dir):
    return shown(_event_forecast(spark, sf_dir, business_days=True), PREDICTIONS)


@query
def forecast_holt(spark, sf_dir):
    fitted = holt.fit(_train(data.event_bars(spark, sf_dir), data.EVENTS_AS_OF))
    return shown(fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS, "holt"), PREDICTIONS)


@query
def forecast_holt_users(spark, sf_dir):
    """Many short series: weights and state of each."""
    fitted = holt.fit(_train(data.user_bars(spark, sf_dir), data.EVENTS_AS_OF))
    chosen = fitted.select("symbol", "train_rows", "status", "alpha", "beta", "level", "trend", "sse")
    return shown(chosen, ("level", "trend", "sse"), digits=5)


@query
def forecast_conformal(spark, sf_dir):
    """Bounds from past errors by step; thin symbols have none for far steps."""
    fitted = holt.fit(_train(data.user_bars(spark, sf_dir), data.EVENTS_AS_OF))
    bounds = holt.conformal(fitted, 7, 0.8).select("symbol", "h", "close_pred", "lower_bound", "upper_bound", "n_errors")
    return shown(bounds, PREDICTIONS, digits=5)


@query
def conformal_coverage(spark, sf_dir):
    """How many held-out days lie inside both kinds of bounds, by step."""
    train = _train(data.user_bars(spark, sf_dir), data.EVENTS_AS_OF)
    return holt.coverage(train, 5, 0.8, fc.normal_quantile(0.8))


@query
def forecast_function(spark, sf_dir):
    """Predictions by SQL from the stored models."""
    store = _stored_events(spark, sf_dir)
    forecasts.run_training(store, data.run_settings(data.EVENTS_AS_OF))
    forecasts.register_forecast_function(store)
    return shown(spark.sql("SELECT * FROM forecast_of('click', 14)"), PREDICTIONS)


@query
def forecast_accuracy(spark, sf_dir):
    """Actual closes against the newest of several predictions that was made before the day."""
    made = [
        fc.forecast(
            fc.fit(_train(data.event_bars(spark, sf_dir, end=day), data.EVENTS_AS_OF), with_steps=False),
            HORIZON, INTERVAL, datetime.combine(day, datetime.min.time()),
        )
        for day in data.EARLIER_RUNS
    ]
    predictions = made[0].unionByName(made[1]).unionByName(made[2])
    return shown(
        report.prediction_errors(data.event_bars(spark, sf_dir), predictions), ("close_pred", "error", "error_pct")
    )


@query
def forecasts_from_as_of(spark, sf_dir):
    made_earlier = _event_forecast(spark, sf_dir, end=data.FIRST_AS_OF)
    return shown(fc.from_as_of(made_earlier, data.EVENTS_AS_OF), PREDICTIONS)


@query
def pred_counts(spark, sf_dir):
    made_earlier = _event_forecast(spark, sf_dir, end=data.FIRST_AS_OF)
    return fc.pred_counts(made_earlier, data.EVENTS_AS_OF)


@query
def forecast_outcomes(spark, sf_dir):
    """A window of three days: users without an event on each of them are skipped."""
    since = data.EVENTS_AS_OF - timedelta(days=3)
    bars = data.user_bars(spark, sf_dir, start=since)
    fitted = fc.fit(_train(bars, data.EVENTS_AS_OF, 3), with_steps=False)
    made = fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS)
    return fc.outcomes(fitted, made, data.EVENTS_AS_OF)


@query
def forecast_replace(spark, sf_dir):
    existing = _event_forecast(spark, sf_dir, end=data.FIRST_AS_OF)
    fresh = _event_forecast(spark, sf_dir)
    return shown(replace_forecasts(existing, fresh, data.EVENTS_AS_OF), PREDICTIONS)


def _final(spark, sf_dir, gaps=False):
    bars = data.event_bars(spark, sf_dir)
    bars = data.with_gaps(bars) if gaps else bars
    fitted = fc.fit(_train(bars, data.EVENTS_AS_OF), with_steps=False)
    return fc.final_table(
        bars,
        fc.forecast(fitted, HORIZON, INTERVAL, data.RUN_TS),
        data.EVENTS_AS_OF,
        LOOKBACK,
        data.RUN_TS,
    )


def _shown_final(rows, rounded=FINAL_PREDICTIONS):
    """Volumes as floating point: whole numbers with gaps look different in each data frame library."""
    return shown(rows.withColumn("volume", F.col("volume").cast("double")), rounded)


@query
def final_union(spark, sf_dir):
    """Bars without a close are kept, and not trained on."""
    return _shown_final(_final(spark, sf_dir, gaps=True))


@query
def final_union_legacy(spark, sf_dir):
    legacy = tuple(fc.LEGACY_NAMES.get(name, name) for name in FINAL_PREDICTIONS)
    return _shown_final(fc.legacy_names(_final(spark, sf_dir)), legacy)


@query
def actual_vs_predicted(spark, sf_dir):
    return _shown_final(report.actual_and_predicted(_final(spark, sf_dir)))


# --- data tests and history ---------------------------------------------------------------------


@query
def check_not_null(spark, sf_dir):
    rows = ops.summary(data.with_gaps(data.user_bars(spark, sf_dir)))
    return checks.not_null(rows, (*checks.SUMMARY_NOT_NULL, "daily_return_pct"))


@query
def check_accepted_values(spark, sf_dir):
    rows = ops.summary(data.event_bars(spark, sf_dir))
    return checks.unaccepted_values(rows, "symbol", ("click", "view"))


@query
def check_unique_key(spark, sf_dir):
    return duplicate_keys(data.table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


@query
def check_summary(spark, sf_dir):
    bars = data.event_bars(spark, sf_dir)
    twice = bars.unionByName(data.event_bars(spark, sf_dir, start=data.FIRST_AS_OF))
    return checks.check_summary(ops.summary(data.with_gaps(twice)), ("click", "view"))


def _second_summary(spark, sf_dir, by=1):
    """A symbol less, a close restated on one day, and the days after the first run."""
    restated = (F.col("symbol") == "view") & (F.col("dt") == F.lit(data.RESTATED_FROM))
    bars = (
        data.event_bars(spark, sf_dir)
        .where(F.col("symbol") != "click")
        .withColumn("close", F.when(restated, F.col("close") + by).otherwise(F.col("close")))
    )
    return ops.summary(bars)


def _second_history(spark, sf_dir, strategy="timestamp"):
    """History after two runs. Both states and their difference are written, so computed once."""
    store = data.new_store(spark)
    first = history.first_version(ops.summary(data.earlier_bars(spark, sf_dir)))
    known = store.keep(first)
    current = store.keep(_second_summary(spark, sf_dir))
    found = store.keep(history.find_changes(known, current, strategy))
    return history.next_version(known, current, found, data.RUN_TS, strategy)


@query
def snapshot_initial(spark, sf_dir):
    return shown(history.first_version(ops.summary(data.order_bars(spark, sf_dir))), AVERAGES)


@query
def snapshot_second_run(spark, sf_dir):
    return shown(_second_history(spark, sf_dir), AVERAGES)


@query
def snapshot_second_run_check(spark, sf_dir):
    return shown(_second_history(spark, sf_dir, "check"), AVERAGES)


@query
def snapshot_hard_delete(spark, sf_dir):
    """The versions closed because their key vanished."""
    closed = _second_history(spark, sf_dir).where(F.col("valid_to").isNotNull())
    return shown(closed, AVERAGES)


@query
def snapshot_two_corrections(spark, sf_dir):
    """Two restatements of one close at one run time: the second takes the place of the first."""
    store = data.new_store(spark)
    settings = data.run_settings(data.EVENTS_AS_OF, snapshot_strategy="check")
    store.overwrite("snapshot", history.first_version(ops.summary(data.earlier_bars(spark, sf_dir))))
    for by in (1, 2):
        store.overwrite("stock_summary", _second_summary(spark, sf_dir, by))
        models.take_snapshot(store, settings)
    return shown(store.read("snapshot"), AVERAGES)


@query
def snapshot_as_of(spark, sf_dir):
    second = _second_history(spark, sf_dir, "check")
    return shown(history.valid_at(second, datetime(2024, 1, 29, 12, 0, 0)), AVERAGES)


# --- whole runs ---------------------------------------------------------------------------------


@query
def etl_run(spark, sf_dir):
    """Two loads from landed records; one symbol has no volume and stays out."""
    store = data.new_store(spark)
    for end, as_of in ((data.FIRST_AS_OF, data.FIRST_AS_OF), (None, data.day_after(data.event_bars(spark, sf_dir)))):
        path = data.land_records(spark, data.event_bars(spark, sf_dir, end=end), without_volume="error")
        etl.run_etl(store, data.run_settings(as_of), path)
    return shown(store.read("raw_bars"))


@query
def etl_quarantine(spark, sf_dir):
    """Every line of one day is cut off in the middle: the others load, these are kept as they came, and counted."""
    bars, path = data.event_bars(spark, sf_dir), work_dir(spark, "landing")
    line = F.to_json(F.struct(F.col("dt").alias("Date"), *schemas.VALUE_COLUMNS, F.col("symbol").alias("Symbol")))
    cut = F.when(F.dayofmonth("dt") == 5, F.substring(line, 1, 40)).otherwise(line)
    bars.select(cut.alias("value")).write.text(path)
    store = data.new_store(spark)
    etl.run_etl(store, data.run_settings(data.day_after(bars), quarantine=True), path)
    rejected = store.read("rejected_lines").agg(F.sum("n_lines").alias("n_rejected"))
    counted = store.read("etl_outcomes").where("stage = 'read'").select(F.col("n_rows").alias("n_counted"))
    loaded = store.read("raw_bars").groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.max("dt").alias("dt"))
    both = rejected.withColumn("one", F.lit(1)).join(counted.withColumn("one", F.lit(1)), "one", "left")
    return shown(loaded.withColumn("one", F.lit(1)).join(both, "one").drop("one"))


@query
def snapshot_restated_month(spark, sf_dir):
    """Two runs over years of days; a month restated in between is the only one compared."""
    store = data.new_store(spark)
    settings = data.run_settings(data.EVENTS_AS_OF, snapshot_strategy="check")
    bars = data.order_bars(spark, sf_dir)
    for by in (0, 1):
        restated = F.trunc("dt", "month") == F.lit(data.RESTATED_MONTH)
        close = F.when(restated, F.col("close") + by).otherwise(F.col("close"))
        store.overwrite("stock_summary", ops.summary(bars.withColumn("close", close)))
        models.take_snapshot(store, settings)
    return shown(store.read("snapshot"), AVERAGES)


@query
def forecast_run(spark, sf_dir):
    """An earlier and a later run over the stored bars; predictions of both that are still kept."""
    store = data.new_store(spark)
    for end, as_of in ((data.FIRST_AS_OF, data.FIRST_AS_OF), (None, data.EVENTS_AS_OF)):
        store.upsert("raw_bars", data.event_bars(spark, sf_dir, end=end))
        forecasts.run_forecast(store, data.run_settings(as_of))
    return shown(store.read("forecasts"), PREDICTIONS)


@query
def forecast_rerun_gap(spark, sf_dir):
    """The last bar lies some days before the run date, and the run is done twice: one row for each key."""
    store = data.new_store(spark)
    store.upsert("raw_bars", data.earlier_bars(spark, sf_dir))
    for _ in range(2):
        forecasts.run_forecast(store, data.run_settings(data.EVENTS_AS_OF))
    return shown(store.read("forecasts"), PREDICTIONS)


@query
def final_run(spark, sf_dir):
    store = _stored_events(spark, sf_dir)
    forecasts.run_forecast(store, data.run_settings(data.EVENTS_AS_OF))
    return _shown_final(store.read("final"))


@query
def models_run(spark, sf_dir):
    """Build, test, snapshot after each of two loads; the history."""
    store = data.new_store(spark)
    for end, as_of in ((data.FIRST_AS_OF, data.FIRST_AS_OF), (None, data.EVENTS_AS_OF)):
        store.upsert("raw_bars", data.event_bars(spark, sf_dir, end=end))
        models.run_models(store, data.run_settings(as_of))
    return shown(store.read("snapshot"), AVERAGES)


@query
def summary_refreshed(spark, sf_dir):
    """The last 180 days restated, with a new and a thin symbol, and only their months built again."""
    store, settings = data.new_store(spark), data.run_settings(data.ORDERS_AS_OF)
    bars = data.listed_later(data.order_bars(spark, sf_dir))
    store.upsert("raw_bars", bars.where(F.col("symbol") != "YOUNG"))
    models.build_summary(store, settings)
    revised = bars.where(F.col("dt") >= F.lit(settings.ingest_start))
    store.upsert("raw_bars", revised.withColumn("close", F.col("close") + 1))
    models.refresh_summary(store, settings, settings.ingest_start)
    return shown(store.read("stock_summary"), AVERAGES)


@query
def full_run(spark, sf_dir):
    """Landed records to forecasts, tested summary and history; the final table."""
    bars = data.event_bars(spark, sf_dir)
    settings = data.run_settings(data.day_after(bars), symbols=data.EVENT_SYMBOLS)
    root = work_dir(spark, "tables")
    store = full.store_for(spark, root, settings, prefix=f"run_{root[-12:]}_")
    full.run_all(store, settings, data.land_records(spark, bars))
    return _shown_final(store.read("final"))


@query
def stream_upsert(spark, sf_dir):
    """Two deliveries picked up by the file stream, the second one restating part of the first."""
    store, landing = data.new_store(spark), work_dir(spark, "landing")
    checkpoint = work_dir(spark, "stream")
    for bars in (data.earlier_bars(spark, sf_dir), data.incoming_bars(spark, sf_dir)):
        data.as_landed(bars).write.mode("append").parquet(landing)
        load_new_files(store, landed_stream(spark, landing), checkpoint).awaitTermination()
    return shown(store.read("raw_bars"))


@query
def stream_out_of_order(spark, sf_dir):
    """The newer file is picked up first; the older one, in a later batch, does not take its rows back."""
    store, landing = data.new_store(spark), work_dir(spark, "landing")
    checkpoint, schema = work_dir(spark, "stream"), schemas.schema(**data.LANDED_REVISION)
    for revision, bars in ((2, data.incoming_bars(spark, sf_dir)), (1, data.earlier_bars(spark, sf_dir))):
        rows = data.as_landed(bars).withColumn("revision", F.lit(revision).cast("bigint"))
        rows.write.mode("append").parquet(landing)
        stream = landed_stream(spark, landing, schema=schema)
        load_new_files(store, stream, checkpoint, revision="revision").awaitTermination()
    return shown(store.read("raw_bars"))


@query
def bars_from_parts(spark, sf_dir):
    """Ticks in three deliveries that share days, one of them delivered twice, in no order."""
    store, ticks = data.new_store(spark), data.table(spark, sf_dir, "events")
    for part in (2, 0, 1, 0):
        delivery = ticks.where(F.col("event_id") % 3 == part)
        restate_days(store, delivery, f"part {part}", "event_type", "ts", "value", "event_id")
    return shown(store.read("raw_bars"))


@query
def summary_symbols_changed(spark, sf_dir):
    """An incremental build after a symbol has left the run and another one, with years of bars, has joined."""
    store = data.new_store(spark)
    store.upsert("raw_bars", data.order_bars(spark, sf_dir))
    before = data.run_settings(data.ORDERS_AS_OF - timedelta(days=40), symbols=data.ORDER_SYMBOLS[:3])
    after = data.run_settings(data.ORDERS_AS_OF, symbols=(*data.ORDER_SYMBOLS[1:3], data.ORDER_SYMBOLS[4]))
    models.build_summary(store, before)
    models.refresh_summary(store, after, after.ingest_start)
    return shown(store.read("stock_summary"), AVERAGES)
