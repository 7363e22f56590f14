"""Declared column lists of the stored tables (names, order and types are fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T


def schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

_BAR = dict(
    symbol="string",
    dt="date",
    open="double",
    high="double",
    low="double",
    close="double",
    volume="bigint",
)
_SUMMARY = dict(
    _BAR, daily_range="double", daily_return_pct="double", ma_7_day="double", ma_30_day="double"
)

RAW_BARS = schema(**_BAR)
STOCK_SUMMARY = schema(**_SUMMARY)
# The last rows of each symbol before a month, from which the moving averages of that month start.
SUMMARY_TAIL = schema(**_BAR, before="date")
# What a delivery of ticks says about a day; see operators/partials.
PARTIAL_BARS = schema(
    symbol="string",
    dt="date",
    delivery="string",
    first_at="bigint",
    first_price="double",
    high="double",
    low="double",
    last_at="bigint",
    last_price="double",
    n="bigint",
)
# What a month of a symbol says about a range's KPIs; see operators/ranges.
KPI_MONTHS = schema(
    symbol="string",
    month_dt="date",
    first_dt="date",
    first_close="double",
    last_dt="date",
    last_close="double",
    n="bigint",
    mean="double",
    m2="double",
)
# What the history was last compared with; see operators/history.
SNAPSHOT_DIGESTS = schema(month_dt="date", strategy="string", n_rows="bigint", mixed="bigint", total="string")
# Lines of landed files that could not be read.
REJECTED_LINES = schema(rejected_on="date", file="string", line="string", n_lines="bigint")
# The revision (time of landing) that each stored bar came from.
ARRIVALS = schema(symbol="string", dt="date", revision="bigint")
TRAIN = schema(symbol="string", ts="timestamp_ntz", close="double")
MODELS = schema(
    symbol="string",
    train_rows="bigint",
    first_dt="date",
    last_dt="date",
    first_close="double",
    last_close="double",
    status="string",
    slope="double",
    intercept="double",
    mean_x="double",
    sxx="double",
    sxy="double",
    syy="double",
    step="double",
    step_sd="double",
    alpha="double",
    beta="double",
    level="double",
    trend="double",
    sse="double",
)
FORECASTS = schema(
    symbol="string",
    ts="timestamp_ntz",
    close_pred="double",
    lower_bound="double",
    upper_bound="double",
    prediction_for="date",
    created_at="timestamp_ntz",
)
FINAL = schema(
    **_BAR,
    source="string",
    close_forecast="double",
    upper_bound_forecast="double",
    lower_bound_forecast="double",
    created_at="timestamp_ntz",
)
SNAPSHOT = schema(
    **_SUMMARY,
    scd_id="string",
    updated_at="date",
    valid_from="timestamp_ntz",
    valid_to="timestamp_ntz",
)
OUTCOMES = schema(symbol="string", stage="string", status="string", n_rows="bigint", message="string")

# Bars as they land: the date is still text and nothing has been checked.
LANDED = schema(
    dt="string",
    open="double",
    high="double",
    low="double",
    close="double",
    volume="double",
    symbol="string",
)

BAR_COLUMNS = RAW_BARS.fieldNames()
PRICE_COLUMNS = ["open", "high", "low", "close"]
VALUE_COLUMNS = [*PRICE_COLUMNS, "volume"]
KEY = ["symbol", "dt"]
