"""Bars and landed files made from the given tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.session import work_dir
from dailybars.settings import Settings
from dailybars.sources.tables import TableStore
from dailybars.sources.ticks import daily_bars

# Run dates: the day after the last event and after the last order.
EVENTS_AS_OF = date(2024, 1, 31)
ORDERS_AS_OF = date(2001, 8, 2)
# An earlier run over the same events, and the overlap in which the later run restates bars.
FIRST_AS_OF = date(2024, 1, 28)
RESTATED_FROM = date(2024, 1, 25)
# Earlier runs whose predictions are compared with what came, and a range of days that cuts two months.
EARLIER_RUNS = (date(2024, 1, 18), date(2024, 1, 22), date(2024, 1, 26))
RANGE = (date(1998, 3, 15), date(2001, 5, 10))
RESTATED_MONTH = date(2000, 7, 1)
RUN_TS = datetime(2024, 1, 31, 6, 0, 0)

LANDED_REVISION = {f.name: f.dataType.simpleString() for f in schemas.LANDED} | {"revision": "bigint"}

EVENT_SYMBOLS = ("click", "error", "purchase", "signup", "view")
ORDER_SYMBOLS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None):
    """One symbol per event type. Event ids are unique and rise with time."""
    ticks = table(spark, sf_dir, "events")
    return daily_bars(ticks, "event_type", "ts", "value", "event_id", start, end)


def user_bars(spark: SparkSession, sf_dir: str, start: date | None = None):
    """One symbol per user: many symbols with gaps in their days."""
    return daily_bars(table(spark, sf_dir, "events"), "user_id", "ts", "value", "event_id", start)


def order_bars(spark: SparkSession, sf_dir: str, start: date | None = None):
    """One symbol per order priority: years of days."""
    ticks = table(spark, sf_dir, "orders")
    return daily_bars(ticks, "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey", start)


def market_bars(spark: SparkSession, sf_dir: str, start: date | None = None):
    """A symbol of its own made of all events."""
    ticks = table(spark, sf_dir, "events")
    return daily_bars(ticks, F.lit("market"), "ts", "value", "event_id", start)


def earlier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the earlier run left behind."""
    return event_bars(spark, sf_dir, end=FIRST_AS_OF)


def incoming_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the later run brings: restated bars, new days and a new symbol."""
    restated = event_bars(spark, sf_dir, start=RESTATED_FROM).select(
        "symbol", "dt", *((F.col(name) + 1).alias(name) for name in schemas.VALUE_COLUMNS)
    )
    return restated.unionByName(market_bars(spark, sf_dir, start=RESTATED_FROM))


def day_after(bars: DataFrame) -> date:
    """The run date of a load that takes all bars there are."""
    last = bars.agg(F.max("dt")).first()[0]
    return last + timedelta(days=1) if last else EVENTS_AS_OF


def with_gaps(bars: DataFrame) -> DataFrame:
    """Some days without a day, a close or a volume, and some opens of zero, by the day of the month."""
    day = F.dayofmonth("dt")
    return bars.select(
        "symbol",
        F.when(day % 13 != 7, F.col("dt")).alias("dt"),
        F.when(day % 5 == 1, F.lit(0.0)).otherwise(F.col("open")).alias("open"),
        "high",
        "low",
        F.when(day % 7 != 3, F.col("close")).alias("close"),
        F.when(day % 11 != 5, F.col("volume")).alias("volume"),
    )


def listed_later(bars: DataFrame) -> DataFrame:
    """The bars, a symbol that is listed in the last ten days only, and one with a bar a month."""
    young = bars.where((F.col("symbol") == "1-URGENT") & (F.col("dt") >= F.lit(ORDERS_AS_OF - timedelta(days=10))))
    thin = bars.where((F.col("symbol") == "2-HIGH") & (F.dayofmonth("dt") == 15))
    return bars.unionByName(young.withColumn("symbol", F.lit("YOUNG"))).unionByName(
        thin.withColumn("symbol", F.lit("THIN"))
    )


def as_landed(bars: DataFrame, day_format: str = "yyyy-MM-dd") -> DataFrame:
    """Bars in the columns of a landed file."""
    return bars.select(
        F.date_format("dt", day_format).alias("dt"),
        *schemas.PRICE_COLUMNS,
        F.col("volume").cast("double").alias("volume"),
        "symbol",
    )


def land_records(spark: SparkSession, bars: DataFrame, without_volume: str | None = None) -> str:
    """JSON lines with loosely spelled headers; one symbol may lack its volume altogether."""
    path = work_dir(spark, "landing")
    volume = F.col("volume")
    if without_volume is not None:
        volume = F.when(F.col("symbol") != without_volume, volume)
    bars.select(
        F.col("dt").alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("HIGH"),
        F.col("low").alias("('Low', 'X')"),
        F.col("close").alias("Close"),
        volume.alias("Volume"),
        F.concat(F.lit(" "), "symbol").alias("Symbol"),
    ).write.json(path)
    return path


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, work_dir(spark, "tables"))


def run_settings(as_of: date, **more) -> Settings:
    return Settings(as_of=as_of, **{"symbols": None, "run_ts": RUN_TS, **more})
