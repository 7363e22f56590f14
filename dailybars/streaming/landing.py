"""Load bar files, or deliveries of ticks, as they land.

The file source remembers in its checkpoint which files it has seen; every micro-batch is upserted.
A batch that is run again after a failure gives the same table: bars go by key and revision, parts of bars by the
delivery's name, which a repeated batch has again.
Moving averages are computed in batch over the table this keeps up to date: frames of rows need all
earlier bars of a symbol, which a stream does not hold.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dailybars import schemas
from dailybars.operators.partials import bars_of, partial_bars
from dailybars.sources.landed import cast_bars, in_window
from dailybars.sources.tables import TableStore


def landed_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = schemas.LANDED,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """New files as a stream, each row with the time its file landed."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    landed = F.col("_metadata.file_modification_time").alias("landed_at")
    return reader.load(path).select("*", landed)


def load_new_files(
    store: TableStore,
    stream: DataFrame,
    checkpoint: str,
    symbols: Iterable[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    revision: str = "landed_at",
) -> StreamingQuery:
    """Upsert everything that has landed since the last call, then stop.

    Of several rows for a key the one with the newest revision wins, in whichever batch it comes: each stored bar's
    revision is kept in ``arrivals``, and a row older than that changes nothing. Rows of a key with one revision are
    refused within a batch, as a batch load does; from another batch they take the place of the stored one, so a batch
    can be run again. ``revision`` is a time or a whole number; a row without one is older than all others.
    """
    wanted = None if symbols is None else list(symbols)

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        rows = in_window(batch, wanted, start, end)
        kind = rows.schema[revision].dataType
        number = F.unix_micros(F.col(revision)) if isinstance(kind, T.TimestampType) else F.col(revision).cast("bigint")
        number = F.coalesce(number, F.lit(-(2**63)).cast("bigint"))
        bars = cast_bars(rows.withColumn("revision", number), keep=["revision"])
        with store.kept(bars) as landed:
            first, last = landed.agg(F.min("dt"), F.max("dt")).first()
            if first is None and landed.isEmpty():
                return
            stored = store.read("arrivals", since=first, until=last).withColumnRenamed("revision", "stored")
            newer = landed.join(stored, schemas.KEY, "left").where("stored IS NULL OR revision >= stored").drop("stored")
            with store.kept(newer.select(*landed.columns)) as fresh:
                store.upsert("raw_bars", fresh, order_by="revision")
                store.upsert("arrivals", fresh.select(*schemas.KEY, "revision"), order_by="revision")

    return _available_now(stream, upsert, checkpoint)


def restate_days(
    store: TableStore, ticks: DataFrame, delivery: str, symbol: str | Column, ts: str, price: str, order: str
) -> int:
    """Merge a delivery of ticks into the stored parts and give the days it touches their bars anew.

    Reads the delivery's ticks and the stored parts of the months it touches; no other ticks. The same delivery again
    replaces itself. Returns the number of days of symbols that it touched.
    """
    parts = partial_bars(ticks, symbol, ts, price, order).withColumn("delivery", F.lit(delivery))
    with store.kept(parts.select(*schemas.PARTIAL_BARS.fieldNames())) as fresh:
        n = store.upsert("partial_bars", fresh)
        if n:
            first, last = fresh.agg(F.min("dt"), F.max("dt")).first()
            known = store.read("partial_bars", since=first, until=last)
            store.upsert("raw_bars", bars_of(known.join(fresh.select(*schemas.KEY), schemas.KEY, "left_semi")))
    return n


def load_new_ticks(
    store: TableStore, stream: DataFrame, checkpoint: str, name: str, symbol: str | Column, ts: str, price: str, order: str
) -> StreamingQuery:
    """As ``load_new_files``, for ticks: each micro-batch is a delivery. ``name`` tells this stream's from others."""

    def restate(batch: DataFrame, batch_id: int) -> None:
        restate_days(store, batch, f"{name}-{batch_id}", symbol, ts, price, order)

    return _available_now(stream, restate, checkpoint)


def _available_now(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
