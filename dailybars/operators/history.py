"""Type-2 history of the summary: every version of a row with the time span in which it held.

strategy ``timestamp``  a row has a new version when its ``updated_at`` (its day) is later than the
                        open version's. The day is part of the key, so new days and vanished rows
                        show up, restated prices do not.
strategy ``check``      a row has a new version when one of its value columns differs.

New keys are valid from their day. A changed row (``check``) or a key that comes back after it had
vanished is valid from the run time, and its id is made from that time. A vanished key is closed at
the run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.functions.prices import key_text
from dailybars.functions.times import moment
from dailybars.operators.merge import merge_rows

STRATEGIES = ("timestamp", "check")
_DATA = schemas.STOCK_SUMMARY.fieldNames()
_COLUMNS = schemas.SNAPSHOT.fieldNames()
_IS_OPEN = "valid_to IS NULL"


def _scd_id(stamp: Column) -> Column:
    return F.md5(F.concat(key_text(), F.lit("|"), stamp.cast("string")))


def first_version(current: DataFrame) -> DataFrame:
    """History of a first run: every row open from its day."""
    return current.select(
        *_DATA,
        _scd_id(F.col("dt")).alias("scd_id"),
        F.col("dt").alias("updated_at"),
        F.col("dt").cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def find_changes(
    history: DataFrame,
    current: DataFrame,
    strategy: str = "timestamp",
    check_columns: Sequence[str] = tuple(schemas.VALUE_COLUMNS),
) -> DataFrame:
    """One row per key that differs: (symbol, dt, verdict).

    Verdicts are ``appeared``, ``came_back``, ``changed`` and ``vanished``. Both tables are compared
    whole, but only their keys and the compared columns are read and shuffled. The key is
    (symbol, dt), which spreads evenly however unequal the symbols are.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}: {strategy!r}")
    if strategy == "timestamp":
        old = history.where(_IS_OPEN).select(*schemas.KEY, F.struct("updated_at").alias("old"))
        new = current.select(*schemas.KEY, F.struct(F.col("dt").alias("updated_at")).alias("new"))
        differs = F.col("new.updated_at") > F.col("old.updated_at")
    else:
        old = history.where(_IS_OPEN).select(*schemas.KEY, F.struct(*check_columns).alias("old"))
        new = current.select(*schemas.KEY, F.struct(*check_columns).alias("new"))
        differs = ~F.col("old").eqNullSafe(F.col("new"))
    closed = history.where(f"NOT ({_IS_OPEN})").groupBy(*schemas.KEY).agg(F.lit(True).alias("was_closed"))
    verdict = (
        F.when(F.col("new").isNull(), "vanished")
        .when(F.col("old").isNull() & F.col("was_closed"), "came_back")
        .when(F.col("old").isNull(), "appeared")
        .when(differs, "changed")
    )
    compared = old.join(new, schemas.KEY, "full").join(closed, schemas.KEY, "left")
    return compared.select(*schemas.KEY, verdict.alias("verdict")).where(F.col("verdict").isNotNull())


def month_digests(
    current: DataFrame, strategy: str = "timestamp", check_columns: Sequence[str] = tuple(schemas.VALUE_COLUMNS)
) -> DataFrame:
    """(month_dt, strategy, n_rows, mixed, total): an order-free digest of what a comparison looks at, by month.

    One aggregate, combined before its shuffle. Two months with equal digests have equal keys and compared values, but
    for an accident of 64 bits in an exclusive or, in a sum and in a count at once.
    """
    compared = [*schemas.KEY, *(check_columns if strategy == "check" else ())]
    mark = F.xxhash64(*compared, *(F.col(c).isNull() for c in compared))
    return current.groupBy(F.trunc("dt", "month").alias("month_dt")).agg(
        F.lit(strategy).alias("strategy"),
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor(mark).alias("mixed"),
        F.sum(F.xxhash64(mark, F.lit(1)).cast("decimal(38,0)")).cast("string").alias("total"),
    )


def changed_months(before: DataFrame, now: DataFrame) -> DataFrame:
    """(month_dt) of the months whose digest is new, gone or different."""
    digest = F.struct("strategy", "n_rows", "mixed", "total")
    old, new = before.select("month_dt", digest.alias("old")), now.select("month_dt", digest.alias("new"))
    return old.join(new, "month_dt", "full").where(~F.col("old").eqNullSafe(F.col("new"))).select("month_dt")


def apply_changes(
    history: DataFrame, current: DataFrame, found: DataFrame, run_ts: datetime, strategy: str = "timestamp"
) -> DataFrame:
    """The rows to write: old versions closed and new versions opened, found by key.

    A version that began at this very run time and is changed again never held: the new one takes its id and place.
    """
    now = moment(run_ts)
    by_day = F.lit(strategy == "timestamp")
    closing = found.where(F.col("verdict").isin("changed", "vanished"))
    opening = found.where(F.col("verdict").isin("appeared", "came_back", "changed"))

    changed_by_day = (F.col("verdict") == "changed") & by_day
    close_at = F.when(changed_by_day, F.col("dt").cast("timestamp_ntz")).otherwise(now)
    closed = (
        history.where(_IS_OPEN)
        .join(closing, schemas.KEY)
        .withColumn("valid_to", close_at)
        .select(*_COLUMNS)
    )
    from_run = (F.col("verdict") == "came_back") | ((F.col("verdict") == "changed") & ~by_day)
    opened = (
        first_version(current)
        .join(opening, schemas.KEY)
        .withColumn("scd_id", F.when(from_run, _scd_id(now)).otherwise(F.col("scd_id")))
        .withColumn("valid_from", F.when(from_run, now).otherwise(F.col("valid_from")))
        .select(*_COLUMNS)
    )
    replaced = opened.select("scd_id", *schemas.KEY)
    return closed.join(replaced, ["scd_id", *schemas.KEY], "left_anti").select(*_COLUMNS).unionByName(opened)


def next_version(
    history: DataFrame, current: DataFrame, found: DataFrame, run_ts: datetime, strategy: str = "timestamp"
) -> DataFrame:
    """The whole history after a further run: what stays, what is closed, what is opened."""
    rows = apply_changes(history, current, found, run_ts, strategy)
    return merge_rows(history.select(*_COLUMNS), rows, (*schemas.KEY, "scd_id"))


def valid_at(history: DataFrame, when: datetime) -> DataFrame:
    """The rows that held at a moment."""
    t = moment(when)
    return history.where(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    )
