"""As-of join: each left row with the newest right row of its group from before its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEFT, RIGHT = "left_row", "right_row"


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, strict: bool = True
) -> DataFrame:
    """The columns of left, and of right without ``by``: NULL where no right row is earlier.

    ``strict`` leaves out right rows of the very time. Of right rows of one time the one with the greatest other columns
    (in their order) counts, so reruns agree. Left rows without a time or key stay, and find nothing.

    Both sides are put under each other, shuffled once by ``by`` and sorted by time; a running value carries the newest
    right row down to the left ones. No pair of rows is ever listed, so a group costs its rows and not their product; a
    range condition in a join would list every earlier right row for every left one.
    """
    taken = set(left.columns) & (set(right.columns) - set(by))
    if taken:
        raise ValueError(f"both sides have {sorted(taken)}")
    values = [c for c in right.columns if c not in by]
    empty_left = F.lit(None).cast(_struct_type(left, left.columns))
    empty_right = F.lit(None).cast(_struct_type(right, values))
    # At one time, right rows come first unless they must not be seen.
    side = F.lit(0 if strict else 1)
    lefts = left.select(*by, F.col(left_time).alias("at"), side.alias("side"), F.struct(*left.columns).alias(LEFT), empty_right.alias(RIGHT))
    order = F.struct(right_time, *[c for c in values if c != right_time])
    rights = right.where(F.col(right_time).isNotNull()).groupBy(*by, F.col(right_time).alias("at")).agg(
        F.max_by(F.struct(*values), order).alias(RIGHT)
    )
    rights = rights.select(*by, "at", (F.lit(1) - side).alias("side"), empty_left.alias(LEFT), RIGHT)
    before = Window.partitionBy(*by).orderBy("at", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(RIGHT, ignorenulls=True).over(before)
    known = F.col("at").isNotNull()
    for key in by:
        known = known & F.col(key).isNotNull()
    rows = lefts.unionByName(rights).select(LEFT, F.when(known, seen).alias("seen"))
    return rows.where(F.col(LEFT).isNotNull()).select(f"{LEFT}.*", *(F.col(f"seen.{c}").alias(c) for c in values))


def _struct_type(frame: DataFrame, names: Sequence[str]):
    return frame.select(F.struct(*names).alias("s")).schema["s"].dataType
