"""Moments as literals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    """A wall-clock time, untouched by the zones of the session or of the machine."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
