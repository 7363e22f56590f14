"""Casts that fail the batch on a value that does not fit, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _strict(source: Column, converted: Column, name: str, target: str) -> Column:
    message = F.concat(F.lit(f"cannot cast {name} to {target}: "), source.cast("string"))
    return F.when(source.isNotNull() & converted.isNull(), F.raise_error(message)).otherwise(converted)


def to_double(name: str, lenient: bool = False) -> Column:
    """A floating-point price; NaN is a missing one."""
    source = F.col(name)
    converted = source.try_cast("double")
    checked = converted if lenient else _strict(source, converted, name, "double")
    return F.when(~F.isnan(checked), checked).alias(name)


def to_bigint(name: str, source_type: str, lenient: bool = False) -> Column:
    """Whole number, decimals cut off; a missing or NaN value does not fit. Text goes through a wide decimal."""
    source = F.col(name)
    number = source.try_cast("decimal(38,18)") if source_type == "string" else source
    converted = number.try_cast("bigint")
    if lenient:
        return converted.alias(name)
    message = F.concat(F.lit(f"cannot cast {name} to bigint: "), F.coalesce(source.cast("string"), F.lit("no value")))
    return F.when(converted.isNull(), F.raise_error(message)).otherwise(converted).alias(name)


def to_day(name: str, lenient: bool = False) -> Column:
    """``yyyy-MM-dd`` text, a date or a timestamp to a date."""
    source = F.col(name)
    converted = source.try_cast("date")
    return (converted if lenient else _strict(source, converted, name, "date")).alias(name)
