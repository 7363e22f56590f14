"""Landed bar files: read, bring column names into one shape, skip incomplete symbols, cast."""

from __future__ import annotations

import ast
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailybars import schemas
from dailybars.functions.casts import to_bigint, to_day, to_double
from dailybars.functions.symbols import clean_symbol

WANTED = schemas.LANDED.fieldNames()


def in_window(
    bars: DataFrame, symbols: Iterable[str] | None, start: date | None, end: date | None
) -> DataFrame:
    """Bars of the wanted symbols with a day in [start, end).

    Texts are compared as the days they stand for. A bar whose day is missing or unreadable stays, so that the cast
    and the key check see it; no bar is lost here for the way its day is written.
    """
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(list(symbols)))
    typed = isinstance(bars.schema["dt"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    day = F.col("dt") if typed else F.col("dt").try_cast("date")
    if start is not None:
        bars = bars.where(day.isNull() | (day >= F.lit(start)))
    if end is not None:
        bars = bars.where(day.isNull() | (day < F.lit(end)))
    return bars


def read_bars(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    symbols: Iterable[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    schema: T.StructType | None = None,
    landed_since: date | None = None,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Landed bars in canonical columns (parquet, orc, csv with header, or json lines).

    Parquet and orc files bring their own column types, csv and json are read with the landed ones. A line that cannot
    be read fails the read; with ``keep_unreadable`` it is a row of its own, with the columns of ``UNREADABLE`` only.
    """
    reader, text = spark.read, fmt in ("csv", "json")
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if schema is None and text:
        schema = schemas.LANDED
    if text and keep_unreadable:
        schema = T.StructType([*schema, T.StructField(UNREADABLE[0], T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREADABLE[0])
        loaded = _since(reader.format(fmt), path, landed_since, schema)
        loaded = loaded.select(*WANTED, UNREADABLE[0], F.col("_metadata.file_path").alias(UNREADABLE[1]))
        broken = F.col(UNREADABLE[0]).isNotNull()
        # What the parser made of the start of a broken line is not used.
        loaded = loaded.select(*(F.when(~broken, F.col(c)).alias(c) for c in WANTED), *UNREADABLE)
        if symbols is not None:
            loaded = loaded.where(broken | F.col("symbol").isin(list(symbols)))
        return in_window(loaded, None, start, end)
    if text:
        reader = reader.option("mode", "FAILFAST")
    loaded = _since(reader.format(fmt), path, landed_since, schema)
    return in_window(loaded.select(*WANTED), symbols, start, end)


# The text of a line that could not be read, and its file.
UNREADABLE = ("bad_line", "bad_file")


def rejected_lines(rows: DataFrame, on: date) -> DataFrame:
    """What could not be read, each line of a file once, with its number of copies."""
    bad = rows.where(F.col(UNREADABLE[0]).isNotNull())
    counted = bad.groupBy(F.col(UNREADABLE[1]).alias("file"), F.col(UNREADABLE[0]).alias("line"))
    return counted.agg(F.count(F.lit(1)).alias("n_lines")).withColumn("rejected_on", F.lit(on))


def rejected_outcome(rejected: DataFrame) -> DataFrame:
    """One outcome row, of no symbol, that counts the rejected lines; none if there are none."""
    counted = rejected.agg(F.sum("n_lines").alias("n_rows")).where("n_rows > 0")
    message = F.concat(F.lit("lines that could not be read: "), F.col("n_rows").cast("string"))
    return counted.select(
        F.lit("").alias("symbol"), F.lit("read").alias("stage"), F.lit("rejected").alias("status"), "n_rows", message.alias("message")
    )


# Name of the folder level that says when files landed: <path>/landed=2024-01-30/...
LANDED_LEVEL = "landed"


def _since(
    reader: DataFrameReader, path: str, landed_since: date | None, schema: T.StructType | None = None
) -> DataFrame:
    """What has landed from a day on, or everything.

    Where files lie in a folder per landing day the others are not listed as input; elsewhere files that were
    last modified before are left out.
    """
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    if landed_since is None:
        return rows
    if LANDED_LEVEL in rows.columns:
        return rows.where(F.col(LANDED_LEVEL) >= F.lit(landed_since))
    return reader.option("modifiedAfter", f"{landed_since.isoformat()}T00:00:00").load(path)


# --- frames whose headers are loose ------------------------------------------------------------


def _first_level(name: str) -> str:
    """``"('Close', 'ABC')"`` -> ``Close``: headers of several levels keep their first one."""
    if name.startswith("(") and name.endswith(")"):
        try:
            parts = ast.literal_eval(name)
        except (SyntaxError, ValueError):
            return name
        if isinstance(parts, tuple) and parts:
            return str(parts[0])
    return name


def normalize_frame(frame: DataFrame, symbol: str | None = None) -> DataFrame:
    """One level of lower-case names, the date column called ``dt``, ``symbol`` added if given.

    The date column is the one named ``date`` or ``dt`` in any case, or else the first column.
    """
    columns = []
    for field in frame.schema.fields:
        source = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StructType) and len(field.dataType.fields) == 1:
            source = source.getField(field.dataType.fields[0].name)
        columns.append((_first_level(field.name).lower(), source))
    names = ["dt" if name == "date" else name for name, _ in columns]
    if "dt" not in names:
        names[0] = "dt"
    out = frame.select(*(source.alias(name) for name, (_, source) in zip(names, columns)))
    out = out.withColumn("dt", _day_text(F.col("dt")))
    return out if symbol is None else out.withColumn("symbol", F.lit(symbol))


def _day_text(day: Column) -> Column:
    """``yyyy-MM-dd``; what is no day stays as it is, for the cast to refuse."""
    return F.coalesce(F.date_format(day.try_cast("timestamp_ntz"), "yyyy-MM-dd"), day.cast("string"))


def missing_columns(frame: DataFrame) -> list[str]:
    return [name for name in schemas.VALUE_COLUMNS if name not in frame.columns]


def frames_as_bars(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Frames of single symbols as one set of text columns, with the entries each frame lacks.

    Only the frames' column names are looked at here; the rows stay where they are.
    """
    parts = []
    for symbol, frame in frames.items():
        rows = normalize_frame(frame, symbol.strip().upper())
        absent = missing_columns(rows)
        values = (
            (F.lit(None) if name in absent else F.col(name)).cast("string").alias(name)
            for name in schemas.VALUE_COLUMNS
        )
        lacking = F.array(*map(F.lit, absent)).cast("array<string>").alias("absent")
        parts.append(rows.select("dt", *values, "symbol", lacking))
    return reduce(DataFrame.unionByName, parts)


def no_bars(spark: SparkSession) -> DataFrame:
    """What ``frames_as_bars`` gives for no frames at all."""
    columns = ", ".join(f"{name} string" for name in ("dt", *schemas.VALUE_COLUMNS, "symbol"))
    return spark.createDataFrame([], f"{columns}, absent array<string>")


# --- records whose headers are loose -----------------------------------------------------------


def read_records(
    spark: SparkSession, path: str, landed_since: date | None = None, keep_unreadable: bool = False
) -> DataFrame:
    """JSON lines with any header spelling: (symbol, record), a record being a map of texts.

    All symbols are read in one scan, whatever shape each one's records have. A line that is no JSON object fails the
    read; with ``keep_unreadable`` it is a row without a record, with the columns of ``UNREADABLE``. Two spellings of one
    header in a record count as unreadable then, too. Blank lines are left out.
    """
    mode = "PERMISSIVE" if keep_unreadable else "FAILFAST"
    parsed = F.from_json("value", "map<string,string>", {"mode": mode})

    def lowered(record: Column) -> Column:
        return F.transform_keys(record, lambda key, _: F.lower(_first_level_column(key)))

    lines = _since(spark.read.format("text"), path, landed_since)
    if not keep_unreadable:
        lines = lines.select(lowered(parsed).alias("record"))
        return lines.select(clean_symbol(F.col("record")["symbol"]).alias("symbol"), "record")
    lines = lines.where(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("file"), parsed.alias("parsed")
    )
    names = F.transform(F.map_keys("parsed"), lambda key: F.lower(_first_level_column(key)))
    fine = F.col("parsed").isNotNull() & (F.size(F.array_distinct(names)) == F.size(names))
    record = F.when(fine, lowered(F.when(fine, F.col("parsed"))))
    lines = lines.withColumn("record", record)
    bad = F.col("record").isNull()
    return lines.select(
        clean_symbol(F.col("record")["symbol"]).alias("symbol"),
        "record",
        F.when(bad, F.col("value")).alias(UNREADABLE[0]),
        F.when(bad, F.col("file")).alias(UNREADABLE[1]),
    )


def _first_level_column(name):
    inner = F.regexp_extract(name, r"^\('([^']*)',.*\)$", 1)
    return F.when(inner != "", inner).otherwise(name)


def normalize_records(records: DataFrame, with_absent: bool = False) -> DataFrame:
    """Canonical text columns; the date is under ``date`` or ``dt``, or else in the first entry.

    ``with_absent`` adds the names of the required entries a record does not have (an entry that is
    there without a value counts as there).
    """
    record = F.col("record")
    day = F.coalesce(record["dt"], record["date"], F.map_values(record)[0])
    absent = F.array_except(_required(), F.map_keys("record"))
    return records.select(
        _day_text(day).alias("dt"),
        *(record[name].alias(name) for name in schemas.VALUE_COLUMNS),
        "symbol",
        *([absent.alias("absent")] if with_absent else []),
        *(name for name in UNREADABLE if name in records.columns),
    )


def _required():
    return F.array(*(F.lit(name) for name in schemas.VALUE_COLUMNS))


def record_outcomes(bars: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Per symbol: ``ok``, ``missing`` (no record has some required entry) or ``empty``.

    ``bars`` come from ``normalize_records(..., with_absent=True)``; ``expected`` (symbol) adds the
    symbols that should have delivered and did not.
    """
    everywhere = [
        F.min(F.array_contains("absent", name)).alias(f"no_{name}") for name in schemas.VALUE_COLUMNS
    ]
    found = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), *everywhere)
    lacking = F.array_join(
        F.array(*(F.when(F.col(f"no_{name}"), F.lit(name)) for name in schemas.VALUE_COLUMNS)), ", "
    )
    found = found.select("symbol", "n_rows", lacking.alias("lacking"))
    if expected is not None:
        found = expected.select("symbol").distinct().join(found, "symbol", "left")
    empty, missing = F.col("n_rows").isNull(), F.col("lacking") != ""
    return found.select(
        "symbol",
        F.lit("extract").alias("stage"),
        F.when(empty, "empty").when(missing, "missing").otherwise("ok").alias("status"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
        F.when(empty, "no data returned")
        .when(missing, F.concat(F.lit("missing columns: "), F.col("lacking")))
        .otherwise(F.concat(F.lit("ok (rows="), F.col("n_rows").cast("string"), F.lit(")")))
        .alias("message"),
    )


def complete_symbols(bars: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Bars of the symbols that lack no column; the others are left out, and nothing else is."""
    incomplete = outcomes.where(F.col("status") == "missing").select("symbol")
    return bars.join(incomplete, "symbol", "left_anti")


# --- cast ---------------------------------------------------------------------------------------


def fitting(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leniently cast bars that can be stored, and per symbol an outcome that counts the others.

    A bar without a symbol, a readable day or a volume is rejected; other values that do not fit become missing.
    """
    cast = cast_bars(bars, lenient=True)
    whole = F.col("symbol").isNotNull() & F.col("dt").isNotNull() & F.col("volume").isNotNull()
    rejected = cast.where(~whole).groupBy(F.coalesce("symbol", F.lit("")).alias("symbol")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    rejected = rejected.select(
        "symbol",
        F.lit("cast").alias("stage"),
        F.lit("rejected").alias("status"),
        "n_rows",
        F.concat(F.lit("rows without a readable day or volume: "), F.col("n_rows").cast("string")).alias("message"),
    )
    return cast.where(whole), rejected


def cast_bars(bars: DataFrame, lenient: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns in table order, then those of ``keep`` as they are.

    A value that does not fit fails the batch unless lenient.
    """
    volume_type = bars.schema["volume"].dataType.simpleString()
    return bars.select(
        F.col("symbol").cast("string").alias("symbol"),
        to_day("dt", lenient),
        *(to_double(name, lenient) for name in schemas.PRICE_COLUMNS),
        to_bigint("volume", volume_type, lenient),
        *keep,
    )
