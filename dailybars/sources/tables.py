"""Stored tables: Spark's own Parquet tables in the catalog, partitioned by month.

A change computes the new rows of the months it touches, writes them to the table's staging folder, and inserts what
was written with ``spark.sql.sources.partitionOverwriteMode=dynamic``: the months that occur in the rows are replaced,
the others are not opened. Any session with the same catalog, and any engine that reads Parquet folders, sees plain
tables.

What is and is not atomic: rows that cannot be computed fail before the table is touched. Within an insert, Spark swaps
the months one after another, so a reader at that time can see some of them old and some new, and a job that dies there
leaves the table so. The staged rows are still there then. The next change of that table, or ``repair``, inserts them
again before anything else, which gives what the interrupted insert would have given. One writer per table at a time.

Bars, summary, forecasts, history and the final table are split by month, not by symbol: a daily run restates a few
recent months of every symbol, so it rewrites those months and leaves the rest of the history alone, and the number of
folders follows the calendar however many symbols there are. Rows are dealt by month and symbol bucket; adaptive
execution joins the small pieces and splits the large ones, so a month has few files, each sorted by symbol.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailybars import schemas
from dailybars.operators.merge import duplicate_keys, latest_per_key, merge_rows, without

# Pieces a month can be dealt into before adaptive execution joins or splits them.
_BUCKETS = 16
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class DuplicateKeys(ValueError):
    """The incoming rows have more than one row for a key."""


class MissingKeys(ValueError):
    """The incoming rows have a key column without a value."""


class OtherLocation(ValueError):
    """The catalog has a table of this name with its files elsewhere."""


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    month_of: str | None  # date column whose month a row is filed under; None = not partitioned


TABLES = {
    table.name: table
    for table in (
        Table("raw_bars", schemas.RAW_BARS, ("symbol", "dt"), "dt"),
        Table("partial_bars", schemas.PARTIAL_BARS, ("symbol", "dt", "delivery"), "dt"),
        Table("arrivals", schemas.ARRIVALS, ("symbol", "dt"), "dt"),
        Table("models", schemas.MODELS, ("symbol",), None),
        Table("forecasts", schemas.FORECASTS, ("symbol", "prediction_for"), "prediction_for"),
        Table("forecast_archive", schemas.FORECASTS, ("symbol", "prediction_for", "created_at"), "prediction_for"),
        Table("final", schemas.FINAL, ("symbol", "dt", "source"), "dt"),
        Table("stock_summary", schemas.STOCK_SUMMARY, ("symbol", "dt"), "dt"),
        Table("summary_tail", schemas.SUMMARY_TAIL, ("symbol", "dt"), None),
        Table("kpi_months", schemas.KPI_MONTHS, ("symbol", "month_dt"), "month_dt"),
        Table("snapshot", schemas.SNAPSHOT, ("symbol", "dt", "scd_id"), "dt"),
        Table("snapshot_digests", schemas.SNAPSHOT_DIGESTS, ("month_dt", "strategy"), None),
        Table("rejected_lines", schemas.REJECTED_LINES, ("rejected_on", "file", "line"), "rejected_on"),
        Table("etl_outcomes", schemas.OUTCOMES, ("symbol", "stage"), None),
        Table("forecast_outcomes", schemas.OUTCOMES, ("symbol", "stage"), None),
    )
}


def _month(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


class TableStore:
    """The tables below one root folder that all executors reach.

    ``schema_of`` gives the catalog schema of each table; without it all are in one schema named after the root.
    """

    def __init__(self, spark: SparkSession, root: str, schema_of: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema_of = schema_of or {}
        self._known: set[str] = set()  # tables found in the catalog, at their place
        self._own_schema = f"bars_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"

    # --- names and folders ----------------------------------------------------------------------

    def schema_name(self, name: str) -> str:
        return self.schema_of.get(name, self._own_schema)

    def full_name(self, name: str) -> str:
        return f"`{self.schema_name(name)}`.`{name}`"

    def folder(self, name: str) -> str:
        schema = self.schema_of.get(name)
        return f"{self.root}/{schema}/{name}" if schema else f"{self.root}/{name}"

    def _staging(self, name: str) -> str:
        return f"{self.root}/_staging/{name}"

    def _path(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, path: str) -> bool:
        files, path = self._path(path)
        return files.exists(path)

    def _remove(self, path: str) -> None:
        files, path = self._path(path)
        files.delete(path, True)

    # --- reading --------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        """In the catalog, or below the root from a session whose catalog is gone."""
        if name not in self._known:
            full = self.full_name(name)
            if not self.spark.catalog.tableExists(full) and not self._there(self.folder(name)):
                return False
            self._create(name)
        return True

    def ensure(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """Create the tables that do not exist yet, empty."""
        for name in names:
            self._create(name)

    def _create(self, name: str) -> None:
        if name in self._known:
            return
        table, full, folder = TABLES[name], self.full_name(name), self.folder(name)
        if not self.spark.catalog.tableExists(full):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
            parts = " PARTITIONED BY (month)" if table.month_of else ""
            columns += ", month STRING" if table.month_of else ""
            there = self._there(folder)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.schema_name(name)}`")
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet{parts} LOCATION '{folder}'")
            if there and table.month_of:
                self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
            self._path(folder)[0].mkdirs(self._path(folder)[1])
        found = self.spark.sql(f"DESCRIBE FORMATTED {full}").where("col_name = 'Location'").first().data_type
        if self._path(found)[1].toUri().getPath() != self._path(folder)[1].toUri().getPath():
            raise OtherLocation(f"{full} has its files in {found}, not in {folder}")
        self._known.add(name)

    def months(self, name: str) -> set[str]:
        """The months that a partitioned table has."""
        if not self.exists(name):
            return set()
        return {row.partition.split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self.full_name(name)}").collect()}

    def read(self, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
        """The table; with limits, rows filed in [since, until], other months unopened."""
        table = TABLES[name]
        rows = self._rows(table)
        if table.month_of is not None:
            if since is not None:
                rows = rows.where(F.col("month") >= since.strftime("%Y-%m")).where(F.col(table.month_of) >= F.lit(since))
            if until is not None:
                rows = rows.where(F.col("month") <= until.strftime("%Y-%m")).where(F.col(table.month_of) <= F.lit(until))
        return rows.select(*table.schema.fieldNames())

    def read_months(self, name: str, months: set[str]) -> DataFrame:
        """The rows filed in these months, others unopened."""
        table = TABLES[name]
        return self._rows(table, months).select(*table.schema.fieldNames())

    def _rows(self, table: Table, months: set[str] | None = None) -> DataFrame:
        """All columns with ``month``; of these months only."""
        if not self.exists(table.name):
            # a constant condition, so that the optimizer knows there are no rows
            fields = [*table.schema, *([T.StructField("month", T.StringType())] if table.month_of else [])]
            nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in fields)
            return self.spark.range(1).where(F.lit(False)).select(*nothing)
        rows = self.spark.table(self.full_name(table.name))
        return rows if months is None else rows.where(F.col("month").isin(sorted(months)))

    def register_views(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """Temporary views of the tables, for SQL."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    # --- writing --------------------------------------------------------------------------------

    def upsert(self, name: str, incoming: DataFrame, order_by: str | None = None) -> int:
        """Update or insert by key; returns the number of incoming rows.

        The incoming rows are written first, so that they are computed once and every later step reads files. More than
        one row per key is refused unless ``order_by`` names the column whose greatest value wins; rows of a key that
        tie there are refused too.
        """
        table = TABLES[name]
        columns = [*table.schema.fieldNames()]
        if order_by is not None and order_by not in columns:
            columns.append(order_by)
        self.repair(name)
        with self.kept(incoming.select(*columns)) as staged:
            tally = self._tally(table, staged, order_by)
            if not tally.n_rows:
                return 0
            if tally.without_key:
                raise MissingKeys(f"{tally.without_key} keys of {name} have no value in {table.keys}")
            if tally.repeated:
                keys = table.keys if order_by is None else (*table.keys, order_by)
                sample = [tuple(row)[:-1] for row in duplicate_keys(staged, keys).limit(3).collect()]
                raise DuplicateKeys(f"{tally.repeated} keys of {name} occur more than once, e.g. {sample}")
            if order_by is not None:
                staged = latest_per_key(staged, order_by, table.keys)
            rows = staged.select(*table.schema.fieldNames())
            old = self._rows(table, None if table.month_of is None else set(tally.months))
            self._replace(table, merge_rows(old.select(*rows.columns), rows, table.keys), set(tally.months), filled=True)
        return tally.n_rows

    def overwrite(self, name: str, rows: DataFrame) -> None:
        """Replace the whole table. The rows may be computed from the table itself."""
        self.repair(name)
        self._replace(TABLES[name], rows, self.months(name) if TABLES[name].month_of else set())

    def rewrite(self, name: str, months: Iterable[str], rows: DataFrame) -> None:
        """Replace these months by the rows, which may be computed from the table itself.

        Rows filed in another month that the table has are refused before anything is changed.
        """
        self.repair(name)
        self._replace(TABLES[name], rows, set(months))

    def rewrite_from(self, name: str, since: date, rewrite: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the months from ``since`` on by ``rewrite(rows of those months)``."""
        self.repair(name)
        table = TABLES[name]
        touched = {month for month in self.months(name) if month >= since.strftime("%Y-%m")}
        self._replace(table, rewrite(self._rows(table, touched).select(*table.schema.fieldNames())), touched)

    def delete(self, name: str, predicate: Column) -> None:
        """Delete by predicate; a partitioned table rewrites only the months it hits."""
        self.repair(name)
        table = TABLES[name]
        if table.month_of is None:
            self._replace(table, without(self._rows(table), predicate), set())
            return
        hits = self._rows(table).where(predicate).select("month").distinct().collect()
        touched = {row.month for row in hits}
        if touched:
            self._replace(table, without(self._rows(table, touched), predicate), touched)

    def replace_symbols(self, name: str, symbols: Iterable[str] | None, rows: DataFrame) -> None:
        """All rows of these symbols (``None``: of all) give way to the new ones.

        Only months that have or had a row of theirs are rewritten; other symbols' rows there are carried over.
        """
        if symbols is None:
            self.overwrite(name, rows)
            return
        self.repair(name)
        table = TABLES[name]
        own = F.col("symbol").isin(list(symbols))
        with self.kept(rows.select(*table.schema.fieldNames())) as fresh:
            before = self._rows(table).where(own).select("month")
            after = fresh.select(_month(table.month_of).alias("month"))
            touched = {row.month for row in before.unionByName(after).distinct().collect()}
            if touched:
                others = self._rows(table, touched).where(~own).select(*fresh.columns)
                self._replace(table, others.unionByName(fresh), touched)

    def keep(self, rows: DataFrame) -> DataFrame:
        """Write an intermediate result and read it back, so that later steps do not compute it again.

        Each call has a folder of its own, which no other writer can disturb; ``clear_kept`` removes them all.
        """
        path = f"{self.root}/_kept/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @contextmanager
    def kept(self, rows: DataFrame) -> Iterator[DataFrame]:
        """As ``keep``, until the block ends."""
        path = f"{self.root}/_kept/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            self._remove(path)

    def clear_kept(self) -> None:
        """Remove intermediate results. Not while a run goes on or their rows are still read."""
        self._remove(f"{self.root}/_kept")

    def repair(self, name: str) -> bool:
        """Insert again what an interrupted change had staged; says whether there was anything."""
        staging = self._staging(name)
        if not self._there(f"{staging}/_SUCCESS"):
            return False
        table = TABLES[name]
        self._create(name)
        # A swap that died between two steps can have lost a folder that the catalog still lists, or the reverse.
        if table.month_of:
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.full_name(name))
        self._insert(table)
        return True

    # --- one change -----------------------------------------------------------------------------

    def _tally(self, table: Table, staged: DataFrame, order_by: str | None = None) -> Row:
        """Row count, bad keys and months of the staged rows in one job over the key columns.

        With an order only rows that share the greatest value of a key count as repeated.
        """
        month = F.lit(None).cast("string") if table.month_of is None else _month(table.month_of)
        without_key = F.lit(False)
        for key in table.keys:
            without_key = without_key | F.col(key).isNull()
        if order_by is None:
            per_key = staged.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("n"))
            per_key = per_key.withColumn("at_top", F.col("n"))
        else:
            ties = staged.groupBy(*table.keys, order_by).agg(F.count(F.lit(1)).alias("n"))
            per_key = ties.groupBy(*table.keys).agg(
                F.max_by("n", order_by).alias("at_top"), F.sum("n").alias("n")
            )
        return per_key.agg(
            F.sum("n").alias("n_rows"),
            F.count_if(without_key).alias("without_key"),
            F.count_if(F.col("at_top") > 1).alias("repeated"),
            F.collect_set(month).alias("months"),
        ).first()

    def _replace(self, table: Table, rows: DataFrame, touched: set[str], filled: bool = False) -> None:
        """Stage the rows, then let them take the place of the touched months (or of the whole table).

        ``filled`` says that the rows are of the touched months, and that none of these ends up empty.
        """
        self._create(table.name)
        rows = rows.select(*table.schema.fieldNames())
        if table.month_of is not None:
            rows = rows.withColumn("month", _month(table.month_of))
        if table.month_of is not None and touched and not filled:
            # Months that may end up empty are named by a row without values, so that a repair knows them too.
            names = self.spark.range(1).select(F.explode(F.array(*map(F.lit, sorted(touched)))).alias("month"))
            blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
            rows = rows.unionByName(names.select(*blank, "month"))
        rows.write.mode("overwrite").parquet(self._staging(table.name))
        self._insert(table, touched, filled)

    def _staged(self, table: Table) -> DataFrame:
        schema = table.schema if table.month_of is None else T.StructType([*table.schema, T.StructField("month", T.StringType())])
        return self.spark.read.schema(schema).parquet(self._staging(table.name))

    def _insert(self, table: Table, touched: set[str] | None = None, filled: bool = False) -> None:
        """The staged rows into the table; then the staging folder goes."""
        full, staged = self.full_name(table.name), self._staged(table)
        if table.month_of is None:
            staged.write.insertInto(full, overwrite=True)
            self._remove(self._staging(table.name))
            return
        if filled:
            counts, existing = dict.fromkeys(touched, 1), set()
        else:
            counts = {r.month: r.n for r in staged.groupBy("month").agg(F.count(table.month_of).alias("n")).collect()}
            existing = self.months(table.name)
        outside = set() if touched is None else (set(counts) - touched) & existing
        if outside:
            self._remove(self._staging(table.name))
            raise ValueError(f"{table.name}: new rows filed in months not read: {sorted(outside)}")
        if any(counts.values()):
            spread = next(key for key in table.keys if key != table.month_of)
            bucket = F.pmod(F.xxhash64(spread), F.lit(_BUCKETS))
            dealt = (
                staged.where(F.col(table.month_of).isNotNull())
                .withColumn("bucket", bucket)
                .hint("rebalance", "month", "bucket")
                .drop("bucket")
                .sortWithinPartitions("month", spread, table.month_of)
            )
            with self._dynamic():
                dealt.write.insertInto(full, overwrite=True)
        for month in sorted(month for month, n in counts.items() if not n and month in existing):
            self.spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION (month = '{month}')")
            self._remove(f"{self.folder(table.name)}/month={month}")
        self._remove(self._staging(table.name))

    @contextmanager
    def _dynamic(self) -> Iterator[None]:
        before = self.spark.conf.get(_OVERWRITE_MODE)
        self.spark.conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(_OVERWRITE_MODE, before)
