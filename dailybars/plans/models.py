"""Stored bars -> summary table -> data tests -> history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.operators import history
from dailybars.operators.bars import LONG_ROWS, stage_bars, summary
from dailybars.operators.checks import check_summary, require_passing
from dailybars.settings import Settings
from dailybars.sources.materialize import materialize
from dailybars.sources.tables import TableStore


def build_summary(store: TableStore, settings: Settings) -> DataFrame:
    """Build the whole table, and keep what the next incremental run starts from."""
    first = settings.ingest_start.replace(day=1)
    built = materialize(summary(store.read("raw_bars"), settings.symbols), "stock_summary", "table", store)
    earlier = stage_bars(store.read("raw_bars", until=first - timedelta(days=1)), settings.symbols)
    store.overwrite("summary_tail", _tail(store, settings, earlier, first))
    return built


def _tail(store: TableStore, settings: Settings, earlier: DataFrame, first: date) -> DataFrame:
    """What the summary covers up to ``first``, and the rows that a frame beginning there can reach back to.

    A row without a day says that its symbol is covered; one without a symbol either, that all symbols are. The others
    are the last rows of each symbol before ``first``.
    """
    newest = Window.partitionBy("symbol").orderBy(F.desc("dt"))
    rows = earlier.withColumn("back", F.row_number().over(newest)).where(F.col("back") < LONG_ROWS)
    rows = rows.select(*schemas.BAR_COLUMNS, F.lit(first).alias("before"))
    names = F.array(*map(F.lit, (None,) if settings.symbols is None else settings.symbols)).cast("array<string>")
    covered = store.spark.range(1).select(F.explode(names).alias("symbol"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW_BARS if f.name != "symbol"]
    return rows.unionByName(covered.select("symbol", *blank, F.lit(first).alias("before")))


def refresh_summary(store: TableStore, settings: Settings, since: date) -> tuple[DataFrame, date]:
    """Build again from the month of ``since`` on; gives the rows from the first day that was built, and that day.

    The last build kept, for each symbol it covers, up to which day (``before``) and the last 29 rows before that. A
    symbol that is covered up to ``since`` or earlier starts from these; no older month is opened for it, however new or
    thin it is. A symbol that joins the run, or whose entry begins later than ``since``, is built from all its bars in
    the same job, and one that leaves the run is taken out of all months. So the table equals a whole build, as long as
    no bar before ``since`` of a covered symbol has changed since the last one.
    """
    first = since.replace(day=1)
    wanted = settings.symbols
    kept = store.read("summary_tail")
    covered = kept.where("dt IS NULL").select("symbol", "before")
    trusted = covered.where(F.col("before") <= F.lit(first))
    oldest, everything, n_covered = trusted.agg(
        F.min("before"), F.bool_or(F.col("symbol").isNull()), F.count(F.lit(1))
    ).first()
    known = None if everything else trusted.select("symbol")
    if known is not None and wanted is not None:
        known = known.where(F.col("symbol").isin(list(wanted)))
    if everything or (wanted is not None and known.count() == len(wanted)):
        joining = kept.where(F.lit(False))
    else:
        joining = stage_bars(store.read("raw_bars"), wanted).join(known, "symbol", "left_anti")

    # Covered symbols: the rows that were kept, and the bars since the day up to which they reach.
    tail = kept.where(F.col("dt").isNotNull() & (F.col("before") <= F.lit(first))).select(*schemas.BAR_COLUMNS)
    tail = tail if wanted is None else tail.where(F.col("symbol").isin(list(wanted)))
    later = stage_bars(store.read("raw_bars", since=oldest or first), wanted)
    later = later if known is None else later.join(known, "symbol", "left_semi")
    bars = tail.unionByName(later) if n_covered else later.where(F.lit(False))
    bars = bars.select(*schemas.BAR_COLUMNS, F.lit(first).alias("from_dt"))
    bars = bars.unionByName(joining.select(*schemas.BAR_COLUMNS, F.lit(None).cast("date").alias("from_dt")))
    starts = bars.select("symbol", "from_dt").distinct()
    built = summary(bars).join(starts, "symbol")
    built = built.where(F.col("from_dt").isNull() | (F.col("dt") >= F.col("from_dt")))
    with store.kept(built.drop("from_dt")) as rows:
        start = _put(store, rows, first, _leaving(store, wanted, covered), joining)
    earlier = bars.where(F.col("dt") < F.lit(first)).select(*schemas.BAR_COLUMNS)
    store.overwrite("summary_tail", _tail(store, settings, earlier, first))
    return store.read("stock_summary", since=start), start


def _leaving(store: TableStore, wanted: tuple[str, ...] | None, covered: DataFrame) -> DataFrame | None:
    """Symbols of the table that the run does not have; None if there are none."""
    if wanted is None:
        return None
    names = covered.where("symbol IS NOT NULL").select("symbol")
    if covered.where("symbol IS NULL").count():
        names = store.read("stock_summary").select("symbol").distinct()
    leaving = names.where(~F.col("symbol").isin(list(wanted))).distinct()
    return leaving if leaving.count() else None


def _put(store: TableStore, rows: DataFrame, first: date, leaving: DataFrame | None, joining: DataFrame) -> date:
    """The built rows into the table; gives the first day of the months that were rewritten."""
    month = F.date_format("dt", "yyyy-MM").alias("month")
    older = {r.month for r in rows.where(F.col("dt") < F.lit(first)).select(month).distinct().collect()}
    recent = {m for m in store.months("stock_summary") if m >= first.strftime("%Y-%m")}
    before = store.read("stock_summary", until=first - timedelta(days=1))
    if older or leaving is not None:
        gone = joining.select("symbol").distinct()
        gone = gone if leaving is None else gone.unionByName(leaving)
        held = before.join(gone, "symbol", "left_semi").select(month).distinct()
        older |= {r.month for r in held.collect()}
        others = before.where(month.isin(sorted(older))) if older else before.where(F.lit(False))
        rows = others.join(gone, "symbol", "left_anti").select(*rows.columns).unionByName(rows)
    store.rewrite("stock_summary", recent | older, rows)
    return date.fromisoformat(f"{min(older)}-01") if older else first


def take_snapshot(store: TableStore, settings: Settings, since: date | None = None) -> int:
    """Bring the history up to date; only months with a changed row are rewritten.

    The last comparison left a digest of each month of the summary, which the open versions equal since then. Only
    months with another digest now are read and joined; with ``since`` only those from its month on. Returns the number
    of versions closed and opened. (Whoever changes the history by hand deletes ``snapshot_digests``.)
    """
    strategy = settings.snapshot_strategy
    store.ensure(["snapshot", "snapshot_digests"])
    since = None if since is None else since.replace(day=1)
    with store.kept(history.month_digests(store.read("stock_summary", since=since), strategy)) as digests:
        before = store.read("snapshot_digests").where(F.col("strategy") == strategy)
        earlier = before.where(F.lit(False)) if since is None else before.where(F.col("month_dt") < F.lit(since))
        before = before if since is None else before.where(F.col("month_dt") >= F.lit(since))
        months = {f"{r.month_dt:%Y-%m}" for r in history.changed_months(before, digests).collect()}
        if not earlier.union(before).limit(1).count():
            # Nothing is known of the history: all of its months are compared.
            months |= {m for m in store.months("snapshot") if since is None or m >= f"{since:%Y-%m}"}
        if not months:
            return 0
        known, current = store.read_months("snapshot", months), store.read_months("stock_summary", months)
        with store.kept(history.find_changes(known, current, strategy)) as found:
            rows = history.apply_changes(known, current, found, settings.run_ts, strategy)
            n = store.upsert("snapshot", rows)
        store.overwrite("snapshot_digests", earlier.unionByName(digests))
    return n


def run_models(store: TableStore, settings: Settings, since: date | None = None) -> list[Row]:
    """Build, test, snapshot. A failed test raises before the history is touched.

    ``since`` limits all three to the months from that day on, which is enough after a load that
    brought no earlier bars; a symbol that joins or leaves the run adds the months it has.
    """
    if since is None:
        built = build_summary(store, settings)
    else:
        built, since = refresh_summary(store, settings, since)
    checks = require_passing(check_summary(built, settings.symbols))
    take_snapshot(store, settings, since)
    return checks
