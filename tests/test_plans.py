"""The physical plans: what is read, what is shuffled, what stays in the JVM."""

import re
from datetime import date, timedelta

import pytest

from dailybars import schemas
from dailybars.catalog.queries import QUERIES
from dailybars.operators import bars as ops
from dailybars.operators import checks, history, report
from dailybars.operators import forecast as fc
from dailybars.operators.merge import latest_per_key, merge_rows
from dailybars.session import scale_conf
from dailybars.sources.ticks import daily_bars

SF = "/root/testdata/sf0.001"
EVENTS = f"{SF}/events.parquet"
AS_OF = date(2024, 1, 31)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def count(frame, node):
    return len(re.findall(rf"[-+:] {node}\b", plan(frame)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Bars of every day of a year and a half, as one parquet table."""
    path = str(tmp_path_factory.mktemp("plans") / "bars")
    rows = [
        (s, date(2023, 1, 1) + timedelta(days=d), 1.0, 2.0, 0.5, 1.0 + d % 5, 10)
        for s in ("A", "B", "C")
        for d in range(540)
    ]
    spark.createDataFrame(rows, schemas.RAW_BARS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ticks_are_combined_before_the_shuffle(spark):
    bars = daily_bars(
        spark.read.parquet(EVENTS), "event_type", "ts", "value", "event_id", date(2024, 1, 5), AS_OF
    )
    text = plan(bars)
    assert count(bars, "Exchange") == 1
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "partial_min_by" in text
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text and "LessThan(ts,2024-01-31T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_summary_shuffles_and_sorts_once_for_both_frames(stored):
    rows = ops.summary(stored, ["A"])
    assert [count(rows, n) for n in ("Exchange", "Sort", "Window")] == [1, 1, 1]
    assert "EqualTo(symbol,A)" in plan(rows) and "IsNotNull(close)" in plan(rows)


def test_one_indicator_reads_three_columns(stored):
    text = plan(ops.summary(stored).select("symbol", "dt", "ma_7_day"))
    assert "ReadSchema: struct<symbol:string,dt:date,close:double>" in text


def test_limit_on_days_does_not_reach_below_the_frames(stored):
    text = plan(ops.summary(stored).where("dt >= DATE '2024-01-01'"))
    assert "GreaterThanOrEqual(dt" not in text


def test_latest_rows_need_no_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(report.latest_rows(ops.summary(stored), "A"))


def test_trend_is_combined_before_its_only_shuffle(stored):
    fitted = fc.fit(fc.train_rows(stored, AS_OF, 180), with_steps=False)
    text = plan(fitted)
    assert count(fitted, "Exchange") == 1
    assert "partial_regr" in text and text.index("partial_count") > text.index("Exchange")
    assert "Window" not in text
    assert "GreaterThanOrEqual(dt,2023-08-04)" in text
    assert "ReadSchema: struct<symbol:string,dt:date,close:double>" in text


def test_drift_shuffles_once(stored):
    assert count(fc.fit(fc.train_rows(stored, AS_OF, 180)), "Exchange") == 1


def test_merge_shuffles_each_side_once(stored):
    merged = merge_rows(stored, stored.where("dt >= DATE '2024-01-01'"))
    assert count(merged, "Exchange") == 2
    assert count(merged, "SortMergeJoin") == 1


def test_copies_are_combined_before_the_shuffle(stored):
    latest = latest_per_key(stored.withColumnRenamed("volume", "seen"), "seen")
    text = plan(latest)
    assert count(latest, "Exchange") == 1
    assert "partial_max_by" in text and "SortAggregate" not in text


def test_all_checks_read_the_table_once(stored):
    assert plan(checks.check_summary(stored, ["A"])).count("FileScan") == 1


def test_history_comparison_reads_and_shuffles_only_what_it_compares(spark, stored, tmp_path):
    history.first_version(ops.summary(stored)).write.parquet(str(tmp_path / "h"))
    ops.summary(stored).write.parquet(str(tmp_path / "s"))
    known, current = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "s"))
    found = history.find_changes(known, current)
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan(found))
    assert all("open" not in columns and "ma_7_day" not in columns for columns in reads)
    # one shuffle per input: open versions, current rows, keys of closed versions
    assert count(found, "Exchange") <= 3 + 1


@pytest.mark.parametrize(
    "name",
    [
        "stock_summary",
        "upsert_bars",
        "forecast_trend_users",
        "forecast_drift",
        "forecast_business_days",
        "forecast_replace",
        "forecast_outcomes",
        "final_union",
        "check_summary",
        "check_unique_key",
        "snapshot_second_run_check",
        "parse_symbols",
        "outcomes_missing_cols",
    ],
)
def test_no_cross_join_no_python_in_tasks(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "MapInArrow"):
        assert node not in text


def test_partition_counts_follow_the_data():
    small, large = scale_conf(10**9, 16), scale_conf(10**14, 4000)
    assert small["spark.sql.shuffle.partitions"] == "32"
    assert int(large["spark.sql.shuffle.partitions"]) * 192 * 1024**2 >= 10**14
