import itertools
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import as_set
from dailybars.operators.partials import bars_of, merged, partial_bars
from dailybars.sources.ticks import daily_bars
from dailybars.streaming.landing import load_new_ticks, restate_days

TICK = ("symbol", "ts", "price", "seq")
SCHEMA = "symbol string, ts timestamp_ntz, price double, seq long"


@pytest.fixture
def ticks(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice("AAAB"), datetime(2024, 1, 30 + i % 2, i % 24), float(rng.randrange(50)), i) for i in range(120)
    ] + [("C", datetime(2024, 2, 1), 7.0, 500)]
    return spark.createDataFrame(rows, SCHEMA)


def test_parts_in_any_order_make_the_bars_of_one_batch(ticks):
    want = as_set(daily_bars(ticks, *TICK))
    parts = [partial_bars(ticks.where(F.col("seq") % 3 == i), *TICK) for i in range(3)]
    for order in itertools.permutations(parts):
        first = merged(order[0].unionByName(order[1]))
        assert as_set(bars_of(first.unionByName(order[2]))) == want


def test_ticks_that_say_nothing_are_left_out(spark):
    day = datetime(2024, 1, 1, 9)
    rows = [("A", day, 1.0, 1), ("A", day, float("nan"), 0), ("A", day, None, 2), (None, day, 1.0, 3), ("A", None, 1.0, 4), ("A", day, 1.0, None)]
    assert [tuple(r) for r in bars_of(partial_bars(spark.createDataFrame(rows, SCHEMA), *TICK)).collect()] == [
        ("A", date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1)
    ]


def test_late_ticks_restate_a_day_without_its_other_ticks(store, ticks):
    first, late = ticks.where("seq % 4 <> 1"), ticks.where("seq % 4 = 1")
    restate_days(store, late, "late", *TICK)
    restate_days(store, first, "first", *TICK)
    assert as_set(store.read("raw_bars")) == as_set(daily_bars(ticks, *TICK))
    touched = restate_days(store, first, "first", *TICK)  # delivered again
    assert touched == first.selectExpr("symbol", "to_date(ts) AS dt").distinct().count()
    assert as_set(store.read("raw_bars")) == as_set(daily_bars(ticks, *TICK))
    assert restate_days(store, ticks.where("false"), "empty", *TICK) == 0


def test_streamed_ticks(spark, store, ticks, tmp_path):
    for part in (1, 0):
        ticks.where(F.col("seq") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "ticks"))
        stream = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "ticks"))
        load_new_ticks(store, stream, str(tmp_path / "checkpoint"), "ticks", *TICK).awaitTermination()
    assert as_set(store.read("raw_bars")) == as_set(daily_bars(ticks, *TICK))
    assert {r.delivery for r in store.read("partial_bars").collect()} == {"ticks-0", "ticks-1"}
