import hashlib
from collections import Counter
from datetime import date, datetime

import pytest

from dailybars import schemas
from dailybars.operators import history as h
from dailybars.operators.bars import summary
from dailybars.operators.history import month_digests
from dailybars.plans.models import take_snapshot
from dailybars.settings import Settings

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
RUN, LATER = datetime(2024, 1, 10, 6), datetime(2024, 1, 11, 6)


def versions(frame):
    return sorted(
        ((r.symbol, r.dt, r.close, r.valid_from, r.valid_to) for r in frame.collect()),
        key=lambda v: (v[0], v[1], v[3]),
    )


def next_version(history, current, run_ts, strategy="timestamp"):
    found = h.find_changes(history, current, strategy)
    after = h.next_version(history, current, found, run_ts, strategy)
    return after.sparkSession.createDataFrame(after.collect(), schemas.SNAPSHOT)


def midnight(day):
    return datetime.combine(day, datetime.min.time())


def open_per_key(frame):
    return Counter((r.symbol, r.dt) for r in frame.collect() if r.valid_to is None)


def test_first_run(make_bars):
    first = h.first_version(summary(make_bars([("A", D1, 1.0)])))
    assert first.schema.simpleString() == schemas.SNAPSHOT.simpleString()
    row = first.first()
    assert row.scd_id == hashlib.md5(b"A2024-01-01|2024-01-01").hexdigest()
    assert (row.updated_at, row.valid_from, row.valid_to) == (D1, midnight(D1), None)


def test_first_run_equals_a_run_over_empty_history(spark, make_bars):
    current = summary(make_bars([("A", D1, 1.0), ("B", D1, 2.0)]))
    empty = spark.createDataFrame([], schemas.SNAPSHOT)
    assert versions(next_version(empty, current, RUN)) == versions(h.first_version(current))


@pytest.mark.parametrize("strategy", h.STRATEGIES)
def test_new_day_and_vanished_symbol(make_bars, strategy):
    old = h.first_version(summary(make_bars([("A", D1, 1.0), ("B", D1, 2.0)])))
    current = summary(make_bars([("A", D1, 1.0), ("A", D2, 3.0)]))
    after = next_version(old, current, RUN, strategy)
    assert versions(after) == [
        ("A", D1, 1.0, midnight(D1), None),
        ("A", D2, 3.0, midnight(D2), None),
        ("B", D1, 2.0, midnight(D1), RUN),
    ]


def test_restated_price_is_a_new_version_only_with_check(make_bars):
    old = h.first_version(summary(make_bars([("A", D1, 1.0), ("A", D2, 2.0)])))
    current = summary(make_bars([("A", D1, 1.5), ("A", D2, 2.0)]))
    assert versions(next_version(old, current, RUN)) == versions(old)
    checked = next_version(old, current, RUN, "check")
    assert versions(checked) == [
        ("A", D1, 1.0, midnight(D1), RUN),
        ("A", D1, 1.5, RUN, None),
        ("A", D2, 2.0, midnight(D2), None),
    ]
    assert len({r.scd_id for r in checked.collect()}) == 3
    assert max(open_per_key(checked).values()) == 1


@pytest.mark.parametrize("strategy", h.STRATEGIES)
def test_key_that_comes_back_is_opened_at_the_run(make_bars, strategy):
    both = summary(make_bars([("A", D1, 1.0), ("B", D1, 2.0)]))
    only_a = summary(make_bars([("A", D1, 1.0)]))
    gone = next_version(h.first_version(both), only_a, RUN, strategy)
    back = next_version(gone, both, LATER, strategy)
    assert versions(back) == [
        ("A", D1, 1.0, midnight(D1), None),
        ("B", D1, 2.0, midnight(D1), RUN),
        ("B", D1, 2.0, LATER, None),
    ]
    assert len({r.scd_id for r in back.collect()}) == 3
    again = next_version(back, both, datetime(2024, 1, 12), strategy)
    assert versions(again) == versions(back)


def test_nulls_compare_as_equal(make_bars):
    rows = [("A", D1, None, None, None, 1.0, None)]
    old = h.first_version(summary(make_bars(rows)))
    assert h.find_changes(old, summary(make_bars(rows)), "check").count() == 0
    filled = summary(make_bars([("A", D1, None, None, None, 1.0, 7)]))
    assert [r.verdict for r in h.find_changes(old, filled, "check").collect()] == ["changed"]


def test_reading_a_moment(make_bars):
    old = h.first_version(summary(make_bars([("A", D1, 1.0), ("B", D1, 2.0)])))
    after = next_version(old, summary(make_bars([("A", D1, 5.0), ("A", D3, 3.0)])), RUN, "check")
    assert versions(h.valid_at(after, datetime(2024, 1, 2))) == [
        ("A", D1, 1.0, midnight(D1), RUN),
        ("B", D1, 2.0, midnight(D1), RUN),
    ]
    assert {(s, d, c) for s, d, c, _, _ in versions(h.valid_at(after, RUN))} == {("A", D1, 5.0), ("A", D3, 3.0)}
    assert h.valid_at(after, datetime(2023, 1, 1)).count() == 0


def test_unknown_strategy(make_bars):
    rows = summary(make_bars([("A", D1, 1.0)]))
    with pytest.raises(ValueError):
        h.find_changes(h.first_version(rows), rows, "guess")


def test_second_correction_at_one_run_time_takes_the_first_ones_place(spark, store, make_bars):

    settings = Settings(date(2024, 1, 31), symbols=None, snapshot_strategy="check")
    for close in (1.0, 2.0, 3.0, None, 4.0):
        rows = [] if close is None else [("A", date(2024, 1, 5), close)]
        store.overwrite("stock_summary", summary(make_bars(rows)))
        take_snapshot(store, settings)
    rows = store.read("snapshot").collect()
    assert len({r.scd_id for r in rows}) == len(rows) == 2
    assert [r.close for r in rows if r.valid_to is None] == [4.0]


def test_only_months_with_another_digest_are_read(store, make_bars, daily, monkeypatch):
    settings = Settings(date(2024, 4, 1), symbols=None, snapshot_strategy="check", run_ts=datetime(2024, 4, 1))
    rows = daily("A", "2024-01-01", range(1, 90))
    store.overwrite("stock_summary", summary(make_bars(rows)))
    assert take_snapshot(store, settings) == 89
    opened = []
    read = store.read_months

    def watched(name, months):
        opened.append((name, frozenset(months)))
        return read(name, months)

    monkeypatch.setattr(store, "read_months", watched)
    assert take_snapshot(store, settings) == 0 and not opened
    rows[40] = ("A", rows[40][1], 999.0)
    store.overwrite("stock_summary", summary(make_bars(rows)))
    assert take_snapshot(store, settings) == 2
    assert set(opened) == {("snapshot", frozenset({"2024-02"})), ("stock_summary", frozenset({"2024-02"}))}
    del rows[40]
    store.overwrite("stock_summary", summary(make_bars(rows)))
    assert take_snapshot(store, settings) == 1
    assert store.read("snapshot").where("valid_to IS NULL").count() == 88


def test_digests_tell_values_apart(make_bars, daily):
    def digest(rows, strategy="check"):
        return [tuple(r) for r in month_digests(summary(make_bars(rows)), strategy).orderBy("month_dt").collect()]

    rows = daily("A", "2024-01-01", [1, 2, 3]) + daily("B", "2024-01-30", [4, 5, 6])
    assert digest(rows) == digest(rows[::-1])
    changed = digest([("A", rows[0][1], 9.0), *rows[1:]])
    assert changed[0] != digest(rows)[0] and changed[1:] == digest(rows)[1:]
    # By days alone a restated close is no difference.
    assert digest(rows, "timestamp") == digest([("A", rows[0][1], 9.0), *rows[1:]], "timestamp")
