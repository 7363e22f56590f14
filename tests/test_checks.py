from datetime import date

import pytest

from dailybars import schemas
from dailybars.operators import checks
from dailybars.operators.bars import summary

DAY, NEXT = date(2024, 1, 5), date(2024, 1, 6)


def results(rows):
    return {(r.check_name, r.column_name): r.failures for r in rows}


def test_clean_summary_passes(make_bars):
    rows = summary(make_bars([("A", DAY, 1.0), ("A", NEXT, 1.0), ("B", DAY, 1.0)]))
    passed = checks.require_passing(checks.check_summary(rows, ["A", "B"]))
    assert len(passed) == 6 and not any(results(passed).values())


def test_each_failure_is_counted(spark):
    rows = spark.createDataFrame(
        [
            ("A", DAY, 1.0, 1.0, 1.0, 1.0, None),
            ("A", DAY, 1.0, 1.0, 1.0, None, None),
            ("X", NEXT, 1.0, 1.0, 1.0, 1.0, 1),
            ("Y", None, 1.0, 1.0, 1.0, 1.0, 1),
            (None, NEXT, 1.0, 1.0, 1.0, 1.0, 1),
        ],
        schemas.RAW_BARS,
    )
    found = results(checks.check_summary(rows, ["A"]).collect())
    assert found == {
        ("not_null", "symbol"): 1,
        ("not_null", "dt"): 1,
        ("not_null", "close"): 1,
        ("not_null", "volume"): 2,
        ("accepted_values", "symbol"): 2,
        ("unique", "symbol, dt"): 1,
    }
    assert results(checks.not_null(rows).collect()) == {k: v for k, v in found.items() if k[0] == "not_null"}
    with pytest.raises(checks.CheckFailed, match="not_null\\(volume\\): 2"):
        checks.require_passing(checks.check_summary(rows, ["A"]))


def test_empty_summary_passes(spark):
    rows = spark.createDataFrame([], schemas.STOCK_SUMMARY)
    assert not any(results(checks.require_passing(checks.check_summary(rows, ["A"]))).values())


def test_unaccepted_values_are_listed(make_bars):
    rows = make_bars([("A", DAY, 1.0), ("X", DAY, 1.0), ("X", NEXT, 1.0)])
    assert [tuple(r) for r in checks.unaccepted_values(rows, "symbol", ["A"]).collect()] == [("X", 2)]


def test_no_accepted_list_no_such_check(make_bars):
    found = results(checks.check_summary(make_bars([("A", DAY, 1.0)]), None).collect())
    assert ("accepted_values", "symbol") not in found
