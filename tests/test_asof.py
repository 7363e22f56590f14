import random

import pytest

from helpers import as_set
from dailybars.operators.asof import asof_join

LEFT, RIGHT = "k string, t int, x int", "k string, s int, v int"


def brute(left, right, strict):
    out = set()
    for k, t, x in left:
        seen = [(s, v) for q, s, v in right if q == k and None not in (k, t, s) and (s < t or (s == t and not strict))]
        best = max(seen, key=lambda r: (r[0], r[1] is not None, r[1] or 0)) if seen else (None, None)
        out.add((k, t, x, *best))
    return out


@pytest.mark.parametrize("strict", [True, False])
def test_newest_earlier_row(spark, strict):
    rng = random.Random(1)
    left = [(rng.choice("ab"), rng.choice([None, *range(12)]), i) for i in range(60)] + [(None, 3, 100), ("none", 3, 101)]
    right = [(rng.choice("abc"), rng.choice([None, *range(12)]), rng.choice([None, *range(5)])) for _ in range(40)] + [(None, 1, 1)]
    joined = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "s", strict)
    assert joined.columns == ["k", "t", "x", "s", "v"]
    assert as_set(joined) == brute(left, right, strict) and joined.count() == len(left)


def test_empty_sides(spark):
    left, none = spark.createDataFrame([("a", 1, 2)], LEFT), spark.createDataFrame([], RIGHT)
    assert as_set(asof_join(left, none, ["k"], "t", "s")) == {("a", 1, 2, None, None)}
    assert asof_join(left.where("false"), none, ["k"], "t", "s").count() == 0


def test_one_shuffle_of_each_side_and_no_join(spark):
    left = spark.range(9).selectExpr("CAST(id AS STRING) AS k", "1 AS t")
    right = spark.range(9).selectExpr("CAST(id AS STRING) AS k", "1 AS s")
    text = asof_join(left, right, ["k"], "t", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text


def test_columns_of_one_name_are_refused(spark):
    left = spark.createDataFrame([("a", 1, 2)], LEFT)
    with pytest.raises(ValueError, match="x"):
        asof_join(left, left, ["k"], "t", "t")
