import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dailybars.llm.mixing import drawn, hypergeometric, mix_report, mixed, source_targets, splitting_tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"


def poured(sizes, percent=150, most=2, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again. sizes: {source: words}; sources sorted, None last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {s: 0.0 for s in names}, set(names)
    left = sum(sizes.values()) * percent / 100
    while left > 1e-6 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def checked(docs, block_words=32_768, shard_blocks=256):
    """The report, after checks that hold for any input."""
    rows = [(r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in docs.select("doc_id", "text", "source").collect()]
    draws = drawn(docs, block_words=block_words, shard_blocks=shard_blocks)
    mix = mixed(draws).collect()
    report = mix_report(draws, mixed(draws)).collect()
    assert Counter((r.doc_id, r.size) for r in report) == Counter((i, n) for i, n, _ in rows)
    sizes = defaultdict(int)
    for _, n, source in rows:
        sizes[source] += n
    want = poured(sizes)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in draws.collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-3)
        assert len({c.copy for c in r.copies}) == len(r.copies) <= 2
        taken[r.source] += r.size * len(r.copies)
        longest[r.source] = max(longest[r.source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= longest[source] / 2 + 1e-6
    assert sum(r.taken for r in report) == sum(r.size for r in mix) == sum(taken.values())
    assert all(r.taken in (0, r.size, 2 * r.size) for r in report)
    places = defaultdict(list)
    for r in mix:
        places[r.shard].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    return report, mix, draws


def made(spark, n, sources, words=lambda i: 1 + i * 7 % 50):
    return spark.createDataFrame([(i, "w " * words(i), sources(i)) for i in range(n)], DOCS)


def test_hot_source_many_blocks_and_shards(spark):
    docs = made(spark, 1500, lambda i: "hot" if i % 3 else f"s{i % 11}")
    report, mix, draws = checked(docs, block_words=300, shard_blocks=16)
    words = Counter()
    for r in mix:
        words[r.shard] += r.size
    assert len(words) > 10 and max(words.values()) < 3 * min(words.values())
    # Shards hold the sources in about their proportions, and copies of a document in an order of their own.
    hot = [sum(r.size for r in mix if r.shard == s and r.source == "hot") / words[s] for s in words]
    assert max(hot) - min(hot) < 0.6
    assert sorted(map(tuple, report)) == sorted(map(tuple, checked(docs.repartition(7), 300, 16)[0]))


def test_targets_stop_at_twice_a_source(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, "d": 5, None: 40}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows, 150, 2, 100).collect()}
    assert got == pytest.approx(poured(sizes)) and got["a"] == 20 and sum(got.values()) == pytest.approx(1732.5)


def test_one_source_takes_what_there_is(spark):
    checked(made(spark, 40, lambda i: "only"), block_words=100)
    checked(made(spark, 3, lambda i: None, lambda i: 1000), block_words=100)


@pytest.mark.parametrize("good, bad, n", [(20, 30, 15), (3, 400, 200), (500, 2, 251), (5, 0, 3), (0, 7, 4), (9, 9, 0)])
def test_hypergeometric_distribution(spark, good, bad, n):
    many = 20_000
    args = [F.lit(x).cast("long") for x in (good, bad, n)]
    counts = dict(
        spark.range(many).select(hypergeometric(*args, (F.col("id") + 0.5) / many).alias("k")).groupBy("k").count().collect()
    )
    below = exact = 0.0
    for k in range(0, n + 1):
        exact += math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
        below += counts.get(k, 0) / many
        assert abs(exact - below) < 2 / many


def test_large_hypergeometric_draws(spark):
    args = [F.lit(x).cast("long") for x in (300_000_000, 500_000_000, 400_000_000)]
    rows = spark.range(9).select(hypergeometric(*args, (F.col("id") + 1) / 10.0).alias("k")).collect()
    values = [r.k for r in rows]
    deviation = math.sqrt(4e8 * 3 / 8 * 5 / 8 * 4 / 8)
    assert values == sorted(values) and values[4] == pytest.approx(150_000_000, abs=2)
    assert values[7] - 150_000_000 == pytest.approx(0.8416 * deviation, rel=0.01)


def test_tree_meets_quotas_and_shard_sizes(spark):
    quotas = {0: 70, 1: 1, 3: 33, 4: 0}
    tree = splitting_tree(spark.createDataFrame(list(quotas.items()), "number int, quota long"), 10, "x").collect()
    assert Counter(r.number for r in tree) == Counter({k: v for k, v in quotas.items() if v})
    for number, quota in quotas.items():
        assert sorted(r["at"] for r in tree if r.number == number) == list(range(quota))
    per_shard = Counter(r.shard for r in tree)
    assert set(per_shard) == set(range(11)) and set(per_shard.values()) <= {9, 10}


def test_draws_follow_the_distribution(spark):
    """Over many seeds, the blocks of a source in the left half have the mean and variance of the distribution."""
    quotas = spark.createDataFrame([(0, 12), (1, 20)], "number int, quota long").cache()
    got = [splitting_tree(quotas, 16, f"seed{i}").where("shard = 0 AND number = 0").count() for i in range(60)]
    mean, variance = 6, 16 * 12 / 32 * 20 / 32 * 16 / 31
    assert sum(got) / 60 == pytest.approx(mean, abs=4 * math.sqrt(variance / 60))
    assert 0.4 * variance < sum((x - mean) ** 2 for x in got) / 60 < 2 * variance


def test_odd_input(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("source", F.when(F.col("doc_id") > 5, "b")).withColumn("number", F.lit("clash"))
    checked(docs.withColumn("size", F.lit(None)).withColumn("copies", F.lit(1)))
    empty = made(spark, 500, lambda i: "a", lambda i: 0)
    assert all(r.taken == r.target == 0 for r in checked(empty, block_words=64)[0])
    draws = drawn(no_docs)
    assert mix_report(draws, mixed(draws)).collect() == []


def test_no_python_in_the_plan(spark, small_docs):
    draws = drawn(small_docs)
    plan = mix_report(draws, mixed(draws))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
