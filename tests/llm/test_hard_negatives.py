import math
import random

import numpy as np
import pytest

from dailybars.llm import hard_negatives as hn
from dailybars.llm.hard_negatives import exact_scores, hard_negatives, primes_for, relabelled, residues, shares

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3, scale=256, relabel=True):
    """rows: (vec_id, embedding, label). Python's whole numbers, every anchor with every row."""
    table = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        whole = [math.floor(scale * float(np.float32(c))) for c in x]
        if sum(c * c for c in whole) >= 1 << 61:
            continue
        if relabel and vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        table.append((vec_id, label, whole))
    out = []

    def first(a, others):
        scored = [(sum(p * q for p, q in zip(table[a][2], table[b][2])), b) for b in others]
        return sorted(scored, key=lambda s: (-s[0], table[s[1]][0] is None, table[s[1]][0] or 0))

    for a, (vec_id, label, _) in enumerate(table):
        if vec_id is None or vec_id % every:
            continue
        same = first(a, [b for b in range(len(table)) if b != a and table[b][1] == label])[:positives]
        other = first(a, [b for b in range(len(table)) if table[b][1] != label])
        for score, b in same:
            inside = [(s, c) for s, c in other if 50 * score <= 100 * s <= 95 * score][:negatives]
            out += [(vec_id, table[b][0], k, table[c][0], score, s) for k, (s, c) in enumerate(inside, 1)]
    return sorted(out, key=str)


def checked(spark, rows):
    table = spark.createDataFrame(rows, TABLE)
    got = sorted((tuple(r) for r in hard_negatives(relabelled(table)).collect()), key=str)
    assert got == brute(rows)
    return got


def vectors(seed, n, depth, spread=1.0, kinds=10):
    rnd = random.Random(seed)
    base = [rnd.gauss(0, 1) for _ in range(depth)]
    return [(i, [b * 0.7 + rnd.gauss(0, spread) for b in base], rnd.randrange(kinds)) for i in range(n)]


@pytest.mark.parametrize("depth, size", [(1, 10**9), (3, 30_000), (64, 70_000), (64, 10**8), (1500, 255), (2500, 10**7)])
def test_scores_are_exact(depth, size):
    draw = np.random.default_rng(depth)
    left, right = (draw.integers(-size, size, (n, depth), endpoint=True) for n in (5, 7))
    left[0], right[0], right[1] = size, size, -size
    primes = primes_for(depth, depth * size * size)
    assert all(min(depth, hn.DEPTH) * (p // 2) ** 2 < 2**24 for p in primes)
    assert math.prod(primes) > 2 * depth * size * size and len(set(primes)) == len(primes)
    got = exact_scores(residues(left, primes), residues(right, primes), primes)
    assert got.tolist() == [[sum(int(p) * int(q) for p, q in zip(a, b)) for b in right] for a in left]


def test_shares_round_up_and_down():
    scores = np.array([0, 1, 19, 20, 21, 99, 100, -1, -50, -101, 2**60, -(2**60)], np.int64)
    up, down = shares(scores, 95)
    assert [int(x) for x in up] == [-(-95 * int(s) // 100) for s in scores]
    assert [int(x) for x in down] == [95 * int(s) // 100 for s in scores]


def test_against_all_pairs(spark):
    assert len(checked(spark, vectors(1, 400, 16))) > 50


def test_ties_and_copies(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 0.5, 1.0]) for _ in range(4)], rnd.randrange(3)) for i in range(250)]
    rows += rows[:60] + [rows[50]] * 3
    checked(spark, rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(4, 700, 8, kinds=2)
    want = checked(spark, rows)
    monkeypatch.setattr(hn, "ROW_BLOCK", 8)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 8)
    assert checked(spark, rows) == want


def test_slices_in_a_task_keep_the_first_of_equals(monkeypatch):
    monkeypatch.setattr(hn, "ROW_SLICE", 5)
    monkeypatch.setattr(hn, "ANCHOR_SLICE", 2)
    draw = np.random.default_rng(2)
    left, right = draw.integers(-2, 3, (7, 3)), draw.integers(-2, 3, (33, 3))
    every = np.full(7, -100), np.full(7, 100)
    found = hn.search(left, right, primes_for(3, 12), 4, lambda a, b: np.ones((a.stop - a.start, min(b.stop, 33) - b.start), bool), [every])
    i, _, j, score = (np.concatenate(x) for x in zip(*found))
    scores = left @ right.T
    for row in range(7):
        order = sorted(range(33), key=lambda c: (-scores[row, c], c))[:4]
        assert j[i == row].tolist() == order and score[i == row].tolist() == scores[row, order].tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 150, 4) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1), (300, None, 1), (350, [1.0, None, 0.0, 0.0], 1), (400, [1.0, nan, 0.0, 0.0], 2),
        (450, [inf, 0.0, 0.0, 0.0], 2), (500, [1.0, 2.0, 0.0, 0.0], None), (550, [], 3), (600, [1.0, 2.0], 3),
        (650, [1.0, 2.0, 1.0, 1.0, 5.0, 6.0], 3), (700, [3e38, 0.0, 0.0, 0.0], 4), (-50, [1.0, 1.0, 0.5, 0.5], 5),
        (None, [2.0, 1.0, 1.0, 1.0], None), (0, [1.0, 1.0, 1.0, 1.0], -3), (750, [1e6, 1e6, -1e6, 1e6], 6),
    ]
    checked(spark, rows)
    table = spark.createDataFrame(rows, TABLE).selectExpr("*", "1 AS row", "'x' AS id", "2 AS anchor", "3 AS score", "4 AS vec")
    assert sorted((tuple(r) for r in hard_negatives(relabelled(table)).collect()), key=str) == brute(rows)


def test_empty_tables(spark):
    checked(spark, [])
    checked(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    checked(spark, [(50, [1.0], 1), (51, None, 1)])
