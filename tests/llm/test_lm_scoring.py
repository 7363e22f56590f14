import math
from collections import Counter

import numpy as np
import pytest

from dailybars.llm.lm_scoring import SMOOTHING, VOCABULARY, WEIGHT, cross_entropy_difference, squeezed, tokens, unsqueezed


def brute(rows, good, size):
    """rows: (doc_id, text). Exact bigram counts with Python dictionaries."""
    all_words, counts = Counter(), [Counter(), Counter()]
    for _, text in rows:
        all_words.update(tokens(text or ""))
    kept = {w for w, _ in sorted(all_words.items(), key=lambda x: (-x[1], x[0]))[:size]}
    docs = [(d, [w if w in kept else None for w in tokens(t or "")]) for d, t in rows]
    pairs = [Counter(), Counter()]
    for d, words in docs:
        for model in (0, 1) if d in good else (1,):
            counts[model].update(words)
            pairs[model].update(zip(words, words[1:]))
    out = []
    for d, words in docs:
        losses = [0.0, 0.0]
        for model in (0, 1):
            n, v = sum(counts[model].values()), len(kept) + 1
            before = None
            for i, w in enumerate(words):
                p = (counts[model][w] + SMOOTHING) / (n + SMOOTHING * v)
                if i and counts[model][before]:
                    p = WEIGHT * pairs[model][before, w] / counts[model][before] + (1 - WEIGHT) * p
                losses[model] -= math.log(p)
                before = w
        k = max(1, len(words))
        out.append((d, len(words), losses[0] / k, losses[1] / k, (losses[0] - losses[1]) / k))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def compare(got, want):
    got, want = in_order(got), in_order(want)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want], atol=1e-6)


def good_ids(labels):
    return {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}


@pytest.mark.parametrize("size", [VOCABULARY, 200])
def test_against_dictionaries(spark, make_docs, size):
    texts = [f"the {w} of a {w} is the {w}{i % 7} and more." for i, w in enumerate("sun moon star sea sand".split() * 8)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(30)], "doc_id long, quality int, toxic int")
    docs = make_docs(texts)
    compare(cross_entropy_difference(docs, labels, size).collect(), brute(list(enumerate(texts)), good_ids(labels), size))


def test_table(spark, small_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [tuple(r) for r in small_docs.select("doc_id", "text").collect()]
    compare(cross_entropy_difference(small_docs, labels).collect(), brute(rows, good_ids(labels), VOCABULARY))


def test_squeezed_numbers():
    rng = np.random.default_rng(1)
    for values in ([], [0], [2**64 - 1, 0, 255, 256], rng.integers(0, 2**63, 1000).tolist(), [1] * 5000):
        assert unsqueezed(squeezed(np.array(values, dtype=np.uint64))).tolist() == values


def test_target_text_scores_lower(spark, make_docs):
    good = ["clear water runs over smooth stones today"] * 20
    bad = ["buy cheap pills now click here fast"] * 20
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    score = {r["doc_id"]: r["score"] for r in cross_entropy_difference(make_docs(good + bad), labels).collect()}
    assert max(score[i] for i in range(20)) < min(score[i] for i in range(20, 40))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1, None), (None, 1, 0), (9, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    compare(cross_entropy_difference(odd_docs, labels).collect(), brute(rows, {7}, VOCABULARY))
    assert cross_entropy_difference(no_docs, labels).collect() == []
    assert cross_entropy_difference(odd_docs, labels.limit(0)).count() == len(rows)


def test_models_grow_with_the_corpus(spark, make_docs):
    """More words than 65,535, each of which counts as itself."""
    texts = [" ".join(f"w{i * 1000 + j}" for j in range(1000)) for i in range(70)] + ["w69999 w3 w3 w69999"]
    labels = spark.createDataFrame([(i, 1, 0) for i in (5, 69, 70)], "doc_id long, quality int, toxic int")
    got = cross_entropy_difference(make_docs(texts), labels).collect()
    compare(got, brute(list(enumerate(texts)), {5, 69, 70}, None))


@pytest.mark.parametrize("vocabulary, cell, bucket", [(None, 1, 1), (None, 3, 40), (None, 40, 7), (None, 10**6, 3), (9, 5, 5), (9, 10**6, 10**6)])
def test_any_cells_and_buckets(spark, make_docs, vocabulary, cell, bucket):
    """Documents that go on over cells, and one word or many in a bucket, give the same losses."""
    texts = [f"the {w} of a {w} is the {w}{i % 7} and more." for i, w in enumerate("sun moon star sea sand".split() * 8)]
    texts += ["", "sun", "sun sun sun sun sun sun sun", "a b c d e f g h i j k " * 9]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 44, 3)], "doc_id long, quality int, toxic int")
    got = cross_entropy_difference(make_docs(texts), labels, vocabulary, cell, bucket).collect()
    compare(got, brute(list(enumerate(texts)), set(range(0, 44, 3)), vocabulary))
