import random

import numpy as np
import pytest

from dailybars.llm.decontaminate import (
    Index,
    Item,
    contamination,
    index_blocks,
    question_and_answer,
    shingles,
    without_contaminated,
    words_of,
)


def brute(docs, items):
    """(doc_id, item_id) where at least 0.8 of an item's shingles stand in some stretch of the text."""
    out = set()
    for doc_id, text in docs:
        words = words_of(text or "")
        for item_id, item_text in items:
            whole = shingles(words_of(item_text or ""))
            if whole and len(whole & shingles(words)) >= 0.8 * len(whole):
                out.add((doc_id, item_id))
    return out


def exhaustive(index, terms, threshold):
    scores = {}
    for t in terms:
        for i in range(index.posting_start[t], index.posting_start[t + 1]):
            item = int(index.posting_item[i])
            scores[item] = scores.get(item, 0.0) + float(index.posting_weight[i])
    return scores


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6])
def test_search_returns_what_exhaustive_scoring_returns(threshold):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    items = [Item(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(5, 90)))) for i in range(700)]
    index = Index(items)
    for _ in range(60):
        words = rng.choices(vocabulary, weights, k=40) + (items[rng.randrange(700)].words if rng.random() < 0.5 else [])
        terms = np.array(sorted({index.terms[w] for w in words if w in index.terms}))
        got, want = dict(index.search(terms, threshold)), exhaustive(index, terms, threshold)
        assert {d for d in want if want[d] >= threshold + 1e-9} <= set(got) <= {d for d in want if want[d] >= threshold - 1e-9}
        assert all(abs(want[d] - s) < 1e-9 for d, s in got.items())


def test_items_longer_than_a_passage(make_docs, spark):
    rng = random.Random(8)
    item = " ".join(f"v{rng.randrange(9000)}" for _ in range(600))
    noise = [" ".join(f"n{rng.randrange(9000)}" for _ in range(300)) for _ in range(3)]
    bench = spark.createDataFrame([(1, item), (2, noise[2])], "item_id long, text string")
    docs = make_docs([noise[0] + " " + item + " " + noise[1], noise[1], item[: len(item) // 2]])
    assert [(r[0], r[1]) for r in contamination(docs, bench).collect()] == [(0, 1)]


def test_question_and_answer():
    assert question_and_answer("Who? What.\nThat one.") == ("Who? What.", "That one.")
    assert question_and_answer("A b. C d? E f.") == ("A b. C d?", "E f.")
    assert question_and_answer("no end") == ("no end", "")


def test_finds_items_as_a_full_search_does(spark, small_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r[0], r[1]) for r in contamination(small_docs, items).collect()}
    assert got == brute([tuple(r) for r in small_docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert got
    kept = {r[0] for r in without_contaminated(small_docs, items).collect()}
    assert kept == {r[0] for r in small_docs.select("doc_id").collect()} - {d for d, _ in got}


def test_long_texts_edits_and_other_order(spark, make_docs):
    rng = random.Random(4)

    def words(n, kind):
        return [f"{kind}{rng.randrange(5000)}" for _ in range(n)]

    items = [(i, " ".join(words(rng.randint(12, 60), "q")) + ".\n" + " ".join(words(7, "a")) + ".") for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts, want = [], set()
    for i, (_, text) in enumerate(items):
        before, after = words(rng.randint(0, 700), "n"), words(rng.randint(0, 700), "n")
        own = text.split()
        if i % 3 == 1:
            own[len(own) // 2] = "changed"
        if i % 3 == 2:
            rng.shuffle(own)
        texts.append(" ".join([*before, *own, *after]))
        if i % 3 == 0:
            want.add((i, i))
    got = {(r[0], r[1]) for r in contamination(make_docs(texts), bench).collect()}
    assert want <= got <= brute(list(enumerate(texts)), items)
    assert not {d for d, _ in got} & set(range(2, 60, 3))


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(None, "same text twice"), (1, None), (2, ""), (3, "w1 w2 w3 w4 w5 w6")] * 2, "item_id long, text string")
    got = sorted((r[0], r[1] or 0) for r in contamination(odd_docs, bench).collect())
    assert got == [(7, 0), (7, 0), (10, 3)]
    assert contamination(no_docs, bench).collect() == []
    assert contamination(odd_docs, bench.limit(0)).collect() == []
    assert without_contaminated(odd_docs, bench).count() == odd_docs.count() - 3
    assert without_contaminated(odd_docs, bench).columns == odd_docs.columns


def test_items_in_blocks(spark):
    bench = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(50)], "item_id long, text string")
    blocks = list(index_blocks(bench, block_bytes=1000))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(50))


def test_an_item_without_its_short_answer(spark, make_docs):
    words = [f"q{i}" for i in range(60)]
    item = " ".join(words) + "?\nThat one."
    assert question_and_answer(item)[1] == "That one."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs(["Before. " + " ".join(words) + " after it", " ".join(words[:30]) + " That one.", item])
    got = {r["doc_id"]: (r["question_overlap"], r["answer_overlap"]) for r in contamination(docs, bench).collect()}
    assert got == {0: (1.0, 0.0), 2: (1.0, 1.0)}
    assert [r["doc_id"] for r in without_contaminated(docs, bench).collect()] == [1]


def test_question_and_answer_apart(spark, make_docs):
    item = "a1 a2 a3 a4 a5 a6 a7 a8?\nb1 b2 b3."
    bench = spark.createDataFrame([(1, item), (2, "Who?\nMe.")], "item_id long, text string")
    docs = make_docs(["a1 a2 a3 a4 a5 a6 a7 a8? The answer: b1 b2 b3.", "me and who else", "a1 a2 a3 a4 a5 a6 a7 a8?"])
    assert [(r["doc_id"], r["item_id"]) for r in contamination(docs, bench).collect()] == [(0, 1)]
