import zlib
from array import array

import corpus_pipeline
from dailybars.llm.common import documents
from dailybars.llm.pseudonyms import Pseudonyms
from dailybars.llm.rule_ensemble import Ensemble, Rule, accepted, fit, held_out, rule_ensemble, scored, statistics, training_rows
from pyspark.sql import functions as F

from test_decontaminate import brute as brute_hits
from test_near_dedup import brute as brute_groups
from test_tokens import batch

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = documents(spark, SF)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pseudonyms", "pack"]

    good = stage["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _ in rows}
    right = sum((d in kept) == (q == 1) for d, q in labels.items())
    assert right >= 0.95 * len(labels)

    single = stage["near_dedup"](spark, good, SF)
    assert single.columns == docs.columns
    rows = [r for r, g in zip(rows, brute_groups(rows, size=5)) if g[3]]
    assert sorted((r["doc_id"], r["text"]) for r in single.collect()) == sorted(rows)

    clean = stage["decontaminate"](spark, single, SF)
    assert clean.columns == docs.columns
    dirty = {d for d, _ in brute_hits(rows, bench)}
    rows = [r for r in rows if r[0] not in dirty]
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect()) == sorted(rows)

    private = stage["pseudonyms"](spark, clean, SF)
    assert private.columns == docs.columns
    made = Pseudonyms(corpus_pipeline.PSEUDONYM_KEY)
    rows = [(d, made.rewrite(t)[0]) for d, t in rows]
    got = private.collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)

    want = []
    for (d, _), ids in zip(rows, batch("word_bpe_49k.json", [t for _, t in rows])):
        own = array("I", [*ids, 0])
        want += [(d, at // 2048, at, zlib.crc32(own[at : at + 2048].tobytes())) for at in range(0, len(own), 2048)]
    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in packed) == sorted(want)


def test_empty_and_odd_tables(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
        out = stage(spark, odd_docs, SF)
        assert name == "pack" or out.columns == odd_docs.columns
        assert out.count() <= 40
    # Copies, with and without ids: one of each; blank texts all stay.
    left = sorted(str(r["text"])[:9] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, odd_docs, SF).collect())
    assert left.count("same text") == 1 and left.count("None") == 2 and len(left) == 10


def test_held_out_rows_are_not_learned_from(spark, small_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    used = [r["doc_id"] for r in training_rows(small_docs, labels, 1000).collect()]
    assert used and all(zlib.crc32(str(d).encode()) % 4 != 2 for d in used)
    assert len(training_rows(small_docs, labels, 10).collect()) == 10
    marked = small_docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in marked)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = rule_ensemble(documents(spark, sf), labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)


def test_compiled_score_is_the_sum_of_the_rules_that_hold(spark, small_docs):
    import math

    rules = (Rule((("n_words", True, 100.0), ("symbols", False, 0.1)), 1.5), Rule((("upper", True, 0.05),), -2.0))
    model = Ensemble(0.25, rules)
    texts = small_docs.select("doc_id", "text")
    got = {r["doc_id"]: r["score"] for r in scored(texts, model).collect()}
    for r in statistics(texts).collect():
        total = 0.25 + 1.5 * (r["n_words"] > 100 and r["symbols"] <= 0.1) - 2.0 * (r["upper"] > 0.05)
        assert math.isclose(got[r["doc_id"]], 1 / (1 + math.exp(-total)))


def test_classifier_edges(spark, odd_docs, no_docs, small_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 0), (10, None, 0)] * 2, "doc_id long, quality int, toxic int")
    out = rule_ensemble(odd_docs, labels).collect()
    assert len(out) == 11 and all(r["score"] is not None for r in out)
    assert rule_ensemble(no_docs, labels).collect() == []
    assert {r["score"] for r in rule_ensemble(odd_docs, labels.limit(0)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    assert min(r["score"] for r in rule_ensemble(odd_docs, ones).collect()) > 0.99
    assert accepted(odd_docs, Ensemble(5.0, ())).columns == odd_docs.columns
    assert fit(training_rows(small_docs, labels.limit(0), 10)).rules == ()
