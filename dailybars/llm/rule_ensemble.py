"""Operator 9: quality classifier as a sparse ensemble of rules.

Statistics of a text are native columns. Small trees are fitted on a bounded sample of labelled documents; every
path from a root is one conjunctive rule. A lasso logistic regression over the rules keeps few of them, and these
are compiled into one Spark column expression, so scoring is a projection: no shuffle, no Python.

Labels are learned only from documents whose crc32(doc_id as text) mod 4 is not 2; the others are held out. The
sample is a documented bound: at most `sample` labelled documents, those with the smallest hash of their id.
Labels, lang, source and doc_id never enter a score.

Nulls: a null text has zero statistics and is scored as such; a null doc_id is scored and not held out; null labels
are not learned from. Repeated rows are scored each. With no labels of both kinds there is nothing to learn: the
score is the share of label 1, or 0.5 without any. An empty table gives no rows. Very long texts are measured whole; a score
of exactly `accept` is accepted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars.llm import text_stats
from dailybars.llm.common import stored, texts_of

HELD_OUT_REMAINDER = 2
SAMPLE = 20_000
STATS = (
    "n_words", "word_length", "symbols", "upper", "digits", "marks", "bangs", "distinct_words", "duplicate_lines",
    "words_in_line", "short_words",
)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it above, threshold), and its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        held = F.lit(True)
        for name, above, threshold in self.terms:
            held = held & ((F.col(name) > threshold) if above else (F.col(name) <= threshold))
        return held


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of label 1, over the columns of `statistics`."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns named in `keep`, and the statistics of each whole text."""
    text = F.col("text")
    counted = docs.select(
        "doc_id",
        *keep,
        F.length("text").alias("n_chars_"),
        text_stats.words_of(text).alias("words_"),
        text_stats.worded_lines(text).alias("lines_"),
        text_stats.occurrences(text, text_stats.SYMBOLS).alias("symbols_"),
        text_stats.occurrences(text, r"\p{Lu}").alias("upper_"),
        text_stats.occurrences(text, r"\p{Nd}").alias("digits_"),
        text_stats.occurrences(text, r"[.,;:]").alias("marks_"),
        text_stats.occurrences(text, r"[!?]").alias("bangs_"),
        text_stats.occurrences(text, r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,3}(?![^\x20\x09-\x0D])").alias("short_"),
    )
    words, lines = F.size("words_"), F.size("lines_")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")

    return counted.select(
        "doc_id",
        *keep,
        words.cast("double").alias("n_words"),
        share(F.col("n_chars_"), words).alias("word_length"),
        share(F.col("symbols_"), words).alias("symbols"),
        share(F.col("upper_"), F.col("n_chars_")).alias("upper"),
        share(F.col("digits_"), F.col("n_chars_")).alias("digits"),
        share(F.col("marks_"), words).alias("marks"),
        share(F.col("bangs_"), words).alias("bangs"),
        share(F.size(F.array_distinct("words_")), words).alias("distinct_words"),
        share(lines - F.size(F.array_distinct("lines_")), lines).alias("duplicate_lines"),
        share(words, lines).alias("words_in_line"),
        share(F.col("short_"), words).alias("short_words"),
    )


def _paths(node, terms: tuple) -> Iterator[tuple]:
    """Every path from the root of a fitted tree to a node below it."""
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    name, threshold = STATS[split.featureIndex()], float(split.threshold())
    for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
        path = (*terms, (name, above, threshold))
        yield path
        yield from _paths(child, path)


def _simple(path: tuple) -> tuple:
    """The same conjunction with one bound for each statistic and direction, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, above, threshold in path:
        old = bounds.get((name, above))
        bounds[name, above] = threshold if old is None else (max if above else min)(old, threshold)
    return tuple((name, above, bounds[name, above]) for name, above in sorted(bounds))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label and statistics of at most `sample` labelled documents that are not held out."""
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("label")
    ).where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    # At most `sample` ids, 16 bytes each: the bound of the broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = texts_of(docs).join(F.broadcast(chosen), "doc_id")
    rows = stored(statistics(texts, "label"), "labelled")
    # One partition in a fixed order, so that the fit does not depend on the cluster; bounded by the sample.
    return rows.repartition(1).sortWithinPartitions("doc_id", *STATS)


def fit(rows: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.0005, seed: int = 7) -> Ensemble:
    shares = rows.agg(F.avg("label"), F.count("*")).first()
    if not shares[1]:
        return Ensemble(0.0, ())
    if shares[0] in (0.0, 1.0):
        return Ensemble(40.0 if shares[0] else -40.0, ())
    vectors = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(rows).select("features", "label", *STATS)
    vectors = vectors.cache()
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="sqrt", subsamplingRate=0.8, seed=seed
    ).fit(vectors)
    paths = sorted({_simple(p) for tree in forest.trees for p in _paths(tree._call_java("rootNode"), ())})
    rules = [Rule(path) for path in paths]
    if not rules:
        vectors.unpersist()
        return Ensemble(0.0, ())
    held = F.array(*[rule.column().cast("double") for rule in rules])
    design = vectors.select(array_to_vector(held).alias("features"), "label")
    model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False).fit(design)
    vectors.unpersist()
    weights = model.coefficients.toArray()
    chosen = [Rule(rule.terms, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6]
    return Ensemble(float(model.intercept), tuple(chosen))


def scored(docs: DataFrame, model: Ensemble, *keep: str, accept: float = 0.7) -> DataFrame:
    """doc_id, the columns in `keep`, held_out, score, predicted."""
    score = model.score()
    rows = statistics(docs, *keep).select("doc_id", *keep, score.alias("score"))
    return rows.select(
        "doc_id",
        *keep,
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= accept).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Ensemble, accept: float = 0.7) -> DataFrame:
    """The documents that score `accept` or more, with all their columns."""
    own = docs.schema
    # Statistics are named by the model; columns of the table are kept apart in a struct.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row_"))
    texts = whole.select(
        F.col("row_.doc_id").alias("doc_id"), F.coalesce("row_.text", F.lit("")).alias("text"), "row_"
    )
    # A filter on the score would be pushed below it, and every statistic written out again in every rule. Spark pushes
    # nothing through a projection with a running number, as long as the number is used.
    marked = statistics(texts, "row_").select(
        "row_", model.score().alias("score_"), F.monotonically_increasing_id().alias("mark_")
    )
    kept = marked.where((F.col("score_") >= accept) & (F.col("mark_") >= 0))
    return kept.select(*[F.col("row_")[field.name].alias(field.name) for field in own])


def rule_ensemble(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    model = fit(training_rows(docs, labels, sample))
    return scored(texts_of(docs), model)
