"""Operator 12: hard negatives by exact integer scores from a residue-number-system matrix product.

An anchor's positives are its best `positives` other rows of the same label; for each positive, the negatives are the
best `negatives` rows of another label whose score lies between two shares of the positive's score. A score is the
inner product of integer vectors; higher comes first, then the smaller id.

* Product. Both matrices are reduced modulo a few primes and multiplied in float32, which is exact while depth times the
  square of half a prime stays below 2^24. Chinese remaindering (mixed radix, balanced digits) puts the residues
  together; the primes' product exceeds twice the largest score that the input's largest component allows, so signed
  scores come out exactly. Vectors deeper than 1,024 are multiplied in slices whose residues are added.
* Blocks. Rows are dealt into blocks of about `row_block`, anchors into blocks of about `anchor_block`, and each pair of
  blocks is a group of one task, which works through it in slices and keeps the best of each anchor only. The first pass
  pairs blocks of one label and selects positives; the second pairs all blocks, under the bounds of each positive.
* A window over (anchor, positive) selects among the blocks' best. Nothing is capped: a row of the result is among the
  best of its block.

Every query meets every row, so the work grows with the product of both numbers; what is shuffled are the rows once for
each block of anchors, the anchors once for each block of rows, and a few rows for each anchor and block.

Nulls: rows with a null label, a null vector, or a null or non-finite component take no part; a row with a null id can be
a positive or negative (after all ids in ties), but is no anchor. An empty vector scores 0; a shorter one counts as
filled up with zeros. Repeated rows are rows of their own: a copy of an anchor can be its positive, and each copy of an
anchor gives its own, equal, results. Vectors whose inner product with themselves reaches 2^61 after scaling, so that
scores could leave 63 bits, take no part either. An empty table gives no rows. Very long vectors count whole; blocks
have the fewer rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailybars.llm.common import on_workers, stored

DEPTH = 1024
#: Components in a block of rows and in one of anchors; 8,192 rows and 1,024 anchors of 64 components.
ROW_BLOCK, ANCHOR_BLOCK = 1 << 19, 1 << 16
ROW_SLICE, ANCHOR_SLICE = 4096, 256
NONE = np.iinfo(np.int64).min
FOUND = "anchor long, w long, id long, row long, score long"


def primes_for(depth: int, largest: int) -> list[int]:
    """Odd primes, largest first: exact in float32 for vectors of this depth, and for scores from -largest to largest."""
    half = int(np.sqrt((2**24 - 1) / max(1, min(depth, DEPTH))))
    found, product, p = [], 1, min(2 * half + 1, 4095)
    while product <= 2 * largest:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found or [3]


def balanced(values: np.ndarray, p: int) -> np.ndarray:
    """Residues from -p/2 to p/2."""
    r = values % p
    return np.where(r > p // 2, r - p, r)


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [balanced(values, p).astype(np.float32) for p in primes]


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The product of two matrices of whole numbers, the second transposed, from their residues."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        r = np.zeros((len(left[k]), len(right[k])), np.int64)
        for at in range(0, left[k].shape[1], DEPTH):
            r += (left[k][:, at : at + DEPTH] @ right[k][:, at : at + DEPTH].T).astype(np.int64)
        # Mixed radix: what the digits so far leave, over the product of their primes.
        for q, digit in zip(primes, digits):
            r = (r - digit) % p * pow(q, -1, p)
        digits.append(balanced(r, p))
    score = digits[-1]
    for p, digit in zip(primes[-2::-1], digits[-2::-1]):
        score = score * p + digit
    return score


def matrix(vectors: pa.ChunkedArray, depth: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    out = np.zeros((len(vectors), depth), np.int64)
    at = 0
    for chunk in vectors.chunks:
        lengths = np.diff(chunk.offsets.to_numpy())
        flat = chunk.flatten().to_numpy(zero_copy_only=False)
        inside = np.arange(depth) < lengths[:, None]
        out[at : at + len(chunk)][inside] = flat
        at += len(chunk)
    return out


def best_of(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the n highest of each row, the leftmost of equal ones first. Overwrites scores."""
    rows, at, value = np.arange(len(scores)), [], []
    for _ in range(min(n, scores.shape[1])):
        column = scores.argmax(axis=1)
        at.append(column)
        value.append(scores[rows, column])
        scores[rows, column] = NONE
    return np.stack(at, axis=1), np.stack(value, axis=1)


def search(left: np.ndarray, right: np.ndarray, primes: list[int], n: int, allowed, windows) -> Iterator[tuple]:
    """(i, w, j, score): for each row i of left and window w, the n best rows j of right that are allowed.

    allowed(rows of left, rows of right) is a mask; windows are (low, high), bounds of the score for each row of left.
    Of equal scores the smaller j is taken.
    """
    right_parts = [
        (at, residues(right[at : at + ROW_SLICE], primes)) for at in range(0, len(right), ROW_SLICE)
    ]
    for top in range(0, len(left), ANCHOR_SLICE):
        rows = slice(top, min(top + ANCHOR_SLICE, len(left)))
        part = residues(left[rows], primes)
        height = rows.stop - top
        best = [(np.zeros((height, 0), np.int64), np.zeros((height, 0), np.int64)) for _ in windows]
        for at, other in right_parts:
            scores = exact_scores(part, other, primes)
            mask = allowed(rows, slice(at, at + scores.shape[1]))
            for w, (low, high) in enumerate(windows):
                inside = mask & (scores >= low[rows, None]) & (scores <= high[rows, None])
                column, value = best_of(np.where(inside, scores, NONE), n)
                column = np.concatenate([best[w][0], column + at], axis=1)
                value = np.concatenate([best[w][1], value], axis=1)
                order = np.argsort(-np.maximum(value, NONE + 1), axis=1, kind="stable")[:, :n]
                best[w] = np.take_along_axis(column, order, 1), np.take_along_axis(value, order, 1)
        for w, (column, value) in enumerate(best):
            i, k = np.nonzero(value != NONE)
            yield i + top, np.full(len(i), w), column[i, k], value[i, k]


def _found(left: pa.Table, right: pa.Table, parts: list[tuple], names: list[str]) -> pa.Table:
    if not parts:
        parts = [(np.zeros(0, np.int64),) * 4]
    i, w, j, score = (np.concatenate(x) for x in zip(*parts))
    columns = [left.column("row").take(pa.array(i)), pa.array(w), right.column("id").take(pa.array(j)),
               right.column("row").take(pa.array(j)), pa.array(score, pa.int64())]
    return pa.table(columns, names)


def _sorted_rows(right: pa.Table) -> pa.Table:
    """By id, nulls last, so that the leftmost of equal scores has the smallest id."""
    return right.sort_by([("id", "ascending"), ("row", "ascending")])


def positives_in(left: pa.Table, right: pa.Table, primes: list[int], depth: int, n: int) -> pa.Table:
    names = ["anchor", "w", "id", "row", "score"]
    if not len(left) or not len(right):
        return _found(left, right, [], names)
    right = _sorted_rows(right)
    own, other = left.column("row").to_numpy(), right.column("row").to_numpy()
    every = np.full(len(left), NONE + 1), np.full(len(left), np.iinfo(np.int64).max)
    found = search(
        matrix(left.column("vec"), depth), matrix(right.column("vec"), depth), primes, n,
        lambda a, b: own[a, None] != other[None, b], [every],
    )
    return _found(left, right, list(found), names)


def shares(score: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """percent * score / 100, rounded up and down, without leaving 63 bits."""
    down = score // 100 * percent + score % 100 * percent // 100
    return down + (score % 100 * percent % 100 != 0), down


def negatives_in(
    left: pa.Table, right: pa.Table, primes: list[int], depth: int, n: int, low: int, high: int
) -> pa.Table:
    names = ["anchor", "w", "id", "row", "score"]
    if not len(left) or not len(right):
        return _found(left, right, [], names)
    right = _sorted_rows(right)
    own, other = left.column("label").to_numpy(), right.column("label").to_numpy()
    lists = left.column("scores").to_pylist()
    windows = []
    for w in range(max(map(len, lists))):
        # Without a positive the window is empty.
        there = np.array([len(x) > w for x in lists])
        score = np.array([x[w] if len(x) > w else 0 for x in lists], np.int64)
        windows.append((np.where(there, shares(score, low)[0], 1), np.where(there, shares(score, high)[1], 0)))
    found = search(
        matrix(left.column("vec"), depth), matrix(right.column("vec"), depth), primes, n,
        lambda a, b: own[a, None] != other[None, b], windows,
    )
    return _found(left, right, list(found), names)


def whole_vectors(table: DataFrame, scale: int) -> DataFrame:
    """row, id, label, vec, norm: the rows that take part; norm is the vector's product with itself."""
    rows = table.select(
        table["vec_id"].cast("long").alias("id"),
        table["label"].cast("long").alias("label"),
        table["embedding"].cast("array<double>").alias("x"),
    )

    def square(x: Column) -> Column:
        whole = F.floor(scale * x).cast("double")
        return F.when(F.isnan(x), F.lit(float("inf"))).otherwise(whole * whole)

    norm = F.aggregate("x", F.lit(0.0), lambda a, x: a + square(x))
    rows = rows.withColumn("norm", norm).where(F.col("label").isNotNull() & (F.col("norm") < float(1 << 61)))
    vec = F.transform("x", lambda x: F.floor(scale * x).try_cast("int"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", vec.alias("vec"), "norm")


def _dealt(rows: DataFrame, own: Column, others: Column, own_name: str, other_name: str) -> DataFrame:
    """Each row with its block by hash, of `own` ones, once for each of the `others` blocks of the other side."""
    block = F.pmod(F.xxhash64("row"), own)
    return rows.withColumn(own_name, block).withColumn(other_name, F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))


def hard_negatives(
    table: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    table: vec_id, embedding, label (a whole number). Anchors are the rows whose vec_id is divisible by `every`.
    Components are multiplied by `scale` and rounded down.
    """
    spark = table.sparkSession
    on_workers(spark)
    rows = stored(whole_vectors(table, scale), "vectors")
    is_anchor = F.col("id") % every == 0
    depth, norm = rows.agg(F.max(F.size("vec")), F.max("norm")).first()
    depth = depth or 0
    primes = primes_for(depth, int(norm or 0))
    row_block = max(64, ROW_BLOCK // max(1, depth))
    anchor_block = max(16, ANCHOR_BLOCK // max(1, depth))

    def blocks(count: str, size: int) -> Column:
        return F.ceil(F.col(count) / size).cast("long")

    # Positives: blocks of one label.
    counts = rows.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("m"))
    counts = counts.where("m > 0").select("label", blocks("n", row_block).alias("r"), blocks("m", anchor_block).alias("a"))
    counts = stored(counts, "label-blocks")
    total = counts.agg(F.sum(F.col("r") * F.col("a"))).first()[0] or 1
    keys, side = ["label", "ab", "rb"], min(4 * total, 20_000)
    anchors = _dealt(rows.where(is_anchor).join(counts, "label"), F.col("a"), F.col("r"), "ab", "rb")
    others = _dealt(rows.join(counts, "label"), F.col("r"), F.col("a"), "rb", "ab")
    columns = ["row", "id", "label", "vec"]
    # New names for the columns of one side: both come from the same table.
    fresh = [F.col(c).alias(c) for c in columns]
    left = anchors.select("ab", "rb", *fresh).repartition(side, *keys).groupBy(*keys)
    right = others.select("ab", "rb", *columns).repartition(side, *keys).groupBy(*keys)
    task = partial(positives_in, primes=primes, depth=depth, n=positives)
    found = left.cogroup(right).applyInArrow(lambda a, b: task(a, b), FOUND)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    best = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives)
    best = stored(best.select("anchor", "k", "id", "score"), "positives")

    # Negatives: all blocks, under the bounds of each positive.
    lists = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("p"))
    asked = rows.join(lists, rows["row"] == lists["anchor"]).select(*columns, F.col("p.score").alias("scores"))
    asked = stored(asked, "asked")
    n, m = rows.count(), asked.count()
    r, a = max(1, -(-n // row_block)), max(1, -(-m // anchor_block))
    keys, side = ["ab", "rb"], min(4 * r * a, 20_000)
    number = lambda x: F.lit(x).cast("long")
    left = _dealt(asked, number(a), number(r), "ab", "rb").repartition(side, *keys).groupBy(*keys)
    right = _dealt(rows.select(*columns), number(r), number(a), "rb", "ab").repartition(side, *keys).groupBy(*keys)
    task2 = partial(negatives_in, primes=primes, depth=depth, n=negatives, low=low, high=high)
    found = left.cogroup(right).applyInArrow(lambda x, y: task2(x, y), FOUND)
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ids = rows.where(is_anchor).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    chosen = best.select("anchor", (F.col("k") - 1).cast("long").alias("w"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return found.join(chosen, ["anchor", "w"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def relabelled(table: DataFrame) -> DataFrame:
    """vec_id, embedding, label, where every seventh row has the next of ten labels."""
    label = table["label"].cast("long")
    label = F.when(table["vec_id"] % 7 == 0, F.try_add(label, F.lit(1)) % 10).otherwise(label)
    return table.select(table["vec_id"].alias("vec_id"), table["embedding"].alias("embedding"), label.alias("label"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND
        len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS arow, a.id AS anchor_id, a.label = b.label AS same, b.row, b.id,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.id % 50 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY arow ORDER BY score DESC, id NULLS LAST, row) AS k
  FROM s WHERE same QUALIFY k <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.arow, p.k ORDER BY s.score DESC, s.id NULLS LAST, s.row) AS rank
  FROM p JOIN s ON s.arow = p.arow AND NOT s.same
  WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  QUALIFY rank <= 3)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
