"""Operator 13: mix sources to target weights by a multivariate-hypergeometric splitting tree. Native functions only.

* Targets. Sources are numbered by code point (null last) and weigh 5, 2, 1, 5, 2, 1, ... They share `percent` of all
  words by weight; a target stops at `most` times its source's words, and the excess is shared again by weight.
* Blocks. A source's documents are dealt by a hash into blocks of about `block_words` words. A source is a stream of
  its blocks in a permuted order, then of the same blocks in another order, and so on: one copy follows the other. It
  takes blocks from the stream's start until its target is reached, so copies differ by one at most. Of the block that
  holds the target it takes documents in hash order until one does not fit, then of the others the largest that fit,
  and the least that does not if that comes nearer. The number of blocks, the last included, is the source's quota.
* Tree. All quotas go to the root, which stands for all output shards. A node's shards are halved, and how many of each
  source's blocks go left is a draw from the multivariate hypergeometric distribution: source after source, a
  hypergeometric draw among the slots that are left. It is drawn by inversion over the values within nine standard
  deviations of the mean, with weights from Stirling's series. What does not go left goes right, so every quota is met
  exactly and every shard has its number of blocks; a source's blocks of a node are a piece of its stream, so shards
  draw disjoint blocks.
* Within a shard the documents are ordered by a hash. A shard has `shard_blocks` blocks, whatever the input.

Only narrow rows (no texts) are shuffled, by keys of bounded size: (source, block) and shard. Running sums over a hot
source's blocks go by the first byte of their order first. The driver reads the number of blocks. The list of
sources (a row each) is gathered in one task, as is that of their quotas.

Nulls: a null or blank text has size 0; a null source is a source of its own, the last; a null doc_id is carried along.
Documents of size 0 are in their source's blocks and take no words. Rows that repeat id, source and text are taken
or left together in the last block. Ties cannot change a result: orders go by md5 of id and text. Very long texts
count whole; one that is longer than a block is in a larger block. An empty table gives no rows. Reruns give the same
rows, on any number of partitions. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailybars.llm.common import stored

WEIGHTS = (5, 2, 1)
#: A document counts for this many words more when the number of blocks is chosen, so that empty ones spread too.
BESIDES = 16
#: ln(n!) for n below 16, beyond which Stirling's series is exact to twelve digits.
LOG_FACTORIALS = [math.lgamma(n + 1) for n in range(16)]


def _number(digest: Column, digits: int = 12) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the key that all orders go by."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doc_id = docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)).alias("key"),
    )


def source_targets(rows: DataFrame, percent: int, most: int, block_words: int) -> DataFrame:
    """One row for each source: number, source, source_size, target, n_blocks."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    numbered = sums.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("number") % len(WEIGHTS)).cast("long")
    capped = numbered.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    # In this order the sources that stop at their limit come first; the level is what a unit of weight gets.
    before = Window.orderBy(F.col("most") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = F.sum("source_size").over(all_rows) * percent / 100
    left = words - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    capped = capped.withColumn("level", left / weights)
    full = F.col("level") * F.col("weight") >= F.col("most")
    level = F.max(F.when(~full, F.col("level"))).over(all_rows)
    return capped.withColumn("final", level).select(
        "number",
        "source",
        "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(F.col("final") * F.col("weight")).alias("target"),
        F.greatest(F.lit(1), F.ceil((F.col("source_size") + BESIDES * F.col("n_docs")) / block_words)).alias("n_blocks"),
    )


def block_stream(rows: DataFrame, most: int, seed: str) -> DataFrame:
    """The blocks that sources take: number, block, copy, at (place in the stream), rest (null for a whole block).

    rows: number, target, block, size. rest: the words to take from the block that holds the target.
    """
    blocks = rows.groupBy("number", "target", "block").agg(F.sum("size").alias("words"))
    stream = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("copy"))
    order = F.md5(F.concat_ws(":", F.lit(seed), "number", "copy", "block"))
    stream = stream.withColumn("order", order).withColumn("part", F.substring("order", 1, 2))
    parts = stream.groupBy("number", "copy", "part").agg(F.sum("words").alias("w"), F.count("*").alias("c"))
    before = Window.partitionBy("number").orderBy("copy", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "number", "copy", "part",
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
    )
    within = Window.partitionBy("number", "copy", "part").orderBy("order", "block")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = stream.join(parts, ["number", "copy", "part"]).select(
        "number", "block", "copy", "words", "target",
        (F.col("w0") + F.coalesce(F.sum("words").over(within), F.lit(0))).alias("before"),
        (F.col("c0") + F.count("*").over(within)).alias("at"),
    )
    rest = F.col("target") - F.col("before")
    return placed.where(rest > 0).select(
        "number", "block", "copy", "at", F.when(F.col("words") > rest, rest).alias("rest")
    )


def last_picks(rows: DataFrame, stream: DataFrame) -> DataFrame:
    """(number, key) of the documents taken from each source's last block, where that is not taken whole."""
    last = stream.where("rest IS NOT NULL").select("number", "block", "rest")
    keys = rows.join(last, ["number", "block"]).groupBy("number", "rest", "key").agg(F.sum("size").alias("size"))
    lists = keys.groupBy("number", "rest").agg(F.sort_array(F.collect_list(F.struct("key", "size"))).alias("docs"))

    def fitted(docs: Column, rest: Column, greedy: bool) -> Column:
        """Take documents in order while they fit; if greedy, pass over those that do not."""
        start = F.struct(
            rest.alias("rest"), F.lit(False).alias("full"),
            F.array().cast("array<string>").alias("keys"),
            F.array().cast("array<struct<key: string, size: bigint>>").alias("others"),
        )
        return F.aggregate(
            docs,
            start,
            lambda seen, d: F.when(
                (d["size"] <= seen["rest"]) & ~seen["full"],
                F.struct(
                    (seen["rest"] - d["size"]).alias("rest"), seen["full"],
                    F.concat(seen["keys"], F.array(d["key"])).alias("keys"), seen["others"],
                ),
            ).otherwise(
                F.struct(
                    seen["rest"], F.lit(not greedy).alias("full"),
                    seen["keys"], F.concat(seen["others"], F.array(d)).alias("others"),
                )
            ),
        )

    lists = lists.select("number", fitted(F.col("docs"), F.col("rest"), False).alias("first"))
    # The largest of the others that fit, then the next smaller, so that the target is met closely.
    others = F.transform("first.others", lambda d: F.struct((-d["size"]).alias("minus"), d["key"].alias("key")))
    others = F.transform(
        F.sort_array(others), lambda d: F.struct(d["key"].alias("key"), (-d["minus"]).alias("size"))
    )
    lists = lists.select("number", "first", fitted(others, F.col("first.rest"), True).alias("then"))
    least = F.array_min(F.transform("then.others", lambda d: F.struct(d["size"], d["key"])))
    nearer = F.when(least["size"] < 2 * F.col("then.rest"), F.array(least["key"]))
    picked = F.concat("first.keys", "then.keys", F.coalesce(nearer, F.array().cast("array<string>")))
    return lists.select("number", F.explode(picked).alias("key"))


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    table = F.array(*[F.lit(v) for v in LOG_FACTORIALS])
    series = (x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n < len(LOG_FACTORIALS), F.get(table, n.cast("int"))).otherwise(series)


def _bound(value: Column, body) -> Column:
    """body(value), where value is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric(good: Column, bad: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` things, out of good + bad ones, are good: the value at which the distribution passes u."""

    def ranged(s: Column) -> Column:
        good, drawn, total = s["good"], s["drawn"], s["good"] + s["bad"]
        share = good / F.greatest(total, F.lit(1))
        mean = drawn * share
        spread = F.sqrt(mean * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1)))
        low = F.greatest(F.lit(0).cast("long"), drawn - s["bad"], F.floor(mean - 9 * spread - 12))
        high = F.least(drawn, good, F.ceil(mean + 9 * spread + 12))
        middle = F.least(high, F.greatest(low, F.floor(mean)))
        return F.struct(*[s[c].alias(c) for c in ("good", "bad", "drawn", "u")],
                        low.alias("low"), high.alias("high"), middle.alias("middle"))

    def minus_log_weight(s: Column, k: Column) -> Column:
        parts = (k, s["good"] - k, s["drawn"] - k, s["bad"] - s["drawn"] + k)
        a, b, c, d = (log_factorial(part) for part in parts)
        return a + b + c + d

    def weighed(s: Column) -> Column:
        top = minus_log_weight(s, s["middle"])
        weights = _bound(
            F.struct(s.alias("s"), top.alias("top")),
            lambda t: F.transform(
                F.sequence(t["s"]["low"], t["s"]["high"]),
                lambda k: F.exp(t["top"] - minus_log_weight(t["s"], k)),
            ),
        )
        return F.struct(weights.alias("w"), s["low"].alias("low"), s["u"].alias("u"))

    def passed(s: Column) -> Column:
        limit = s["u"] * F.aggregate(s["w"], F.lit(0.0), lambda a, w: a + w)
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below"))
        found = _bound(
            F.struct(s["w"].alias("w"), limit.alias("limit")),
            lambda t: F.aggregate(
                F.slice(t["w"], F.lit(1), F.size(t["w"]) - 1),
                start,
                lambda a, w: F.struct(
                    (a["sum"] + w).alias("sum"),
                    (a["below"] + F.when(a["sum"] + w < t["limit"], 1).otherwise(0)).cast("long").alias("below"),
                ),
                lambda a: a["below"],
            ),
        )
        return s["low"] + found

    given = F.struct(good.alias("good"), bad.alias("bad"), drawn.alias("drawn"), u.alias("u"))
    return _bound(_bound(_bound(given, ranged), weighed), passed)


def _left_quotas(slots: Column, seed: str) -> Column:
    """Blocks of each source that go to the left half, which has `slots` of them; `quotas`, `first`, `shards` are columns."""

    def draw(seen: Column, s: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(seed), "first", "shards", s["at"]))
        u = (_number(digest) + 0.5) / float(1 << 48)
        good = s["quota"]
        bad, drawn = seen["blocks"] - good, seen["slots"]
        taken = hypergeometric(good, bad, drawn, u)
        return _bound(
            F.struct(taken.alias("k")),
            lambda t: F.struct(
                (seen["blocks"] - good).alias("blocks"),
                (seen["slots"] - t["k"]).alias("slots"),
                F.concat(seen["left"], F.array(t["k"])).alias("left"),
            ),
        )

    numbered = F.transform("quotas", lambda q, at: F.struct(q.alias("quota"), at.alias("at")))
    blocks = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(blocks.alias("blocks"), slots.alias("slots"), F.array().cast("array<bigint>").alias("left"))
    return F.aggregate(numbered, start, draw, lambda seen: seen["left"])


def splitting_tree(quotas: DataFrame, shard_blocks: int, seed: str) -> DataFrame:
    """(number, at, shard) for each block of each source's quota. quotas: number, quota."""
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    n_shards = max(1, -(-total // shard_blocks))
    listed = F.sort_array(F.collect_list(F.struct("number", "quota")))
    nodes = quotas.agg(listed.alias("q")).select(
        F.lit(0).cast("long").alias("first"),
        F.lit(n_shards).cast("long").alias("shards"),
        F.transform("q", lambda q: q["number"]).alias("numbers"),
        F.transform("q", lambda q: q["quota"]).alias("quotas"),
        F.transform("q", lambda q: F.lit(0).cast("long")).alias("starts"),
    )

    def slots_before(shard: Column) -> Column:
        return F.floor(shard * F.lit(total).cast("decimal(38,0)") / n_shards).cast("long")

    # Level by level; a node of one shard stays as it is. Halves differ by one shard at most.
    for level in range((n_shards - 1).bit_length()):
        half = F.floor(F.col("shards") / 2)
        slots = slots_before(F.col("first") + half) - slots_before(F.col("first"))
        nodes = nodes.withColumn("left", F.when(F.col("shards") > 1, _left_quotas(slots, seed)))
        lower = F.struct("first", half.alias("shards"), "numbers", F.col("left").alias("quotas"), "starts")
        upper = F.struct(
            (F.col("first") + half).alias("first"),
            (F.col("shards") - half).alias("shards"),
            "numbers",
            F.zip_with("quotas", "left", lambda q, k: q - k).alias("quotas"),
            F.zip_with("starts", "left", lambda s, k: s + k).alias("starts"),
        )
        same = F.struct("first", "shards", "numbers", "quotas", "starts")
        nodes = nodes.select(F.explode(F.when(F.col("left").isNull(), F.array(same)).otherwise(F.array(lower, upper))))
        nodes = nodes.select("col.*")
        if level % 6 == 5:
            nodes = stored(nodes.repartition("first"), "mix-tree")
    leaves = nodes.select(
        F.col("first").alias("shard"), F.explode(F.arrays_zip("numbers", "quotas", "starts")).alias("leaf")
    ).where("leaf.quotas > 0")
    last = F.col("leaf.starts") + F.col("leaf.quotas") - 1
    return leaves.select(
        F.col("leaf.numbers").alias("number"), F.explode(F.sequence("leaf.starts", last)).alias("at"), "shard"
    )


def drawn(
    docs: DataFrame, percent: int = 150, most: int = 2, block_words: int = 32_768, shard_blocks: int = 256,
    seed: str = "mix",
) -> DataFrame:
    """row, doc_id, source, size, source_size, target, key, copies: array<struct<copy, shard>>; a row for each document.

    `row` numbers the rows of this result only.
    """
    rows = stored(sized(docs), "mix-sizes")
    sources = stored(source_targets(rows, percent, most, block_words), "mix-sources")
    named = sources.withColumnRenamed("source", "name")
    rows = rows.join(named, F.expr("source <=> name")).drop("name")
    rows = rows.withColumn("block", _number(F.col("key")) % F.col("n_blocks"))
    stream = stored(block_stream(rows, most, seed), "mix-stream")
    quotas = stream.groupBy("number").agg(F.count("*").alias("quota"))
    places = splitting_tree(quotas, shard_blocks, seed)
    blocks = stream.join(places, ["number", "at"]).groupBy("number", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "shard", F.col("rest").isNull().alias("whole")))).alias("units")
    )
    picks = last_picks(rows, stream).withColumn("picked", F.lit(True))
    found = rows.join(blocks, ["number", "block"], "left").join(picks, ["number", "key"], "left")
    taken = F.filter("units", lambda unit: unit["whole"] | F.col("picked").isNotNull())
    copies = F.transform(taken, lambda unit: F.struct(unit["copy"].alias("copy"), unit["shard"].alias("shard")))
    return stored(
        found.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source", "size", "source_size", "target", "key",
            F.coalesce(copies, F.array().cast("array<struct<copy: int, shard: bigint>>")).alias("copies"),
        ),
        "mix-draws",
    )


def mixed(draws: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix: shard, position (from 0, gapless), row, doc_id, source, size, copy; a row for each copy of a document."""
    each = draws.select("row", "doc_id", "source", "size", "key", F.explode("copies").alias("c"))
    each = each.select("c.shard", "row", "doc_id", "source", "size", "c.copy", "key")
    order = Window.partitionBy("shard").orderBy(F.md5(F.concat_ws(":", F.lit(seed), "key", "copy")), "row")
    return each.select(
        "shard", (F.row_number().over(order) - 1).alias("position"), "row", "doc_id", "source", "size", "copy"
    )


def mix_report(draws: DataFrame, mix: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of each document."""
    taken = mix.groupBy("row").agg(F.sum("size").alias("words"))
    return draws.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken")
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents),
n AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM d GROUP BY source),
c AS (SELECT *, 2 * source_size AS most, [5, 2, 1][number % 3 + 1] AS weight FROM n),
l AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100 - coalesce(sum(most) OVER o, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM c WINDOW o AS (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT number, source, source_size,
         CASE WHEN level * weight >= most THEN CAST(most AS DOUBLE)
              ELSE max(CASE WHEN level * weight < most THEN level END) OVER () * weight END AS target,
         greatest(1, CAST(ceil((source_size + 16 * docs) / 32768) AS BIGINT)) AS n_blocks
  FROM l),
r AS (
  SELECT d.row, d.doc_id, d.size, d.key, t.*, CAST('0x' || substr(key, 1, 12) AS BIGINT) % n_blocks AS block
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT number, target, block, sum(size) AS words FROM r GROUP BY ALL),
u AS (SELECT *, md5('mix:' || number || ':' || copy || ':' || block) AS ord FROM b, range(2) AS x(copy)),
p AS (
  SELECT *, coalesce(sum(words) OVER (
    PARTITION BY number ORDER BY copy, ord, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM u),
s AS (SELECT number, block, copy, CASE WHEN words > target - before THEN target - before END AS rest FROM p WHERE before < target),
k AS (SELECT number, rest, key, sum(size) AS size FROM r JOIN s USING (number, block) WHERE rest IS NOT NULL GROUP BY ALL),
f AS (
  SELECT *, row_number() OVER (PARTITION BY number ORDER BY key) AS i,
         sum(size) OVER (PARTITION BY number ORDER BY key) <= rest AS fits
  FROM k),
f1 AS (SELECT number, max(rest) - coalesce(sum(size) FILTER (fits), 0) AS gap FROM f GROUP BY number),
o AS (
  SELECT number, key, size, gap, row_number() OVER (PARTITION BY number ORDER BY size DESC, key) AS i
  FROM f JOIN f1 USING (number) WHERE NOT fits),
g(number, i, gap, taken, key) AS (
  SELECT number, 0, gap, false, CAST(NULL AS VARCHAR) FROM f1
  UNION ALL
  SELECT g.number, o.i, CASE WHEN o.size <= g.gap THEN g.gap - o.size ELSE g.gap END, o.size <= g.gap, o.key
  FROM g JOIN o ON o.number = g.number AND o.i = g.i + 1),
z AS (
  SELECT number, min_by(o.key, (o.size, o.key)) AS key, min(o.size) AS size, (SELECT min(gap) FROM g y WHERE y.number = o.number) AS gap
  FROM o JOIN g USING (number, key) WHERE NOT g.taken GROUP BY number),
picks AS (
  SELECT number, key FROM f WHERE fits UNION ALL SELECT number, key FROM g WHERE taken
  UNION ALL SELECT number, key FROM z WHERE size < 2 * gap)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * count(s.copy) FILTER (s.rest IS NULL OR picks.key IS NOT NULL) AS BIGINT) AS taken
FROM r LEFT JOIN s USING (number, block) LEFT JOIN picks ON picks.number = r.number AND picks.key = r.key
GROUP BY r.row, r.doc_id, r.size, r.source_size, r.target
"""
