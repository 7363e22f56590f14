"""Connected components of links between nodes, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it sees."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b). Returns (node, root) for each node that has a link; root is the least node of its component.

    Alternating large and small stars; each round is written, so a lost executor costs one round at most. The number
    of rounds follows the logarithm of the longest path. No list of neighbours is ever gathered.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    state = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        mark = F.xxhash64("a", "b")
        now = tuple(links.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stored(links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "roots")
