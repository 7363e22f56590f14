"""Operator 3: near-duplicate documents by MinHash with tensored banding.

A document is its set of word shingles. Two small collections of band hashes, A_1..A_t and B_1..B_t of five minhashes
each, give t * t tables with the keys (A_i, B_j): 676 tables from 260 minhashes instead of 6,760. Two sets of
similarity 0.8 miss all tables with a probability under 1 in 10,000, and every candidate is verified on the full sets.

* Equal sets are one node, so copies never meet in a table.
* A pair (A_i, B_j) can only be shared if A_i and B_j are; keys shared by no other node make no table rows.
* Of the nodes that could meet, the shingles that only one of them has are counted. They can be in no intersection, so
  a node with more than a fifth of them has no link, and two nodes whose other shingles cannot make up 0.8 of their
  union are no candidates. Documents that merely share a passage end here.
* Every node is first compared with one representative of its buckets. Verified links are contracted, and only nodes of
  different components in a bucket are compared further: with one representative of each other component while
  that links more, twice at most, and then all of them whose sketches leave a link possible (see `parities`). No pair that shares a table is left unchecked or implied, and the pairs of a
  settled group are not listed.

Nulls: a null or blank text has an empty set and is linked with nothing; a null doc_id takes part, and is never the
smallest id (a group of null ids only has a null component_id). Repeated rows are copies of each other and each gets
a row. An empty table gives no rows. Very long texts are read whole; their sets are rows of their own, 8 bytes a shingle.
A similarity of exactly `percent` is a link. An id that several texts have names each of their components alike.
The working columns end in an underscore and a random part, so that none of the table's clashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailybars.llm.common import holds, release_others, stored, texts_of
from dailybars.llm.components import components

BANDS, ROWS = 26, 5
SEEN_WORDS = 300_000
SIGNATURES = "doc_id long, n_shingles long, set_key binary, bands array<long>"
SETS = "set_key binary, shingles binary, sketch array<long>"
SKETCH_WORDS = 16
_words: dict[bytes, int] = {}
holds("near_dedup", _words.clear)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in small parts: what a task holds as Python objects follows a part, not a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_hash(word: bytes) -> int:
    value = _words.get(word)
    if value is None:
        if len(_words) >= SEEN_WORDS:
            _words.clear()
        value = _words[word] = xxhash.xxh64_intdigest(word)
    return value


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `size` words; of all words if there are fewer."""
    words = text.encode().lower().split()
    n, width = len(words), min(len(words), size)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hash, words), np.uint64, n)
    joined = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        joined = (joined ^ hashes[j : n - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        joined ^= joined >> np.uint64(29)
    return np.unique(joined)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    n = 2 * BANDS * ROWS
    return draw.integers(0, 2**64, n, np.uint64), draw.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(hashes: np.ndarray, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    least = np.full(len(keys[0]), 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[at : at + 2048, None] ^ keys[0]) * keys[1]).min(axis=0), out=least)
    return least


def band_hashes(least: np.ndarray) -> list[int]:
    """One signed 64-bit value for each band; its number is part of it, so bands never meet."""
    rows = least.reshape(2 * BANDS, ROWS)
    joined = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        joined = (joined ^ rows[:, j]) * np.uint64(0xD6E8FEB86659FD93)
        joined ^= joined >> np.uint64(32)
    return joined.view(np.int64).tolist()


def signatures(texts: DataFrame, size: int) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others("near_dedup")
        keys = _permutations()
        for batch in slices(batches):
            counts, nodes, bands = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingles(text, size)
                counts.append(len(hashes))
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(band_hashes(minhashes(hashes, keys)) if len(hashes) else None)
            types = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            made = [pa.array(x, t) for x, t in zip((counts, nodes, bands), types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *made], ["doc_id", "n_shingles", "set_key", "bands"]
            )

    return texts.mapInArrow(tasks, SIGNATURES)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of 1,024 cells, by the hash's first ten bits, whether an odd number of shingles falls there.

    What two sets share cancels out: the bits that differ are no more than the shingles that only one of them has.
    """
    odd = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sets_of(texts: DataFrame, size: int) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [shingles(text, size) for text in batch.column("text").to_pylist()]
            packed = [x.tobytes() for x in made]
            keys = pa.array([xxhash.xxh3_128_digest(x) for x in packed], pa.binary())
            sketches = pa.array([parities(x) for x in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(packed, pa.binary()), sketches], ["set_key", "shingles", "sketch"])

    return texts.mapInArrow(tasks, SETS)


def shared_bands(rows: DataFrame) -> DataFrame:
    """Rows (node, band, value) whose value at least two nodes have."""
    values = rows.groupBy("value").agg(F.count("*").alias("c")).where("c > 1").select("value")
    return rows.join(values, "value").select("node", "band", "value")


def can_meet(bands: DataFrame) -> DataFrame:
    """Nodes with a band of either collection."""
    sides = bands.groupBy("node").agg(F.min("band").alias("x"), F.max("band").alias("y"))
    return sides.where((F.col("x") < BANDS) & (F.col("y") >= BANDS)).select("node")


def table_rows(bands: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, node, n, own) of the tables whose key at least two nodes share, and each node's bands.

    nodes: (node, n, own, sketch).
    """
    sides = shared_bands(bands.join(nodes.select("node"), "node")).groupBy("node").agg(
        F.collect_list(F.when(F.col("band") < BANDS, F.col("value"))).alias("a"),
        F.collect_list(F.when(F.col("band") >= BANDS, F.col("value"))).alias("b"),
    )
    sides = stored(sides.join(nodes, "node"), "sides")
    rows = sides.select("node", "n", "own", F.explode("a").alias("x"), "b")
    rows = rows.select("node", "n", "own", "x", F.explode("b").alias("y"))
    rows = stored(rows.select(F.xxhash64("x", "y").alias("key"), "node", "n", "own"), "tables")
    keys = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    return stored(rows.join(keys, "key"), "buckets"), sides


def own_shingles(sets: DataFrame) -> DataFrame:
    """(node, own): how many of its shingles no other of these nodes has; nodes without any are left out."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = batch.column("shingles").to_pylist()
            nodes = np.repeat(batch.column("node").to_numpy(), [len(x) // 8 for x in packed])
            hashes = np.frombuffer(b"".join(packed), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(nodes, pa.int64())], ["shingle", "node"])

    rows = sets.select("node", "shingles").mapInArrow(tasks, "shingle long, node long")
    single = rows.groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    return single.groupBy("node").agg(F.count("*").alias("own"))


def _fits(a: str, b: str, percent: int):
    """What is not only one's own can make up `percent` of the union. a, b: prefixes of the columns n and own."""
    both = f"least({a}n - {a}own, {b}n - {b}own)"
    return F.expr(f"(100 + {percent}) * {both} >= {percent} * ({a}n + {b}n)")


def _near(a: str, b: str, percent: int) -> str:
    """The sketches do not rule out that what only one set has is few enough for the union."""
    differ = " + ".join(f"bit_count({a}sketch[{i}] ^ {b}sketch[{i}])" for i in range(SKETCH_WORDS))
    return f"(100 + {percent}) * ({differ}) <= (100 - {percent}) * ({a}n + {b}n)"


def star_pairs(buckets: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): nodes with one representative of a bucket, which differs by turn.

    A node is asked once in the first turn, and once for each other component in later ones, however many tables it
    shares with them.
    """
    # A node with few shingles of its own has the most links.
    first = F.col("own") if turn == 0 else F.xxhash64("node", F.lit(turn))
    order = F.struct(first.alias("first"), "node", "n", "own", "comp")
    chosen = buckets.groupBy("key").agg(F.min(order).alias("r"))
    pairs = buckets.join(chosen, "key").where("node <> r.node AND comp <> r.comp").where(_fits("", "r.", percent))
    once = ["node"] if turn == 0 else ["node", F.col("r.comp").alias("other")]
    pairs = pairs.groupBy(*once).agg(F.min("r").alias("r"))
    return pairs.select(F.least("node", "r.node").alias("a"), F.greatest("node", "r.node").alias("b")).distinct()


def cross_pairs(buckets: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs that share a table and lie in different components.

    Two nodes share a table if they share a band of either collection. They meet in each shared band of the first,
    and make a pair in the least of those only.
    """
    open_nodes = buckets.select("node", "comp").distinct()
    rows = sides.join(open_nodes, "node").select("*", F.explode("a").alias("x"))
    other = rows.select("x", *[F.col(c).alias(f"{c}_") for c in ("node", "comp", "a", "b")], F.struct("n", "own", "sketch").alias("o"))
    pairs = rows.join(other, "x").where("node < node_ AND comp <> comp_").where(_fits("", "o.", percent))
    pairs = pairs.where(_near("", "o.", percent))
    pairs = pairs.where("arrays_overlap(b, b_) AND x = array_min(array_intersect(a, a_))")
    return pairs.select(F.col("node").alias("a"), F.col("node_").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of at least percent / 100."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    joined = joined.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(tasks, "a long, b long")


def unsettled(buckets: DataFrame, names: DataFrame) -> DataFrame:
    """Buckets whose nodes are of more than one component, each node with its component."""
    named = buckets.drop("comp").join(names.withColumnRenamed("root", "comp"), "node", "left")
    named = named.withColumn("comp", F.coalesce("comp", "node"))
    open_keys = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    return stored(named.join(open_keys.select("key"), "key"), "unsettled")


def links_of(
    buckets: DataFrame, sides: DataFrame, sets: DataFrame, percent: int, turns: int = 2, few: int = 8
) -> DataFrame:
    """Enough verified links (a, b) that every linked pair which shares a table is in one component.

    Stars go on while they link something. All unsettled pairs are listed once they do not, once there are at most `few`
    for each open node, or after `turns` stars.
    """
    rest = buckets.withColumn("comp", F.col("node"))
    links = asked = None
    linked = True
    for turn in range(turns + 1):
        each = rest.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key")
        each = each.agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("s"))
        unsettled_pairs = each.agg(F.sum((F.col("n") * F.col("n") - F.col("s")) / 2)).first()[0]
        if not unsettled_pairs:
            break
        nodes = rest.select("node").distinct().count()
        final = turn == turns or not linked or (turn and unsettled_pairs <= few * nodes)
        pairs = cross_pairs(rest, sides, percent) if final else star_pairs(rest, turn, percent)
        pairs = pairs if asked is None else pairs.join(asked, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(verified(pairs, sets, percent), "found")
        linked = found.limit(1).count() > 0
        links = found if links is None else links.unionByName(found)
        asked = pairs if asked is None else asked.unionByName(pairs)
        if final:
            break
        rest = unsettled(rest, components(links)) if linked else rest
    return links


def grouped(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, set_key) of all documents, and (set_key, node, least_id, root) of all sets."""
    texts = texts_of(docs)
    rows = stored(signatures(texts, size), "signatures")
    nodes = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("least_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands")
    )
    # The number is fixed by writing it.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = stored(shared_bands(nodes.select("node", F.posexplode("bands").alias("band", "value"))), "bands")
    wanted = stored(can_meet(bands).join(nodes.select("set_key", "node", "least_id", "n"), "node"), "wanted")
    chosen = texts.join(
        wanted.select(F.col("least_id").alias("wanted_id")).distinct(), F.expr("doc_id <=> wanted_id"), "left_semi"
    )
    sets = sets_of(chosen.where(r"text RLIKE '[^\\x20\\x09-\\x0D]'"), size)
    sets = sets.join(wanted.select("set_key", "node"), "set_key").dropDuplicates(["set_key"])
    sets = stored(sets.select("node", "shingles", "sketch"), "sets")
    linkable = wanted.select("node", "n").join(own_shingles(sets), "node", "left").fillna({"own": 0})
    linkable = linkable.join(sets.select("node", "sketch"), "node")
    linkable = stored(linkable.where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")), "linkable")
    links = links_of(*table_rows(bands, linkable), sets, percent)
    named = nodes.select("set_key", "node", "least_id")
    if links is not None:
        named = named.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        named = named.withColumn("root", F.col("node"))
    return rows, named


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each document."""
    rows, named = grouped(docs, size, percent)
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = named.join(least, "root").select("set_key", "component_id")
    out = rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: that with the smallest doc_id, without an id last.

    Documents with an empty set are in no group and all stay.
    """
    _, named = grouped(docs, size, percent)
    key, keep_id, keep_key = (f"{name}_{uuid.uuid4().hex[:8]}_" for name in ("set_key", "keep_id", "keep_key"))
    order = F.struct(F.col("least_id").isNull().alias("none"), "least_id", "set_key")
    chosen = named.groupBy("root").agg(F.min(order).alias("c"))
    chosen = chosen.select(F.col("c.least_id").alias(keep_id), F.col("c.set_key").alias(keep_key))
    marked = with_set_key(docs, size, key)
    same = (F.col(key) == F.col(keep_key)) & marked["doc_id"].eqNullSafe(F.col(keep_id))
    first = marked.join(chosen, same, "left_semi").dropDuplicates([key, "doc_id"])
    return first.unionByName(marked.where(F.col(key).isNull())).drop(key)


def with_set_key(docs: DataFrame, size: int, name: str) -> DataFrame:
    """docs and, under that name, the hash of each text's set; null for an empty set."""
    at = docs.columns.index("text")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [shingles(text or "", size) for text in batch.column(at).to_pylist()]
            nodes = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in made]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nodes, pa.binary())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(tasks, T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))
