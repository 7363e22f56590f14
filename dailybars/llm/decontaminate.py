"""Operator 8: find benchmark items in training documents with a BM25 index and block-max WAND.

The index holds the test items; every passage of every document is a query: `PASSAGE` words, beginning every half of
that, so that any stretch of up to half a passage lies whole in one. Weights are BM25 divided by what the item would
score on itself, so that one threshold serves all items. Blocks whose bounds cannot reach it are skipped, and items
without an essential term; bounds are taken for all passages of a text at once. All items above the threshold
are retrieved, and each is verified on words: the share of its 5-word shingles that stand in the passage (widened by the
length of the item), of the whole item and of its question and answer, the last line or sentence of an item being
the answer. It is reported if the share of the whole reaches `OVERLAP`, or the shares of question and answer both do and
the question has the words of a shingle at least.

An index is built from a block of items of at most `BLOCK_BYTES` of text (what is broadcast is bounded by that); more
items make more blocks, each with its own pass. Statistics of terms are those of the block.

Nulls: null and blank texts hold nothing and are found nowhere; null ids are kept as they are. Repeated documents each
get their rows; repeated items count once. Empty tables give no rows. Very long texts are queried passage by passage,
to the end. A score or overlap at its threshold is a hit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.llm.common import holds, release_others, texts_of

PASSAGE = 128
SHINGLE = 5
#: Text with 0.8 of an item's shingles has 0.8 of its words or more; their weights can be somewhat less.
THRESHOLD = 0.6
OVERLAP = 0.8
POSTING_BLOCK = 8
BLOCK_BYTES = 8 << 20
K1, B = 1.2, 0.75
WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+(?=\S)")
HITS = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last line, or of a single line the last sentence."""
    lines = [line for line in text.split("\n") if line.strip()]
    if len(lines) < 2:
        lines = SENTENCE_END.split(text.strip())
    return (" ".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (text, "")


def shingles(words: list[str]) -> set[tuple]:
    """Distinct shingles; all words as one if there are fewer."""
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


class Item:
    def __init__(self, item_id, text: str):
        self.item_id = item_id
        self.words = words_of(text)
        texts = [words_of(part) for part in (text, *question_and_answer(text))]
        self.parts = [shingles(words) for words in texts]
        self.question_counts = len(texts[1]) >= SHINGLE

    def overlaps(self, words: list[str]) -> list[float]:
        """Share of the shingles of item, question and answer that stand in the words. A part without words counts
        as found."""
        there: dict[int, set] = {}
        out = []
        for part in self.parts:
            size = len(next(iter(part))) if part else 0
            if size and size not in there:
                there[size] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
            out.append(len(part & there[size]) / len(part) if part else 1.0)
        return out


class Index:
    """Postings by term and block of consecutive items, with the largest weight of each term in each block.

    A block is the unit that WAND skips: the sum of the bounds of a query's terms in it must reach the threshold. In an
    open block only items with an essential term are scored, that is, not those whose terms all belong to the smallest
    bounds that cannot reach the threshold together.
    """

    def __init__(self, items: list[Item], block: int = POSTING_BLOCK):
        self.items = [item for item in items if item.words]
        counts = [Counter(item.words) for item in self.items]
        n = len(counts)
        mean = sum(len(item.words) for item in self.items) / n if n else 1.0
        df = Counter(word for count in counts for word in count)
        self.terms = {word: i for i, word in enumerate(sorted(df))}
        self.n_blocks = -(-n // block)
        rows = []
        for number, (item, count) in enumerate(zip(self.items, counts)):
            norm = K1 * (1 - B + B * len(item.words) / mean)
            scores = {
                w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for w, tf in count.items()
            }
            # Of an item longer than half a passage only so much need lie in one.
            total = sum(scores.values()) * min(1.0, PASSAGE / 2 / len(item.words))
            rows += [(self.terms[word], number // block, number, score / total) for word, score in scores.items()]
        rows.sort()
        term, self.posting_block, self.posting_item, self.posting_weight = (
            np.array(column, dtype=kind) for column, kind in zip(zip(*rows) if rows else [[]] * 4, (int, int, int, float))
        )
        self.posting_start = np.searchsorted(term, np.arange(len(df) + 1))
        # Segments: the postings of one term in one block.
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (self.posting_block[1:] != self.posting_block[:-1])
        first = np.flatnonzero(new)
        self.segment_block = self.posting_block[first]
        self.segment_most = np.maximum.reduceat(self.posting_weight, first) if len(first) else np.empty(0)
        self.segment_start = np.searchsorted(term[first], np.arange(len(df) + 1))
        # The bound of a term over all blocks; one more entry for words of no item.
        self.most = np.zeros(len(df) + 1)
        np.maximum.at(self.most, term, self.posting_weight)

    @staticmethod
    def _spread(starts: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Indices of all entries of these terms."""
        first, size = starts[terms], starts[terms + 1] - starts[terms]
        ends = np.cumsum(size)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item number, score) of all items that score the threshold or more; terms are distinct."""
        low = threshold - 1e-9
        at = self._spread(self.segment_start, terms)
        bounds = np.bincount(self.segment_block[at], self.segment_most[at], minlength=self.n_blocks)
        opened = bounds >= low
        if not opened.any():
            return []
        essential = terms[np.argsort(self.most[terms], kind="stable")]
        essential = essential[np.cumsum(self.most[essential]) >= low]
        here = self._spread(self.posting_start, essential)
        candidates = np.unique(self.posting_item[here[opened[self.posting_block[here]]]])
        if not len(candidates):
            return []
        at = self._spread(self.posting_start, terms)
        at = at[opened[self.posting_block[at]]]
        scores = np.bincount(self.posting_item[at], self.posting_weight[at], minlength=len(self.items))[candidates]
        hit = scores >= threshold
        return list(zip(candidates[hit].tolist(), scores[hit].tolist()))

    def _promising(self, ids: np.ndarray, threshold: float) -> list[int]:
        """Starts of the passages in which the bound of some block reaches the threshold, for a whole text at once.

        The bounds of a passage are those of its halves together; a word in both only loosens them.
        """
        half, none = PASSAGE // 2, len(self.terms)
        known = np.flatnonzero(ids < none)
        if not len(known):
            return []
        pairs = np.unique(known // half * none + ids[known])
        owner, terms = pairs // none, pairs % none
        at = self._spread(self.segment_start, terms)
        owner = np.repeat(owner, self.segment_start[terms + 1] - self.segment_start[terms])
        n_halves = -(-len(ids) // half)
        cells = owner * self.n_blocks + self.segment_block[at]
        bounds = np.bincount(cells, self.segment_most[at], minlength=n_halves * self.n_blocks)
        bounds = bounds.reshape(n_halves, self.n_blocks)
        if n_halves > 1:
            bounds = bounds[:-1] + bounds[1:]
        return (np.flatnonzero((bounds >= threshold - 1e-6).any(axis=1)) * half).tolist()

    def hits(self, text: str, threshold: float, overlap: float) -> list[tuple]:
        """(item_id, score, overlaps) of the items that stand in a text, each with its best passage."""
        words = words_of(text)
        get, none = self.terms.get, len(self.terms)
        ids = np.fromiter((get(word, none) for word in words), np.int64, len(words))
        best: dict[int, tuple] = {}
        for first in self._promising(ids, threshold):
            last = min(first + PASSAGE, len(words))
            terms = np.unique(ids[first:last])
            terms = terms[: np.searchsorted(terms, none)]
            for number, score in self.search(terms, threshold):
                item = self.items[number]
                wide = words[max(0, first - len(item.words)) : last + len(item.words)]
                shares = item.overlaps(wide)
                apart = item.question_counts and min(shares[1:]) >= overlap
                if shares[0] >= overlap or apart:
                    old = best.get(number)
                    if old is None or (shares[0], score) > (old[1][0], old[0]):
                        best[number] = (score, shares)
        return [(self.items[number].item_id, score, *shares) for number, (score, shares) in sorted(best.items())]


def index_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size: (item_id, text)."""
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")
    )
    items = items.where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-2 * total // block_bytes)  # half full on average, so that no block outgrows the bound
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "text").collect()
        if rows:
            yield [tuple(row) for row in rows]


_indexes: dict[tuple, Index] = {}
holds("decontaminate", _indexes.clear)


def _index(items: list[tuple]) -> Index:
    release_others("decontaminate")
    key = (len(items), hash(tuple(items)))
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index([Item(*item) for item in items])
    return _indexes[key]


def contamination(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap: one row for each item found in a document."""
    spark = docs.sparkSession
    texts = texts_of(docs)
    out = spark.createDataFrame([], HITS)
    for block in index_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def tasks(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    rows += [(doc_id, *hit) for hit in index.hits(text, threshold, overlap)]
                if rows:
                    types = (pa.int64(), pa.int64(), *[pa.float64()] * 4)
                    names = [part.split()[0] for part in HITS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        out = out.unionByName(texts.mapInArrow(tasks, HITS))
    return out


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> DataFrame:
    """The documents in which no item is found, with all their columns. Row by row: no join, no shuffle."""
    spark = docs.sparkSession
    texts_of(docs)
    at = docs.columns.index("text")
    for block in index_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def tasks(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value)
            for batch in batches:
                clean = [not index.hits(text or "", threshold, overlap) for text in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(tasks, docs.schema)
    return docs
