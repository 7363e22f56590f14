"""Operator 10: language-model scoring of documents by cross-entropy difference.

Two n-gram models of the same kind, over one vocabulary and with the same smoothing: the target model counts the
documents chosen as good (label quality 1, not toxic), the background model counts all documents. A document's score is
the mean over its tokens of target loss minus background loss, in nats; lower is closer to the target.

* Vocabulary: every word of all documents, and one unknown word besides. A caller may ask for the `vocabulary` most
  frequent words only (ties by the word); every other word is then the unknown one.
* Both models interpolate a bigram with a smoothed unigram, and count every word and bigram of all documents. The first
  word of a document has no predecessor and is scored by the unigram alone.

Words and bigrams are known by 64-bit hashes; n different ones are expected to hold n * n / 2^65 pairs that share a hash.
Nothing of the models lies in one place. Documents are tokenized once into stored cells of about a million tokens:

1. a cell asks for each of its distinct words and bigrams once, with its own counts, in one message for each bucket, a range
   of hashes; a message is a sorted list of hashes, written as gaps;
2. a bucket adds the counts of equal hashes and answers each message in the order in which it asked;
3. a cell reads its answers, works out the loss of each distinct bigram and adds up its documents.

The number of buckets follows from the number of tokens. A frequent word is one entry of each cell's message, so no
bucket grows with it. A document longer than a cell goes on in the next one, with its last word as predecessor.

Nulls: a null or blank text has no tokens and scores 0; a null doc_id or label is never target. Repeated rows are
counted and scored each. Without target documents, its model is the smoothing alone. An empty table gives no rows. Very
long texts are counted whole. Counts have no ties to break.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.llm.common import release_others, stored, texts_of

WORD = re.compile(r"\w+|[^\w\s]")
VOCABULARY = None  # all words
WEIGHT = 0.7  # of the bigram
SMOOTHING = 0.1
HELD_WORDS = 500_000
CELL_TOKENS = 1_000_000
CELL_TEXTS = 50_000
BUCKET_TOKENS = 2_000_000
UNKNOWN = " "  # no word
CELLS = (
    "cell long, n_tokens long, rows array<long>, doc_ids array<long>, sizes array<long>, continued array<boolean>, "
    "words binary, ids binary"
)
ASKED = "kind int, bucket int, cell long, keys binary, counts binary"
ANSWERS = "kind int, bucket int, cell long, distinct long, target long, counts binary"
SCORED = "row long, doc_id long, n long, target_loss double, background_loss double"
WORDS, BIGRAMS = 0, 1


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^64 by planes of bytes; planes of small numbers are empty and take no room."""
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers: multiplications and shifts, modulo 2^64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def most_frequent_words(texts: DataFrame, size: int) -> list[str]:
    """At most `size`, as asked for."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(tokens(text))
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    counts = texts.select("text").mapInArrow(tasks, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [row["word"] for row in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


class Numbers(dict):
    """The place of each word in the order of its first look-up; words outside `known`, if given, are the unknown one."""

    def __init__(self, known: frozenset | None):
        super().__init__()
        self.known, self.words = known, []

    def __missing__(self, word: str) -> int:
        if self.known is not None and word not in self.known and word != UNKNOWN:
            self[word] = self[UNKNOWN]
            return self[word]
        self[word] = len(self.words)
        self.words.append(word)
        return self[word]


def cells_of(docs: DataFrame, vocabulary: int | None, cell_tokens: int) -> DataFrame:
    """The stored cells: numbered words of consecutive documents, or of parts of a long one."""
    texts = texts_of(docs)
    kept = None
    if vocabulary is not None:
        kept = docs.sparkSession.sparkContext.broadcast(most_frequent_words(texts, vocabulary))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others("lm_scoring")
        known = None if kept is None else frozenset(kept.value)
        part = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [("cell", pa.int64()), ("n_tokens", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("rows", "doc_ids", "sizes")]
            + [("continued", pa.list_(pa.bool_())), ("words", pa.binary()), ("ids", pa.binary())]
        )
        made = row = 0

        def fresh():
            return Numbers(known), [], [], [], [], []

        numbers, ids, rows, doc_ids, sizes, continued = fresh()
        held = 0

        def cell() -> pa.RecordBatch:
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers.words], dtype=np.uint64)
            every = np.concatenate([*ids, np.empty(0, np.uint32)])
            values = [part + made, held, rows, doc_ids, sizes, continued, hashes.tobytes(), squeezed(every)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = map(re.Match.group, WORD.finditer(text.lower())) if len(text) > cell_tokens else iter(tokens(text))
                before = None
                while True:
                    words = list(islice(found, max(1, cell_tokens - held)))
                    if words or before is None:
                        # A part that goes on begins with the word before it, which is not counted again.
                        read = words if before is None else [before, *words]
                        ids.append(np.fromiter(map(numbers.__getitem__, read), np.uint32, len(read)))
                        rows.append(part + row)
                        doc_ids.append(doc_id)
                        sizes.append(len(read))
                        continued.append(before is not None)
                        held += len(words)
                    more = bool(words) and held >= cell_tokens
                    if more or len(rows) >= CELL_TEXTS:
                        yield cell()
                        made += 1
                        numbers, ids, rows, doc_ids, sizes, continued = fresh()
                        held = 0
                    if not more:
                        break
                    before = words[-1]
                row += 1
        if rows:
            yield cell()

    return stored(texts.mapInArrow(tasks, CELLS), "lm-cells")


class Cell:
    """The distinct words and bigrams of a cell, each kind in the order of its hashes."""

    def __init__(self, record: dict):
        self.hashes = np.frombuffer(record["words"], np.uint64)
        ids = unsqueezed(record["ids"]).astype(np.int64)
        sizes = np.array(record["sizes"], dtype=np.int64)
        continued = np.array(record["continued"], dtype=bool)
        segment = np.repeat(np.arange(len(sizes)), sizes)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        lead = np.zeros(len(ids), dtype=bool)
        lead[starts] = True
        again = np.zeros(len(ids), dtype=bool)
        again[starts] = continued[sizes > 0]
        #: Places of tokens that count, of those that have a predecessor, and their parts of documents.
        counted = np.flatnonzero(~again)
        self.word, self.word_segment = ids[counted], segment[counted]
        self.alone, self.alone_segment = ids[lead & ~again], segment[lead & ~again]
        follows = np.flatnonzero(~lead)
        self.follow_segment = segment[follows]
        pairs, self.pair = np.unique(ids[follows - 1] * len(self.hashes) + ids[follows], return_inverse=True)
        self.first, self.second = np.divmod(pairs, max(1, len(self.hashes)))
        keys = mixed(mixed(self.hashes[self.first]) + self.hashes[self.second])
        self.keys = {WORDS: mixed(self.hashes), BIGRAMS: keys}
        self.order = {kind: np.argsort(keys, kind="stable") for kind, keys in self.keys.items()}
        self.parts = len(sizes)

    def counts(self, kind: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word or bigram, in chosen parts and in all."""
        place, segment = (self.word, self.word_segment) if kind == WORDS else (self.pair, self.follow_segment)
        n = len(self.keys[kind])
        return np.bincount(place[chosen[segment]], minlength=n), np.bincount(place, minlength=n)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of sorted hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def asked(cells: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, cell, keys, counts): what each cell holds of each bucket."""
    chosen = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(labels["doc_id"].cast("long").alias("id"))
    places = cells.select("cell", F.posexplode("doc_ids").alias("place", "id")).where("id IS NOT NULL")
    # The ids grow with the corpus: the same shuffled joins at every size.
    target = places.join(chosen.distinct().hint("merge"), "id").groupBy("cell").agg(F.collect_list("place").alias("target"))
    flagged = cells.join(target.hint("merge"), "cell", "left").select(*cells.columns, "target")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                record = batch.slice(i, 1).to_pylist()[0]
                cell = Cell(record)
                chosen = np.zeros(cell.parts, dtype=bool)
                chosen[record["target"] or []] = True
                columns: list[list] = [[], [], [], [], []]
                for kind in (WORDS, BIGRAMS):
                    order = cell.order[kind]
                    keys = cell.keys[kind][order]
                    t, b = (c[order] for c in cell.counts(kind, chosen))
                    bucket = bucket_of(keys, buckets)
                    ends = np.flatnonzero(np.diff(bucket, append=np.uint64(buckets))) + 1
                    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                        gaps = np.diff(keys[start:end], prepend=np.uint64(0))
                        sent = (kind, int(bucket[start]), record["cell"], squeezed(gaps), squeezed([t[start:end], b[start:end]]))
                        for column, value in zip(columns, sent):
                            column.append(value)
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                names = [c.split()[0] for c in ASKED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types)], names)

    return flagged.mapInArrow(tasks, ASKED)


def added(group: pa.Table) -> pa.Table:
    """The answers of a bucket: counts over all cells in place of a cell's own."""
    keys = [np.cumsum(unsqueezed(k), dtype=np.uint64) for k in group.column("keys").to_pylist()]
    t, b = np.concatenate([unsqueezed(c).reshape(2, -1) for c in group.column("counts").to_pylist()], axis=1).astype(np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[order[1:]] != every[order[:-1]]
    starts = np.flatnonzero(new)
    place = np.empty(len(every), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    target = int(t.sum())
    t, b = (np.add.reduceat(c[order], starts)[place] for c in (t, b))
    ends = np.cumsum([len(k) for k in keys]).tolist()
    counts = [squeezed([t[i:j], b[i:j]]) for i, j in zip([0, *ends[:-1]], ends)]
    # Said once: how many different ones the bucket has, and how often they stand in target documents.
    rest = [0] * (len(keys) - 1)
    said = [pa.array([n, *rest], pa.int64()) for n in (len(starts), target)]
    columns = [*(group.column(c) for c in ("kind", "bucket", "cell")), *said, pa.array(counts, pa.binary())]
    return pa.table(columns, names=[c.split()[0] for c in ANSWERS.split(", ")])


def cross_entropy_difference(
    docs: DataFrame,
    labels: DataFrame,
    vocabulary: int | None = VOCABULARY,
    cell_tokens: int = CELL_TOKENS,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score."""
    cells = cells_of(docs, vocabulary, cell_tokens)
    n_tokens = cells.agg(F.sum("n_tokens")).first()[0] or 0
    messages = asked(cells, labels, n_tokens // bucket_tokens + 1)
    answers = stored(messages.groupBy("kind", "bucket").applyInArrow(added, ANSWERS), "lm-answers")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "target")]
    words, target_tokens = answers.where(F.col("kind") == WORDS).agg(*sums).first()
    # Where the vocabulary is cut, the unknown word is one of those found.
    size = (words if vocabulary is None else min(words, vocabulary)) + 1
    totals = target_tokens, n_tokens

    def scored(heard: pa.Table, held: pa.Table) -> pa.Table:
        (record,) = held.to_pylist()
        cell = Cell(record)
        replies = sorted(heard.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        told = {kind: np.empty((2, len(keys)), dtype=np.int64) for kind, keys in cell.keys.items()}
        for kind, order in cell.order.items():
            got = [unsqueezed(r["counts"]).reshape(2, -1) for r in replies if r["kind"] == kind]
            if got:
                told[kind][:, order] = np.concatenate(got, axis=1)
        losses = []
        for model in (0, 1):
            n, pair_n = told[WORDS][model], told[BIGRAMS][model]
            single = (n + SMOOTHING) / (totals[model] + SMOOTHING * size)
            before = n[cell.first]
            both = WEIGHT * pair_n / np.maximum(before, 1) + (1 - WEIGHT) * single[cell.second]
            loss = -np.log(np.where(before > 0, both, single[cell.second]))
            later = np.bincount(cell.follow_segment, loss[cell.pair], cell.parts)
            losses.append(later + np.bincount(cell.alone_segment, -np.log(single[cell.alone]), cell.parts))
        n = np.bincount(cell.word_segment, minlength=cell.parts)
        columns = (record["rows"], record["doc_ids"], n, *losses)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(c, x) for c, x in zip(columns, types)], names=[c.split()[0] for c in SCORED.split(", ")])

    by_cell = answers.groupBy("cell").cogroup(cells.groupBy("cell")).applyInArrow(lambda heard, held: scored(heard, held), SCORED)
    # A long document has a row from each of its cells.
    summed = by_cell.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n", "target_loss", "background_loss"))
    )
    target, background = (F.col(c) / F.greatest("n", F.lit(1)) for c in ("target_loss", "background_loss"))
    return summed.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        target.alias("target_loss"),
        background.alias("background_loss"),
        (target - background).alias("score"),
    )
