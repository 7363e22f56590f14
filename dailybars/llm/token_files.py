"""Operator 5: token ids of documents in binary shards, document boundaries in Elias-Fano code.

File format. A shard is one byte string: a header, the ids of consecutive documents without gaps (16 bits each
if the vocabulary allows, else 32), the Elias-Fano code of the documents' ends within the shard, and that of
their doc_ids (offset by the smallest). Shards are rows of a Parquet folder, (part, seq) in ascending doc_id
order, so Spark writes, commits and reads them on any file system and a lost executor's shard is written again.
Offsets are local to a shard; where a shard begins in the whole corpus is a sum over shard headers.

Nulls: a null text is empty and has the end id only; documents with a null doc_id come first. Repeated rows are
documents of their own, ordered by text. An empty table makes no shard. A very long text is one document, in a shard as
large as it needs. Ties cannot occur: rows equal in id and text have equal ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailybars.llm import elias_fano, tokenizing
from dailybars.llm.common import stored, texts_of

MAGIC = b"TOKS"
HEAD = struct.Struct("<4sBQQQq")  # magic, bytes of an id, documents, of them with a null id, ids, smallest doc_id
SHARD_IDS = 4_000_000
SHARDS = "part int, seq int, n_ids long, shard binary"
ROWS = "doc_id long, part int, seq int, local long, n_tokens long, ids_crc32 long"


def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """doc_ids: ascending, nulls first. ids: 32-bit little-endian ids of each document."""
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    known = np.array([x for x in doc_ids if x is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    # Differences in unsigned arithmetic: any two 64-bit ids fit.
    spread = known.astype(np.uint64) - np.uint64(least & (2**64 - 1))
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    body = np.frombuffer(b"".join(ids), "<u4").astype("<u2" if width == 2 else "<u4").tobytes()
    head = HEAD.pack(MAGIC, width, len(doc_ids), len(doc_ids) - len(known), total, least)
    names = known.astype("<i8").tobytes() if len(known) and int(spread[-1]) >= 2**40 * len(known) else None
    named = elias_fano.encode(spread, int(spread[-1]) if len(known) else 0) if names is None else names
    return head + body + elias_fano.encode(ends, total) + bytes([names is not None]) + named


class Shard:
    """Random access to the documents of one shard."""

    def __init__(self, data: bytes):
        magic, self.width, self.n, nulls, self.n_ids, least = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, HEAD.size)
        at = HEAD.size + self.width * self.n_ids
        view = memoryview(data)
        self.ends = elias_fano.EliasFano(view[at:])
        at += self.ends.size
        if data[at]:
            known = np.frombuffer(data, "<i8", self.n - nulls, at + 1).tolist()
        else:
            known = [least + int(x) for x in elias_fano.EliasFano(view[at + 1 :]).all()]
        self.doc_ids = [None] * nulls + known

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        first, last = self.bounds(i)
        return self.ids[first:last].astype("<u4")


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenize all documents and store the shards; returns them as written: part, seq, n_ids, shard.

    One shuffle, by ranges of doc_id, of the texts (smaller than their ids). A task holds one shard.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encode = tokenizing.encoder(tokenizer)
        width = 2 if max(encode.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = struct.pack("<I", end_id)
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            arrays = [[part], [seq], [size // 4], [pack(doc_ids, ids, width)]]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(arrays, types)], ["part", "seq", "n_ids", "shard"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids.append(doc_id)
                ids.append(encode.encode(text) + end)
                size += len(ids[-1])
                if size >= 4 * shard_ids:
                    yield shard()
                    doc_ids, ids, size, seq = [], [], 0, seq + 1
        if doc_ids:
            yield shard()

    ranged = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ranged.mapInArrow(tasks, SHARDS), "token-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document as the shards have it, its place among all ids, its length and a checksum of its ids."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = Shard(data)
                # In sequence all ends are decoded at once; select serves single documents.
                ends = shard.ends.all().tolist()
                starts = [0, *ends[:-1]]
                body = memoryview(shard.ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(body[4 * first : 4 * last]) for first, last in zip(starts, ends)]
                sizes = [last - first for first, last in zip(starts, ends)]
                columns = (shard.doc_ids, [part] * shard.n, [seq] * shard.n, starts, sizes, crcs)
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "part", "seq", "local", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names)

    heads = shards.select("part", "seq", "n_ids")
    # Two prefix sums: over parts (one row each), and over the shards of a part.
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    starts = heads.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("seq_start"))
    starts = starts.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base"))
    rows = shards.select("part", "seq", "shard").mapInArrow(tasks, ROWS)
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Write the shards of all documents and read them back."""
    return read_documents(write_shards(docs, tokenizer, end_id))
