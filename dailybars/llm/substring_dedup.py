"""Operator 1: remove repeated byte strings, by suffix sorting around content-chosen anchors.

Every byte covered by a string of `length` bytes that also starts earlier (in a document with a smaller doc_id, or
earlier in the same one) is removed.

1. Every window of `length` bytes gets one anchor: the position in it whose next 24 bytes hash lowest. Equal windows
   have equal anchors at the same place, so windows only meet within the group of one anchor hash. An anchor stands
   for a run of windows, its context.
2. Contexts that are equal as a whole are settled by their hash: all but the first are removed.
3. The first of each kind are fetched for the anchors that have several. In a group, a context is cut to the bytes that
   some other one shares next to the anchor; equal ones are settled again; the others go through the suffix sort
   (lyndon_sort), where windows that are equal stand together.

Copies within a scan batch are settled before the shuffle, so a passage in a third of all documents sends one row for
each batch. An anchor with more than `group_limit` different contexts is not gathered: its windows are hashed one
by one (128 bits) and compared in an aggregate, which has no limit. The texts are shuffled once.

Nulls: a null text is empty; a null doc_id comes before all others. Rows with the same doc_id count in the order of a
hash of their texts; rows equal in both are one document, and each gets its row. An empty table gives no rows. Very
long texts are read whole; of equal strings the first by document, then place, stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailybars.llm.common import stored, texts_of
from dailybars.llm.lyndon_sort import sort_suffixes

SEED = 24
NO_ID = -(2**63)
BASE = 0x9E3779B97F4A7C15
BATCH_SYMBOLS = 1_000_000
BATCH_BYTES = 12 << 20  # of text, or of contexts, that a task works on at once


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """64-bit hashes of byte ranges, from prefix sums of a polynomial."""

    def __init__(self):
        self.table = np.random.default_rng(1).integers(0, 2**64, 256, np.uint64)
        self.up = self.down = np.empty(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                powers = np.full(max(n, 1 << 16), base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return _mix((sums[last] - sums[first]) * self.down[first])


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least value of each window; of the last one among equals."""
    at = np.arange(len(values), dtype=np.int32)
    span, n = 1, len(values) - width + 1
    while 2 * span <= width:
        right, left = at[span:], at[: len(at) - span]
        at = np.where(values[right] <= values[left], right, left)
        span *= 2
    left, right = at[:n], at[width - span : width - span + n]
    return np.where(values[right] <= values[left], right, left)


def anchors(data: np.ndarray, length: int, hasher: Hasher):
    """(hash, context hash, anchor, first window, last window) of every anchor of a text."""
    sums = hasher.prefix(data)
    n = len(data) - SEED + 1
    seeds = _mix((sums[SEED:] - sums[:-SEED]) * hasher.down[:n])
    owner = _window_least(seeds, length - SEED + 1)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(owner)] - 1
    at = owner[first].astype(np.int64)
    whole = hasher.ranges(sums, first, last + length)
    shape = ((at - first) * 1024 + (last - first)).astype(np.uint64)
    return seeds[at], _mix(whole ^ _mix(shape + np.uint64(1))), at, first, last


ANCHORS = "h long, ctx long, doc long, sub long, at long, lo int, hi int, covered boolean"
CONTEXTS = "h long, doc long, sub long, at long, lo int, hi int, bytes binary"
COVERS = "doc long, sub long, first long, last long"


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")))
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], list(names))


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    unzip = zstandard.ZstdDecompressor()
    for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
        yield *row[:-1], unzip.decompress(row[-1])


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc, sub, data): the texts as compressed bytes, dealt by document; the only shuffle of texts."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # With its size in the frame, each text is unpacked in one go.
            packer = zstandard.ZstdCompressor(level=1, write_content_size=True)
            made = [packer.compress(text.encode()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())], ["doc_id", "doc", "sub", "data"])

    texts = texts_of(docs)
    again = docs.select(docs["doc_id"].cast("long").alias("id")).groupBy("id").count().where("count > 1")
    sub = F.xxhash64("text") if again.limit(1).count() else F.lit(0).cast("long")
    named = texts.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), sub.alias("sub"), "text")
    rows = named.mapInArrow(tasks, "doc_id long, doc long, sub long, data binary")
    return stored(rows, "texts", "none")


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def settled(parts: list[tuple]) -> pa.RecordBatch:
            h, ctx, doc, sub, at, lo, hi = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((at, sub, doc, ctx, h))
            h, ctx, doc, sub, at, lo, hi = (x[order] for x in (h, ctx, doc, sub, at, lo, hi))
            later = np.r_[False, (h[1:] == h[:-1]) & (ctx[1:] == ctx[:-1])]
            same = np.r_[False, (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (at[1:] == at[:-1])]
            first = np.maximum.accumulate(np.where(later, 0, np.arange(len(h))))
            covered = later & ~((doc == doc[first]) & (sub == sub[first]) & (at == at[first]))
            keep = ~(same & later) | covered
            # A settled row needs no group any more; it goes anywhere.
            spread = _mix((at + doc).astype(np.uint64)).view(np.int64)
            made = (np.where(covered, spread, h), ctx, doc, sub, at, lo, hi, covered)
            return _batch([x[keep] for x in made], ANCHORS)

        parts, size = [], 0
        for batch in batches:
            for doc, sub, data in _unpacked(batch):
                if len(data) < length:
                    continue
                h, ctx, at, lo, hi = anchors(np.frombuffer(data, np.uint8), length, hasher)
                n = len(h)
                parts.append((h.view(np.int64), ctx.view(np.int64), np.full(n, doc), np.full(n, sub), at, at - lo, hi - lo))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield settled(parts)
                    parts, size = [], 0
        if parts:
            yield settled(parts)

    return texts.select("doc", "sub", "data").mapInArrow(tasks, ANCHORS)


def judged(rows: DataFrame) -> DataFrame:
    """Anchors that are copies (covered), or the first of their kind where there are several kinds (kinds > 1)."""
    ordered = Window.partitionBy("h").orderBy("ctx", "doc", "sub", "at")
    group = Window.partitionBy("h")
    kind = Window.partitionBy("h", "ctx").orderBy("doc", "sub", "at")
    rows = rows.withColumns(
        {
            "before": F.lag(F.struct("ctx", "covered")).over(ordered),
            "leader": F.first(F.struct("doc", "sub", "at")).over(kind),
        }
    )
    lead = F.col("before").isNull() | (F.col("before.ctx") != F.col("ctx"))
    rows = rows.withColumn("lead", lead & ~F.col("covered"))
    rows = rows.withColumn("kinds", F.sum(F.col("lead").cast("int")).over(group))
    copy = F.col("covered") | (~F.col("lead") & (F.struct("doc", "sub", "at") != F.col("leader")))
    rows = rows.withColumn("covered", copy).where("covered OR (lead AND kinds > 1)")
    return rows.select("h", "doc", "sub", "at", "lo", "hi", "covered", "kinds")


def fetched(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, sub, found, data in _unpacked(batch):
                for x in found:
                    first = x["at"] - x["lo"]
                    rows.append((x["h"], doc, sub, x["at"], x["lo"], x["hi"], data[first : first + x["hi"] + length]))
            if rows:
                yield _batch(list(zip(*rows)), CONTEXTS)

    per_doc = wanted.groupBy("doc", "sub").agg(F.collect_set(F.struct("h", "at", "lo", "hi")).alias("found"))
    # Rows equal in id and text are one document here.
    joined = texts.join(per_doc, ["doc", "sub"]).select("doc", "sub", "found", "data")
    return joined.mapInArrow(tasks, CONTEXTS)


def _padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)
    return data, sizes


def _shared(data: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row the longest common prefix with any other row of its group; -1 without another."""
    words = data.view(">u8").astype(np.uint64)
    order = np.lexsort((sizes, *words.T[::-1], group))
    rows, size, of = data[order], sizes[order], group[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), data.shape[1])
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    common[of[1:] != of[:-1]] = -1
    best = np.full(len(order), -1)
    best[1:] = common
    best[:-1] = np.maximum(best[:-1], common)
    out = np.empty(len(order), np.int64)
    out[order] = best
    return out


def _covers(doc, sub, first, length) -> tuple:
    """Runs of windows (one start each, sorted by document and start) as byte ranges."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (first[1:] > first[:-1] + length)]
    at = np.flatnonzero(new)
    end = np.r_[at[1:], len(doc)] - 1
    return doc[at], sub[at], first[at], first[end] + length


def repeated(contexts: pa.Table, length: int) -> list[tuple]:
    """Covered byte ranges among contexts of several anchors (sorted by anchor hash)."""
    h, doc, sub, at, lo, hi = (contexts.column(c).to_numpy().astype(np.int64) for c in ("h", "doc", "sub", "at", "lo", "hi"))
    data = contexts.column("bytes").to_pylist()
    rest = length - SEED
    width = -(-rest // 8) * 8
    group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
    left, n_left = _padded([d[:k][::-1] for d, k in zip(data, lo)], width)
    right, n_right = _padded([d[k + SEED :] for d, k in zip(data, lo)], width)
    n_left, n_right = np.minimum(n_left, _shared(left, n_left, group)), np.minimum(n_right, _shared(right, n_right, group))
    use = np.flatnonzero((n_left >= 0) & (n_left + n_right >= rest))
    if not len(use):
        return []
    # Cut contexts that are equal: all but the first are covered.
    use = use[np.lexsort((at[use], sub[use], doc[use]))]
    keys: dict[tuple, int] = {}
    keep, copies = [], []
    for i in use:
        key = (group[i], data[i][lo[i] - n_left[i] : lo[i] + SEED + n_right[i]], n_left[i])
        if key in keys:
            copies.append(i)
        else:
            keys[key] = i
            keep.append(i)
    found = []
    if copies:
        c = np.array(copies)
        found.append((doc[c], sub[c], at[c] - n_left[c], at[c] + SEED + n_right[c]))
    keep = np.array(keep)
    keep = keep[np.argsort(group[keep], kind="stable")]
    many = np.bincount(group[keep], minlength=group[-1] + 1)[group[keep]] > 1
    keep = keep[many]
    total = np.cumsum(n_left[keep] + n_right[keep] + 2)
    cut = 0
    while cut < len(keep):  # whole groups, up to so many symbols at once
        stop = int(np.searchsorted(total, (total[cut - 1] if cut else 0) + BATCH_SYMBOLS, side="right"))
        stop = max(stop, cut + 1)
        while stop < len(keep) and group[keep[stop]] == group[keep[stop - 1]]:
            stop += 1
        found += _sorted_windows(keep[cut:stop], data, group, doc, sub, at, lo, n_left, n_right, length)
        cut = stop
    return found


def _sorted_windows(rows, data, group, doc, sub, at, lo, n_left, n_right, length) -> list[tuple]:
    """Windows that are equal to an earlier one, from the suffix order of the groups' contexts."""
    span = length - SEED + 1  # a window with its anchor as one symbol
    parts, string = [], []
    for i in rows:
        middle = lo[i]
        parts.append(np.frombuffer(data[i][middle - n_left[i] : middle], np.uint8))
        parts.append(np.frombuffer(data[i][middle + SEED : middle + SEED + n_right[i]], np.uint8))
    new = np.r_[True, group[rows][1:] != group[rows][:-1]]
    left, right = n_left[rows], n_right[rows]
    # A separator before each string, then left, anchor, right, separator for each context.
    sizes = left + right + 2 + new
    ends = np.cumsum(sizes)
    symbols = np.zeros(ends[-1], np.int64)
    string = np.repeat(np.cumsum(new) - 1, sizes)
    begin = ends - sizes + new
    anchor = begin + left
    mask = np.ones(ends[-1], bool)
    mask[anchor] = False
    mask[ends - 1] = False
    mask[(ends - sizes)[new]] = False
    symbols[mask] = np.concatenate(parts).astype(np.int64) + 1
    symbols[anchor] = 257
    order, _ = sort_suffixes(symbols, string)
    # Only suffixes that begin a whole window: from `left` before the anchor on, with enough symbols behind.
    context = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(ends[-1])
    starts = (place >= begin[context]) & (place <= anchor[context]) & (place + span <= (ends - 1)[context])
    order = order[starts[order]]
    if not len(order):
        return []
    windows = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.int16), span)
    equal = np.empty(len(order), bool)
    equal[0] = False
    for a in range(1, len(order), 50_000):
        b = min(len(order), a + 50_000)
        equal[a:b] = (windows[order[a:b]] == windows[order[a - 1 : b - 1]]).all(axis=1)
    equal[1:] &= string[order[1:]] == string[order[:-1]]
    block = np.cumsum(~equal) - 1
    row = rows[context[order]]
    first = at[row] + (order - anchor[context[order]])
    sort = np.lexsort((first, sub[row], doc[row], block))
    block, row, first = block[sort], row[sort], first[sort]
    head = np.maximum.accumulate(np.where(np.r_[True, block[1:] != block[:-1]], np.arange(len(block)), 0))
    later = (doc[row] != doc[row[head]]) | (sub[row] != sub[row[head]]) | (first != first[head])
    row, first = row[later], first[later]
    if not len(row):
        return []
    sort = np.lexsort((first, sub[row], doc[row]))
    return [_covers(doc[row][sort], sub[row][sort], first[sort], length)]


def suffix_covers(contexts: DataFrame, length: int) -> DataFrame:
    """Groups of an anchor hash meet in a task, in sorted batches; a group is bounded by the limit on kinds."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def made(table: pa.Table):
            for found in repeated(table, length):
                yield _batch(list(found), COVERS)

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            whole = int(np.searchsorted(h, h[-1]))  # the last group may go on
            if whole:
                yield from made(table.slice(0, whole))
                table = table.slice(whole)
            held, size = table.to_batches(), table.nbytes
        if held:
            yield from made(pa.Table.from_batches(held).combine_chunks())

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(tasks, COVERS)


def hashed_covers(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: every window by its hash, in an aggregate of any size."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, doc, sub, at, lo, hi, data in zip(*(c.to_pylist() for c in batch.columns)):
                n = hi + 1
                keys = [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n)]
                first = [at - lo + i for i in range(n)]
                yield _batch([keys, [doc] * n, [sub] * n, first], "w binary, doc long, sub long, first long")

    windows = contexts.mapInArrow(tasks, "w binary, doc long, sub long, first long")
    leaders = windows.groupBy("w").agg(F.min(F.struct("doc", "sub", "first")).alias("leader"), F.count("*").alias("c"))
    later = windows.join(leaders.where("c > 1"), "w").where(F.struct("doc", "sub", "first") != F.col("leader"))
    return later.select("doc", "sub", "first", (F.col("first") + length).alias("last"))


def substring_dedup(docs: DataFrame, length: int = 100, group_limit: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each document."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for _, spans, data in _unpacked(batch.select(["doc_id", "spans", "data"])):
                removed = n_spans = at = 0
                digest = hashlib.sha256()
                for first, last in _merged(spans or (), len(data)):
                    digest.update(data[at:first])
                    at, removed, n_spans = last, removed + last - first, n_spans + 1
                digest.update(data[at:])
                for column, x in zip(columns, (len(data), removed, n_spans, digest.hexdigest())):
                    column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *made], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    texts, covers = covered_ranges(docs, length, group_limit)
    spans = covers.groupBy("doc", "sub").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = texts.join(spans, ["doc", "sub"], "left").select("doc_id", "spans", "data")
    return joined.mapInArrow(kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _merged(spans, size: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    first = last = None
    for a, b in sorted((x["first"], min(x["last"], size)) for x in spans):
        if last is None or a > last:
            if last is not None:
                yield first, last
            first, last = a, b
        else:
            last = max(last, b)
    if last is not None:
        yield first, last


def covered_ranges(docs: DataFrame, length: int, group_limit: int) -> tuple[DataFrame, DataFrame]:
    """The packed texts, and (doc, sub, first, last): ranges whose windows of `length` bytes all start earlier too."""
    texts = packed_texts(docs)
    found = stored(judged(anchor_rows(texts, length)), "anchors")
    end = F.col("at") - F.col("lo") + F.col("hi") + length
    covers = found.where("covered").select("doc", "sub", (F.col("at") - F.col("lo")).alias("first"), end.alias("last"))
    contexts = stored(fetched(texts, found.where("NOT covered"), length), "contexts")
    hot = found.where(F.col("kinds") > group_limit).where("NOT covered").select("h").distinct()
    parts = [covers, suffix_covers(contexts.join(hot, "h", "left_anti"), length)]
    if hot.limit(1).count():
        parts.append(hashed_covers(contexts.join(hot, "h", "left_semi"), length))
    covers = parts[0]
    for part in parts[1:]:
        covers = covers.unionByName(part)
    return texts, stored(covers, "covers")
