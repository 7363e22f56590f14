"""Operator 7: pack token pieces into as few sequences as possible, best fit and then local search.

Documents longer than a sequence are cut into full pieces and a rest; no other document is cut. Pieces are
dealt by a salted hash of their row to groups of about `group_pieces`, so no key can make a group large, and
each group is packed in one task: best fit by descending length, then a local search between underfull bins.
It moves a piece, exchanges one for one or two for one, whenever that raises the sum of squared fills, which
drains the emptiest bins until they vanish. A group wastes less than a bin or so in thousands.

Nulls: a null text is empty and packs as its end id alone; a null doc_id is packed like others. Repeated rows
are packed each. An empty table gives no rows. Very long texts are cut into full pieces whatever their length. Items of one
length are taken in the order of id, piece, checksum.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.llm import tokenizing
from dailybars.llm.common import stored, texts_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin with room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    mask = 0  # bit f is set if some bin has f free
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        above = mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            at = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
            bins[at].append(item)
        else:
            free, at = capacity, len(bins)
            bins.append([item])
        room[free - size].append(at)
        mask |= 1 << (free - size)
    return bins


class Underfull:
    """Bins with free space, by how much they have, and what each can give back: sizes as bits of whole numbers.

    Bit t of a bin's first mask says that it can give nothing (t = 0) or one item of size t, of the second that it can
    give two items of t together. A level's masks are those of its bins in one, so that one shift tells whether any bin
    of a level has what a donor needs.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes, self.bins, self.capacity = sizes, bins, capacity
        self.fill = [sum(sizes[i] for i in content) for content in bins]
        self.masks: dict[int, tuple[int, int]] = {}
        self.levels: dict[int, set[int]] = {}
        self.level_masks: dict[int, tuple[int, int]] = {}
        for b in range(len(bins)):
            self._put(b)

    def _put(self, b: int) -> None:
        if 0 < self.fill[b] < self.capacity:
            free = self.capacity - self.fill[b]
            self.levels.setdefault(free, set()).add(b)
            self.level_masks.pop(free, None)

    def _take(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        level = self.levels.get(free)
        if level and b in level:
            level.discard(b)
            self.level_masks.pop(free, None)
            if not level:
                del self.levels[free]

    def mask(self, b: int) -> tuple[int, int]:
        found = self.masks.get(b)
        if found is None:
            one, two = 0, 0
            for i in self.bins[b]:
                two |= one << self.sizes[i]
                one |= 1 << self.sizes[i]
            found = self.masks[b] = (one | 1, two)
        return found

    def level_mask(self, free: int) -> tuple[int, int]:
        found = self.level_masks.get(free)
        if found is None:
            one = two = 0
            for b in self.levels[free]:
                x, y = self.mask(b)
                one, two = one | x, two | y
            found = self.level_masks[free] = (one, two)
        return found

    def step(self, donor: int):
        """A fuller bin and what the donor gives and takes, so that the bin gains; None if there is none."""
        content = self.bins[donor]
        levels = sorted(free for free in self.levels if free <= self.capacity - self.fill[donor])
        for two in (False, True):
            gives: dict[int, list[int]] = {}
            for at, i in enumerate(content):
                for j in content[at + 1 :] if two else (None,):
                    given = [i] if j is None else [i, j]
                    gives.setdefault(sum(self.sizes[x] for x in given), given)
            for free in levels:
                one, pair = self.level_mask(free)
                known = one if two else one | pair
                for size, given in gives.items():
                    low = max(0, size - free)
                    window = (1 << (size - low)) - 1
                    if not known >> low & window:
                        continue
                    for b in sorted(self.levels[free]):
                        one_b, pair_b = self.mask(b)
                        hits = (one_b if two else one_b | pair_b) >> low & window
                        if b != donor and hits:
                            # The least that comes back: the bin gains most.
                            return b, given, self._items(b, low + (hits & -hits).bit_length() - 1)
        return None

    def _items(self, b: int, size: int) -> list[int]:
        """One item or two of this size together; none for 0."""
        if not size:
            return []
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            if self.sizes[i] == size:
                return [i]
        for i in self.bins[b]:
            if size - self.sizes[i] in seen:
                return [seen[size - self.sizes[i]], i]
            seen[self.sizes[i]] = i
        raise AssertionError("a mask names a size that its bin does not have")

    def apply(self, donor: int, b: int, give: list[int], take: list[int]) -> None:
        self._take(donor)
        self._take(b)
        self.bins[donor] = [i for i in self.bins[donor] if i not in give] + take
        self.bins[b] = [i for i in self.bins[b] if i not in take] + give
        gained = sum(self.sizes[i] for i in give) - sum(self.sizes[i] for i in take)
        self.fill[donor] -= gained
        self.fill[b] += gained
        for x in (donor, b):
            self.masks.pop(x, None)
            self._put(x)


def local_search(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Drain the emptiest bins into other underfull ones; every step raises the sum of squared fills.

    A donor loses d and a fuller bin gains d, so the sum grows by 2d(fill of the gainer - fill of the donor + d),
    which is above zero; the search therefore ends. It stops at the least possible number of bins, or when no underfull
    bin has a step left.
    """
    state = Underfull(sizes, [list(content) for content in bins], capacity)
    count, least = sum(map(bool, bins)), -(-sum(state.fill) // capacity)
    changed = True
    while changed and count > least:
        changed = False
        for donor in sorted((b for level in state.levels.values() for b in level), key=lambda b: (state.fill[b], b)):
            while 0 < state.fill[donor] < capacity and (step := state.step(donor)):
                state.apply(donor, *step)
                changed = True
            count -= not state.bins[donor]
            if count <= least:
                break
    return [content for content in state.bins if content]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    return local_search(sizes, best_fit(sizes, capacity), capacity)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, cached_chunks: int = tokenizing.CHUNKS) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizing.encoder(tokenizer, cached_chunks).encode, struct.pack("<I", end_id)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, x in zip(columns, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names)

    return texts_of(docs).mapInArrow(tasks, PIECES)


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 2048,
    end_id: int = 0,
    group_pieces: int = 32_768,
    cached_chunks: int = tokenizing.CHUNKS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset. One shuffle, of piece lengths only.

    cached_chunks bounds what a Python worker remembers of seen chunks, where others share its memory.
    """

    def placed(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "length")])
        sizes = rows.column("length").to_pylist()
        at, offset = [0] * len(sizes), [0] * len(sizes)
        for number, content in enumerate(pack(sizes, capacity)):
            used = 0
            for item in content:
                at[item], offset[item] = number, used
                used += sizes[item]
        rows = rows.drop_columns(["grp"]).append_column("bin", pa.array([(key[0].as_py() << 32) + b for b in at], pa.int64()))
        return rows.append_column("offset", pa.array(offset, pa.int64()))

    made = pieces(docs, tokenizer, end_id, capacity, cached_chunks).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    made = stored(made, "pieces")
    groups = max(1, -(-made.count() // group_pieces))
    dealt = made.withColumn("grp", F.pmod("salt", F.lit(groups))).drop("salt")
    return dealt.groupBy("grp").applyInArrow(placed, PLACED).withColumnRenamed("bin", "sequence_id")
