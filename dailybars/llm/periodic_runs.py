"""Operator 11: runs of periodic words, by a suffix automaton with link-cut access.

A text is its words. A run (start, length, period) is a stretch of consecutive words whose smallest period is `period`,
at least twice as long as that and at least `min_length` words long, and which no neighbouring word extends with that
period. Collapsing drops each word that some run contains after that run's first `period` words.

* Words are appended one by one to a suffix automaton. Its suffix links form a tree that a link-cut structure keeps as
  paths; all nodes of a path last occurred at the same end. The new prefix is accessed: each piece of its way to the
  root, lengths (lo, hi] and last end e, is recoloured to the new end i. If the distance d = i - e lies within the
  piece's lengths, the last d words repeat the d before them and are no power, so d is the period of a run; hi words
  before e and before i agree, which gives the run's start, and comparing on to the right gives its end.
* Every run is found where its first two periods end: its last `period` words last occurred exactly one period before,
  since a root that is no power occurs in its square at both ends only. Access costs amortised O(log n), so a text of n
  words takes O(n log n), whatever its content.
* Words that can be in no run do not enter the automaton. A run of length L and period q has L - q >= min_length / 2,
  so each of its words lies in a window of that many words which occurs again in the same stretch of such words.
  Windows are compared by hash; a collision only lets more words in.

Nulls: a null text has no words, no runs and an empty collapsed text; a null doc_id is carried along. Blank texts are
like null ones. Repeated rows each get their row. An empty table gives no rows. Runs that share start or end are all
listed, by start, then period; equal ones cannot be. Very long texts: memory and time in a task follow the longest
text's words (about 60 bytes a word, some 600 for words within periodic stretches), nothing is cut off. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars.llm.common import texts_of
from dailybars.llm.text_stats import words_of

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Occurrences:
    """A suffix automaton of the words so far; `append` tells where the suffixes of the new prefix last ended.

    Lists are indexed by state. up, left, right: the splay trees of the paths, ordered by depth; the root of one has
    the path's last end in `seen` and the state above the path's top in `up`.
    """

    def __init__(self) -> None:
        self.length, self.link = [0], [-1]
        # A state's first transition; further ones are in a dictionary, which few states need.
        self.word, self.target, self.more = [-1], [-1], [None]
        self.up, self.left, self.right, self.seen = [-1], [-1], [-1], [-1]
        self.last = 0

    def _new(self, length: int) -> int:
        self.length.append(length)
        self.link.append(-1)
        self.word.append(-1)
        self.target.append(-1)
        self.more.append(None)
        self.up.append(-1)
        self.left.append(-1)
        self.right.append(-1)
        self.seen.append(-1)
        return len(self.length) - 1

    def _go(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.target[state]
        more = self.more[state]
        return -1 if more is None else more.get(word, -1)

    def _set(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.target[state] = word, to
        elif self.more[state] is None:
            self.more[state] = {word: to}
        else:
            self.more[state][word] = to

    def _extend(self, word: int) -> int:
        length, link = self.length, self.link
        new = self._new(length[self.last] + 1)
        at = self.last
        while at != -1 and self._go(at, word) == -1:
            self._set(at, word, new)
            at = link[at]
        if at == -1:
            link[new] = 0
        else:
            old = self._go(at, word)
            link[new] = old if length[old] == length[at] + 1 else self._clone(at, old, word)
        self.up[new] = link[new]
        self.last = new
        return new

    def _clone(self, at: int, old: int, word: int) -> int:
        """Split `old`: its shorter strings become a state of their own, just above it on its path."""
        copy = self._new(self.length[at] + 1)
        self.word[copy], self.target[copy] = self.word[old], self.target[old]
        self.more[copy] = dict(self.more[old]) if self.more[old] else None
        self.link[copy], self.link[old] = self.link[old], copy
        while at != -1 and self._go(at, word) == old:
            self._set(at, word, copy)
            at = self.link[at]
        self._splay(old)
        above = self.left[old]
        self.left[copy] = above
        if above != -1:
            self.up[above] = copy
        self.left[old], self.up[copy] = copy, old
        return copy

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if p == -1:
                return
            x_left = left[p] == x
            if not x_left and right[p] != x:
                return
            g = up[p]
            p_left = g != -1 and left[g] == p
            inner = p_left or (g != -1 and right[g] == p)
            if inner and p_left == x_left:
                self._rotate(p, g)
                self._rotate(x, p)
            else:
                self._rotate(x, p)

    def _rotate(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved != -1:
            up[moved] = p
        up[p], up[x] = x, g
        if g != -1 and left[g] == p:
            left[g] = x
        elif g != -1 and right[g] == p:
            right[g] = x
        else:
            self.seen[x] = self.seen[p]

    def append(self, word: int, end: int) -> list[tuple[int, int, int]]:
        """Pieces (lo, hi, e): the suffixes of more than lo and at most hi words last ended at e before `end`."""
        new = self._extend(word)
        up, right, seen, length = self.up, self.right, self.seen, self.length
        pieces: list[tuple[int, int, int]] = []
        below, x = new, up[new]
        while x != -1:
            self._splay(x)
            e, above = seen[x], up[x]
            cut = right[x]
            if cut != -1:
                seen[cut] = e
            right[x] = below
            lo = length[above] if above != -1 else 0
            if e >= 0 and x:
                if pieces and pieces[-1][2] == e:
                    pieces[-1] = (lo, pieces[-1][1], e)
                else:
                    pieces.append((lo, length[x], e))
            below, x = x, above
        self._splay(new)
        seen[new] = end
        return pieces


def runs_of(words: list[int], min_length: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of numbered words."""
    states, known, runs, n = Occurrences(), {}, [], len(words)
    for i, word in enumerate(words):
        for lo, hi, e in states.append(word, i):
            d = i - e
            if lo < d <= hi and known.get(d, -1) < i:
                j = i + 1
                while j < n and words[j] == words[j - d]:
                    j += 1
                known[d] = j - 1
                start = e - hi + 1
                if j - start >= min_length:
                    runs.append((start, j - start, d))
    return runs


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    joined = hashes[:n].copy()
    for j in range(1, width):
        joined *= np.uint64(0x9E3779B97F4A7C15)
        joined ^= joined >> np.uint64(31)
        joined += hashes[j : n + j]
    return joined


def stretches(hashes: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches that every run lies in one of."""
    width, n = max(1, (min_length + 1) // 2), len(hashes)
    if n < max(2, min_length):
        return []
    windows = _windows(hashes, width)
    at = np.arange(len(windows))
    piece = np.zeros(len(windows), np.int64)
    while True:
        # Windows that occur again in their piece, and the words that they cover.
        order = np.lexsort((windows, piece)) if piece[-1] else np.argsort(windows, kind="stable")
        w, p = windows[order], piece[order]
        same = (w[1:] == w[:-1]) & (p[1:] == p[:-1])
        again = np.zeros(len(w), bool)
        again[1:] = same
        again[:-1] |= same
        if not again.any():
            return []
        kept = np.sort(order[again])
        starts = at[kept]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (starts[1:] > starts[:-1] + width) | (piece[kept][1:] != piece[kept][:-1])
        first = np.flatnonzero(fresh)
        begins, ends = starts[first], starts[np.append(first[1:], len(starts)) - 1] + width
        long = ends - begins >= max(2, min_length)
        inside = long[np.cumsum(fresh) - 1]
        if len(kept) == len(windows) and inside.all():
            return list(zip(begins.tolist(), ends.tolist()))
        if not inside.any():
            return []
        number = np.cumsum(fresh) - 1
        windows, at, piece = windows[kept][inside], starts[inside], number[inside]
        piece = np.unique(piece, return_inverse=True)[1]


def text_runs(words: list[bytes], min_length: int) -> list[tuple[int, int, int]]:
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = []
    for start, end in stretches(hashes, min_length):
        ids: dict[bytes, int] = {}
        numbers = [ids.setdefault(w, len(ids)) for w in words[start:end]]
        runs += [(start + a, length, period) for a, length, period in runs_of(numbers, min_length)]
    runs.sort(key=lambda run: (run[0], run[2]))
    return runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change)[:-1] > 0
    return b" ".join(w for w, drop in zip(words, dropped.tolist()) if not drop)


def periodic_runs(docs: DataFrame, min_length: int = 12) -> DataFrame:
    """doc_id, runs (by start, then period) and the collapsed text: one row for each row of docs."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for text in batch.column("text").cast(pa.binary()):
                # Bytes split at the six ASCII white spaces only.
                words = text.as_py().split()
                runs = text_runs(words, min_length)
                found.append([{"start": s, "length": k, "period": q} for s, k, q in runs])
                kept.append(collapsed(words, runs))
            made = [pa.array(found, pa.list_(RUN)), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "runs", "collapsed"])

    return texts_of(docs).mapInArrow(tasks, RUNS)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document, by a checksum of its id, repeats words from some place on.

    With h = crc32 of the id's digits and g = h / 10: if h % 10 = 0, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) / (3 + g % 8), divisions being whole.
    """
    h = F.crc32(docs["doc_id"].cast("long").cast("string"))
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), h.alias("h")
    )
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.when(chosen, words_of(F.col("text")))

    def planted(words: Column, h: Column) -> Column:
        g, n = F.floor(h / 10), F.size(words)
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        return F.array_join(
            F.transform(words, lambda word, i: F.when(i < a, word).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " "
        )

    # Bound by a lambda, so that the text is split once.
    inner = F.get(F.transform(F.array(F.struct(words.alias("w"), "h")), lambda s: planted(s["w"], s["h"])), F.lit(0))
    return texts.select("doc_id", F.when(chosen, inner).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """From periodic_runs: the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("k"), (-r["start"]).alias("s"), (-r["period"]).alias("q")),
        )
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.k").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.k div -best.q").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: crc32 in bits, since DuckDB has none; then pairs of equal 6-word windows in stretches of one distance.
ORACLE = r"""
WITH c AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, CAST(doc_id AS VARCHAR) AS t
  FROM documents),
h AS (
  SELECT rid, doc_id, ws, len(ws) AS n,
         xor(list_reduce(list_transform(range(1, length(t) + 1), lambda i: CAST(ascii(t[i]) AS BIGINT)), lambda r, b:
           list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), xor(r, b)), 4294967295),
         4294967295) AS h
  FROM c),
a AS (SELECT *, h // 10 % greatest(n, 1) AS a, coalesce(h % 10 = 0 AND n > 0, false) AS planted FROM h),
p AS (SELECT rid, n, a, planted, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM a),
w0 AS (SELECT rid, unnest(range(n)) AS i, unnest(ws) AS w FROM a),
w AS (
  SELECT t.rid, t.i, s.w FROM
    (SELECT rid, CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END AS src, i
     FROM (SELECT *, unnest(range(n)) AS i FROM p)) t
  JOIN w0 s ON s.rid = t.rid AND s.i = t.src),
g AS (
  SELECT rid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' ||
         lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o AS g
  FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
e AS (SELECT rid, i, hash(g) AS g FROM g WHERE g IS NOT NULL),
q AS (SELECT x.rid, x.i, y.i - x.i AS q FROM e x JOIN e y ON x.rid = y.rid AND x.g = y.g AND x.i < y.i),
k AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM q),
s AS (
  SELECT rid, q, min(i) AS s, max(i) - min(i) + 6 + q AS l FROM k GROUP BY rid, q, k
  HAVING max(i) - min(i) + 6 >= q AND max(i) - min(i) + 6 + q >= 12),
r AS (
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM s z WHERE z.rid = s.rid AND z.q < s.q AND s.q % z.q = 0 AND z.s <= s.s AND z.s + z.l >= s.s + s.l)),
d AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM r),
m AS (
  SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept FROM w WHERE NOT EXISTS (
    SELECT 1 FROM d WHERE d.rid = w.rid AND d.i = w.i) GROUP BY rid),
u AS (
  SELECT rid, count(*) AS c, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
         min_by({'s': s, 'l': l, 'q': q}, (-l, s, q)) AS b
  FROM r GROUP BY rid)
SELECT doc_id, coalesce(c, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
       1000 * b.l // b.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(CASE WHEN u.rid IS NULL AND NOT planted THEN array_to_string(ws, ' ') ELSE coalesce(kept, '') END)
         AS collapsed_sha256
FROM a LEFT JOIN u USING (rid) LEFT JOIN m USING (rid)
"""
