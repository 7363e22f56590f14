import random
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest

from dailybars.llm import catalog
from dailybars.llm.periodic_runs import (
    Occurrences,
    collapsed,
    periodic_runs,
    run_digests,
    runs_of,
    stretches,
    text_runs,
    with_planted_period,
)


def brute(words, min_length=12):
    """Every period and every start; the smallest period by trying all."""
    n, runs = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_length, 2 * q):
                own = words[i : i + length]
                if not any(own[d:] == own[: length - d] for d in range(1, q)):
                    runs.append((i, length, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def periodic_words(rnd, longest=70):
    words = [bytes([97 + rnd.randrange(rnd.choice([1, 2, 2, 3, 6]))]) for _ in range(rnd.randint(0, longest))]
    if words and rnd.random() < 0.6:
        a, p = rnd.randrange(len(words)), 1 + rnd.randrange(len(words))
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
    return words


@pytest.mark.parametrize("min_length", [2, 3, 5, 12])
def test_runs_against_all_periods(min_length):
    rnd = random.Random(min_length)
    for _ in range(800):
        words = periodic_words(rnd)
        assert text_runs(words, min_length) == brute(words, min_length), words


def test_pieces_tell_where_each_suffix_last_ended():
    rnd = random.Random(5)
    for _ in range(200):
        words, states = [rnd.randrange(3) for _ in range(40)], Occurrences()
        for i, word in enumerate(words):
            last = {}
            for lo, hi, e in states.append(word, i):
                assert lo < hi
                for k in range(lo + 1, hi + 1):
                    last[k] = e
            for k in range(1, i + 2):
                suffix = words[i - k + 1 : i + 1]
                ends = [e for e in range(k - 1, i) if words[e - k + 1 : e + 1] == suffix]
                assert last.get(k) == (max(ends) if ends else None)


def test_every_run_lies_in_a_stretch():
    rnd = random.Random(9)
    for _ in range(500):
        words = periodic_words(rnd, 120)
        hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        found = stretches(hashes, 12)
        for start, length, _ in brute(words):
            assert any(a <= start and start + length <= b for a, b in found)


def test_long_inputs_take_near_linear_time():
    started = time.time()
    assert runs_of([1] * 100_000, 12) == [(0, 100_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    assert len(runs_of(b, 12)) > 1000
    assert text_runs([b"w%d" % i for i in range(300_000)], 12) == []
    assert time.time() - started < 60


def digest(doc_id, text, min_length=12):
    """The contract, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, min_length)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


def test_contract_on_odd_input(spark, odd_docs, make_docs):
    short = odd_docs.where("doc_id IS NULL OR doc_id <> 10")
    rows = [(r.doc_id, r.text) for r in short.collect()]
    # Ids whose checksum ends in 0 are planted with a period, of one word up to many.
    rows += [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(7, "a b a b a b a b a b a b"), (7, "a b a b a b a b a b a b"), (8, "a\x0bb c  a\rb c\n" * 9)]
    docs = make_docs([]).unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = run_digests(periodic_runs(with_planted_period(docs)))
    assert in_order(got.collect()) == in_order(digest(i, t) for i, t in rows)
    with_clash = run_digests(periodic_runs(with_planted_period(odd_docs)))
    assert with_clash.count() == odd_docs.count()


def test_empty_table(no_docs):
    assert run_digests(periodic_runs(with_planted_period(no_docs))).collect() == []


def test_operator_returns_runs_and_texts(make_docs):
    phrase = "the cat sat on the mat "
    rows = {r.doc_id: r for r in periodic_runs(make_docs(["so " + phrase * 3 + "end", "no runs here"])).collect()}
    assert [tuple(r) for r in rows[0].runs] == [(1, 18, 6)]
    assert rows[0].collapsed == "so the cat sat on the mat end"
    assert rows[1].runs == [] and rows[1].collapsed == "no runs here"
    assert collapsed([b"a"] * 4 + [b"b"], [(0, 4, 1)]) == b"a b"


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 800]
    got = {r.doc_id: tuple(r) for r in catalog.op11_periodic_runs(spark, folder).collect()}
    for i, text in rows:
        assert got[i] == digest(i, text)
