import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dailybars.llm.lyndon_sort import sort_suffixes
from dailybars.llm.substring_dedup import substring_dedup


def brute(rows, length=100):
    """rows: (doc_id, text). Every window of every document, in order."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    order = sorted(range(len(texts)), key=lambda i: (texts[i][0] is not None, texts[i][0] or 0))
    seen, out = {}, []
    for i in order:
        doc, data = texts[i]
        covered = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if seen.setdefault(window, (doc, data, at)) != (doc, data, at):
                covered[at : at + length] = b"\1" * length
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for k in range(len(data)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((doc, len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def check(docs, **options):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = in_order(substring_dedup(docs, **options).collect())
    assert got == in_order(brute(rows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text("abc", max_size=25), min_size=1, max_size=5), min_size=1, max_size=4))
def test_suffix_order(strings):
    symbols, string = [], []
    for number, contexts in enumerate(strings):
        own = [0]
        for context in contexts:
            own += [ord(c) - 96 for c in context] + [0]
        symbols += own
        string += [number] * len(own)
    order, rank = sort_suffixes(np.array(symbols), np.array(string))

    def suffix(i):
        return tuple(symbols[i : symbols.index(0, i)])

    for number in range(len(strings)):
        own = [i for i in order if string[i] == number and symbols[i]]
        assert [suffix(i) for i in own] == sorted(suffix(i) for i in own)
        assert all((rank[a] == rank[b]) == (suffix(a) == suffix(b)) for a, b in zip(own, own[1:]))


def test_small_table(small_docs):
    check(small_docs)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert substring_dedup(no_docs).collect() == []


@pytest.mark.parametrize("limit", [20_000, 3])
def test_edges_runs_and_shared_passages(make_docs, limit):
    """Repeats of just under, exactly and over 100 bytes, at the ends of texts, overlapping, and of one byte."""
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    p99, p100, p130, p400 = "".join(chr(33 + i % 90) for i in range(99)), noise(70), noise(130), noise(400)
    texts = ["x" * 500, "x" * 150, "ab" * 300, noise(99), p99 + noise(50), noise(50) + p99, p130, p130 + p130, ""]
    texts += [noise(rng.randint(0, 150)) + p400 + noise(rng.randint(0, 150)) for _ in range(12)]
    texts += [noise(rng.randint(0, 30)) + p100 * 2 + noise(rng.randint(0, 30)) for _ in range(6)]
    texts += [p400[k : k + rng.randint(100, 180)] + noise(60) for k in range(0, 220, 9)]
    texts += [noise(40) + p400[k : k + 104] + "zz" + p400[k + 90 : k + 300] for k in range(0, 100, 7)]
    rng.shuffle(texts)
    check(make_docs(texts), group_limit=limit)
