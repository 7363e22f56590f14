import itertools
import random
import time
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dailybars.llm import elias_fano
from dailybars.llm.packing import best_fit, best_fit_packing, local_search, pack
from dailybars.llm.token_counts import counter, token_counts
from dailybars.llm.token_files import Shard, pack as pack_shard, token_files, write_shards
from dailybars.llm.tokenizing import encoder


def direct(name, text, end=None):
    ids = Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids
    return array("I", ids + ([] if end is None else [end]))


def batch(name, texts):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \n\t'<|>.aé12 ᠎\x1cİ²s ")), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_same_ids_as_the_library(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        made = encoder(name)
        assert made.encode(text) == array("I", made.library.encode(text, add_special_tokens=False).ids).tobytes()
    made = counter("byte_bpe_50k.json")
    assert made.count(text) == len(made.library.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_single_tokens():
    made = counter("byte_bpe_50k.json")
    assert len(made.whole) > 40_000
    for word in sorted(made.whole)[::1000]:
        assert len(made.library.encode(word).ids) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 10**6))
def test_elias_fano(values, more):
    values = sorted(values)
    universe = (values[-1] if values else 0) + more
    made = elias_fano.EliasFano(elias_fano.encode(np.array(values, dtype=np.int64), universe))
    assert made.all().tolist() == values
    assert [made.select(i) for i in range(len(values))] == values


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(elias_fano.encode(ends, int(ends[-1]))) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 1.5


@pytest.mark.parametrize("width", [2, 4])
def test_shard_round_trip(width):
    doc_ids = [None, None, -(2**63), 5, 5, 2**63 - 1]
    ids = [array("I", range(i)).tobytes() for i in (3, 0, 1, 70, 0, 200)]
    shard = Shard(pack_shard(doc_ids, ids, width))
    assert shard.doc_ids == doc_ids
    assert [shard.document(i).tobytes() for i in range(6)] == ids
    near = Shard(pack_shard([3, 4, 4, 900], ids[:4], width))
    assert near.doc_ids == [3, 4, 4, 900]


def expected_files(rows, ids, end=0):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    out, start = [], 0
    for i in order:
        own = array("I", [*ids[i], end])
        out.append((rows[i][0], start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_token_files(spark, small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs, no_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = expected_files(rows, batch("byte_bpe_50k.json", [t for _, t in rows]))
        assert in_order(token_files(docs).collect()) == in_order(want)


def test_many_small_shards(spark, small_docs):
    shards = write_shards(small_docs, "byte_bpe_50k.json", shard_ids=1000)
    assert shards.count() > 50


def test_token_counts(spark, small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs, no_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        ids = batch("byte_bpe_50k.json", [t for _, t in rows])
        want = [(d, len((t or "").encode()), len(x), len(x) > 512) for (d, t), x in zip(rows, ids)]
        assert in_order(token_counts(docs).collect()) == in_order(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80))
def test_packing_is_whole_and_no_worse_than_best_fit(sizes):
    first = best_fit(sizes, 60)
    bins = pack(sizes, 60)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 60 for b in bins)
    assert len(bins) <= len(first)


def test_local_search_empties_bins():
    # Three underfull bins; exchanges make room so that one vanishes.
    sizes = [6, 3, 5, 4, 2]
    bins = local_search(sizes, [[0, 1], [2], [3, 4]], 10)
    assert len(bins) == 2


def test_packing(spark, small_docs, odd_docs, no_docs):
    for docs, groups in ((small_docs, 32768), (small_docs, 50), (odd_docs, 32768), (no_docs, 32768)):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        ids = batch("word_bpe_49k.json", [t for _, t in rows])
        want = []
        for (d, _), x in zip(rows, ids):
            own = array("I", [*x, 0])
            for piece, at in enumerate(range(0, len(own), 2048)):
                part = own[at : at + 2048]
                want.append((d, piece, at, len(part), zlib.crc32(part.tobytes())))
        got = best_fit_packing(docs, group_pieces=groups).collect()
        assert in_order(tuple(r)[:5] for r in got) == in_order(want)
        used = defaultdict(list)
        for r in got:
            used[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        if groups == 32768 and rows:
            assert len(used) <= -(-sum(w[3] for w in want) // 2048) + 1 + len(rows) // 50


def steps_left(sizes, bins, capacity):
    """Moves, one for one, one for two and two for one that would raise the sum of squared fills."""
    fill = [sum(sizes[i] for i in content) for content in bins]
    for a, donor in enumerate(bins):
        for b, other in enumerate(bins):
            if a == b or not fill[a] <= fill[b] < capacity:
                continue
            singles, pairs = [[i] for i in donor], [list(p) for p in itertools.combinations(donor, 2)]
            back = [[], *([j] for j in other)]
            both = [list(p) for p in itertools.combinations(other, 2)]
            for give, take in [*itertools.product(singles, back + both), *itertools.product(pairs, back)]:
                gained = sum(sizes[i] for i in give) - sum(sizes[j] for j in take)
                if 0 < gained <= capacity - fill[b]:
                    return True
    return False


def test_the_search_ends_without_a_step_left():
    rnd = random.Random(6)
    for _ in range(60):
        capacity = rnd.choice([30, 60, 100])
        sizes = [rnd.randint(capacity // 5, capacity * 3 // 5) for _ in range(rnd.randint(5, 60))]
        start = best_fit(sizes, capacity)
        bins = local_search(sizes, start, capacity)
        assert sorted(i for content in bins for i in content) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in content) <= capacity for content in bins) and len(bins) <= len(start)
        assert len(bins) == -(-sum(sizes) // capacity) or not steps_left(sizes, bins, capacity)


def test_many_half_full_bins_in_bounded_time():
    rnd = random.Random(1)
    sizes = [rnd.randint(400, 1100) for _ in range(6000)]
    started, start = time.time(), best_fit(sizes, 2048)
    assert len(local_search(sizes, start, 2048)) < len(start) - 20 and time.time() - started < 60
