import random
import re

import numpy as np
import pytest

from dailybars.llm import near_dedup as nd
from dailybars.llm.components import components
from dailybars.llm.near_dedup import band_hashes, minhashes, near_duplicates, shingles, _permutations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_set(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=4, percent=80):
    """rows: (doc_id, text). Every pair of rows is compared."""
    sets = [word_set(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    for i, own in enumerate(sets):
        for j in {j for s in own for j in holders[s] if j < i}:
            both = len(own & sets[j])
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                label[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def check(docs, **options):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert in_order(near_duplicates(docs, **options).collect()) == in_order(brute(rows, **options))


def test_small_table(small_docs):
    check(small_docs)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"z{rng.random()}"
    return " ".join(words)


def test_chains_and_groups(make_docs):
    """Copies, near copies of a base, a chain whose ends differ, and a passage that many texts share."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(base)] * 5 + [edited(base, rng.randint(1, 6), rng) for _ in range(60)]
    chain = [f"c{i}" for i in range(120)]
    for step in range(12):
        texts.append(" ".join(chain))
        chain[step * 8] = f"new{step}"
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"o{k}_{i}" for i in range(30)) for k in range(80)]
    texts += ["a b", "A  b\n", "a b c", "", " "]
    rng.shuffle(texts)
    check(make_docs(texts))
    check(make_docs(texts), size=5)


def test_band_collisions_follow_similarity():
    """Sets of similarity 0.8 share a table."""
    rng = np.random.default_rng(5)
    keys, missed = _permutations(), 0
    for _ in range(300):
        a = rng.integers(0, 2**64, 900, np.uint64)
        b = np.concatenate([a[:800], rng.integers(0, 2**64, 100, np.uint64)])
        x, y = (band_hashes(minhashes(s, keys)) for s in (a, b))
        same = [p == q for p, q in zip(x, y)]
        missed += not (any(same[: len(same) // 2]) and any(same[len(same) // 2 :]))
    assert missed <= 1


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_a_path(spark, n):
    order = list(range(n + 1))
    random.Random(n).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(n + 1)}


def test_shingles_of_short_texts():
    assert len(shingles("a b c", 4)) == 1
    assert len(shingles("", 4)) == 0
    assert shingles("A b\x0bC d", 4).tolist() == shingles("a B c\td", 4).tolist()


def test_recall_of_links_at_the_threshold(make_docs):
    """Pairs of their own, of similarities from 0.74 to 0.9; all pairs are known."""
    rnd, texts, linked, apart = random.Random(8), [], 0, 0
    for i in range(700):
        words = [f"w{i}x{j}" for j in range(rnd.randint(60, 160))]
        other = list(words)
        # A replaced word changes four shingles, at the end of the text fewer.
        for _ in range(rnd.randint(1, 4)):
            other[rnd.randrange(len(other))] = f"n{i}x{rnd.random()}"
        texts += [" ".join(words), " ".join(other)]
        one, two = word_set(texts[-2], 4), word_set(texts[-1], 4)
        similar = 100 * len(one & two) >= 80 * len(one | two)
        linked, apart = linked + similar, apart + (not similar)
    rows = {r.doc_id: r.component_id for r in near_duplicates(make_docs(texts)).collect()}
    found = [rows[2 * i] == rows[2 * i + 1] for i in range(700)]
    truth = [
        100 * len(word_set(a, 4) & word_set(b, 4)) >= 80 * len(word_set(a, 4) | word_set(b, 4))
        for a, b in zip(texts[::2], texts[1::2])
    ]
    assert linked > 200 and apart > 50 and not any(f and not t for f, t in zip(found, truth))
    assert sum(f and t for f, t in zip(found, truth)) >= 0.99 * linked


def test_a_large_group_asks_few_questions(make_docs, monkeypatch):
    """Near copies of one text: about one question for each node, not one for each table."""
    asked, verify = [], nd.verified

    def counted(pairs, sets, percent):
        asked.append(pairs.count())
        return verify(pairs, sets, percent)

    monkeypatch.setattr(nd, "verified", counted)
    rnd, words = random.Random(3), [f"w{j}" for j in range(300)]
    texts = []
    for i in range(400):
        own = list(words)
        own[rnd.randrange(300)] = f"n{i}"
        texts.append(" ".join(own))
    rows = near_duplicates(make_docs(texts)).collect()
    assert {r.component_id for r in rows} == {0} and sum(asked) < 3 * len(texts)


def test_sketches_never_rule_out_a_link():
    rnd = np.random.default_rng(4)
    for n in (5, 40, 300, 3000):
        for _ in range(60):
            one = np.unique(rnd.integers(0, 2**64, n, np.uint64))
            keep = one[rnd.random(len(one)) > rnd.choice([0.02, 0.1, 0.3])]
            two = np.unique(np.concatenate([keep, rnd.integers(0, 2**64, rnd.integers(0, n // 4 + 1), np.uint64)]))
            differ = int(np.bitwise_count((nd.parities(one) ^ nd.parities(two)).view(np.uint64)).sum())
            assert differ <= len(np.setxor1d(one, two))
            both = len(np.intersect1d(one, two))
            if 100 * both >= 80 * (len(one) + len(two) - both):
                assert 180 * differ <= 20 * (len(one) + len(two))
