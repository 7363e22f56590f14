import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dailybars.llm import text_stats
from dailybars.llm.quality_rules import BASE, BIT, POLICIES, RULES, ablations, apply_policy, ledger, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, repeat = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def check(docs):
    got = quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(r["doc_id"], *measures(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert in_order(got.collect()) == in_order(want)


def test_tables(small_docs, odd_docs, no_docs):
    check(small_docs)
    check(odd_docs)
    check(no_docs)


def test_repeats(make_docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choices("ab", k=rng.randint(0, 12))) for _ in range(60)]
    texts += ["a b c x a b c", "a a a a", "a\x0bb\x0cc\r\na b c", "x y x y x y", "l\n\nl\nl \n \n"]
    check(make_docs(texts))


def test_struct_path_of_very_long_texts(make_docs, monkeypatch):
    monkeypatch.setattr(text_stats, "POSITION_BITS", 3)
    rng = random.Random(2)
    check(make_docs([" ".join(rng.choices("abc", k=k)) for k in (0, 2, 3, 7, 8, 9, 40)]))


def test_policies_and_ablations(small_docs):
    rows = ledger(small_docs).cache()
    bits = [r["failed_bits"] for r in rows.collect()]
    for version, mask in POLICIES.items():
        kept = apply_policy(rows, version).where("kept").count()
        assert kept == sum(not b & (mask | BASE) for b in bits)
        got = {r["rule"]: r for r in ablations(rows, version).collect()}
        for rule in RULES:
            if mask & BIT[rule]:
                without = sum(not b & (mask & ~BIT[rule]) for b in bits)
                assert got[rule]["n_only"] == without - kept
                assert got[rule]["n_failed"] == sum(bool(b & BIT[rule]) for b in bits)
    rows.unpersist()


@pytest.mark.parametrize("table", ["small_docs"])
def test_no_python_in_the_plan(table, request):
    plan = quality_rules(request.getfixturevalue(table))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
