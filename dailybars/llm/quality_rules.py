"""Operator 4: a ledger of quality rules as a bitmask, with versioned policies over it. Native functions only.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for each failed
rule. A policy is a mask over the bits, so a new policy, or the effect of taking a rule out of one, needs no text.

Nulls: a null text has no words and fails `few_words`; a null doc_id is kept as it is. Repeated rows each get a
row. An empty table gives no rows. Very long texts are measured whole, in n log n; a value at a bound passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars.llm import text_stats
from dailybars.llm.common import texts_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def _rules() -> dict[str, Column]:
    """Failure of each rule, in the order of its bit."""
    n, c = F.col("n_words"), F.col
    return {
        "few_words": n < 50,
        "repeated_words": 100 * c("n_repeat_words") > 50 * n,
        "symbols": 10 * c("n_symbols") > 2 * n,
        "duplicate_lines": 100 * c("n_dup_lines") > 30 * c("n_lines"),
        "word_length": (c("word_chars") < 2 * n) | (c("word_chars") > 15 * n),
        "upper_case": 10 * c("n_upper") > 4 * c("word_chars"),
    }


RULES = ("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "upper_case")
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Policies by version; a policy is never changed, only followed by another.
POLICIES = {1: BASE, 2: BASE | BIT["symbols"] | BIT["duplicate_lines"], 3: sum(BIT.values())}


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and failed_bits. No shuffle; the text is read once."""
    texts = texts_of(docs)
    words = texts.select(
        "doc_id",
        text_stats.words_of(F.col("text")).alias("words"),
        text_stats.worded_lines(F.col("text")).alias("lines"),
        text_stats.occurrences(F.col("text"), text_stats.SYMBOLS).alias("n_symbols"),
        text_stats.occurrences(F.col("text"), r"\p{Lu}").alias("n_upper"),
    )
    measured = text_stats.with_repeated_words(words, "words", "n_repeat_words").select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
    )
    rules = _rules()
    bits = [F.when(rules[name], F.lit(BIT[name])).otherwise(0) for name in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed_bits", failed.cast("long"))


def apply_policy(rows: DataFrame, version: int) -> DataFrame:
    """base_failed and kept under a policy, from the bits alone."""
    return rows.withColumns(
        {
            "base_failed": F.col("failed_bits").bitwiseAND(BASE) != 0,
            "kept": F.col("failed_bits").bitwiseAND(POLICIES[version] | BASE) == 0,
        }
    )


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that it alone rejects.

    One aggregate over the ledger counts the bit patterns (at most 2 to the number of rules); the rest works on them.
    """
    mask = POLICIES[version] | BASE
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))
    bits = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in RULES if BIT[r] & mask])
    each = patterns.select("bits", "n", F.explode(bits).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.coalesce(F.bit_or(F.when(hit, F.col("bits"))), F.lit(0)).alias("fails_with"),
    )


def quality_rules(docs: DataFrame, version: int = 3) -> DataFrame:
    return apply_policy(ledger(docs), version).select(
        "doc_id", *MEASURES[:5], "base_failed", "kept", "failed_bits"
    )


ORACLE = """
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
g AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
k AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM k WHERE c > 1) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) AS n_upper
  FROM w LEFT JOIN r USING (rid)),
f AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 10 * n_upper > 4 * word_chars THEN 32 ELSE 0 END) AS BIGINT) AS failed_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM f
"""
