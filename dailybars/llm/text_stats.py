"""Measurements of a text as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
POSITION_BITS = 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def worded_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))


def occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _same(words: Column, p: Column, q: Column) -> Column:
    return (
        (F.get(words, p) == F.get(words, q))
        & (F.get(words, p + 1) == F.get(words, q + 1))
        & (F.get(words, p + 2) == F.get(words, q + 2))
    )


def _covered(positions: Column) -> Column:
    """How many words the 3-word windows at these ascending positions cover."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        positions,
        start,
        lambda seen, p: F.struct(
            p.alias("last"), (seen["n"] + F.least(F.lit(3), p - seen["last"])).cast("long").alias("n")
        ),
        lambda seen: seen["n"],
    )


def with_repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add the number of words in 3-word windows that are found twice or more, the first included.

    The windows are sorted by a hash and then compared as words with their neighbours: n log n for any text, where
    looking windows up in a list would be quadratic. Hash and position share a long, which sorts fastest; texts of
    a million words and more take a struct instead. Each array is a column of its own, so it is made once.
    """
    w, n = F.col(words), F.size(words)
    mask = F.lit((1 << POSITION_BITS) - 1).cast("long")
    small = n < (1 << POSITION_BITS)

    def window_hash(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get(w, i + 1), F.get(w, i + 2))

    def repeats(windows: Column, key, position) -> Column:
        def equal(a: Column, b: Column) -> Column:
            return F.coalesce((key(a) == key(b)) & _same(w, position(a), position(b)), F.lit(False))

        kept = F.filter(windows, lambda x, j: equal(x, F.get(windows, j - 1)) | equal(x, F.get(windows, j + 1)))
        return F.sort_array(F.transform(kept, position))

    packed = F.transform(
        w, lambda word, i: F.shiftleft(window_hash(word, i), POSITION_BITS).bitwiseOR(i.cast("long"))
    )
    whole = F.transform(w, lambda word, i: F.struct(window_hash(word, i).alias("h"), i.alias("i")))
    windows = df.withColumns(
        {
            "_packed": F.when((n > 2) & small, F.sort_array(F.slice(packed, 1, n - 2))),
            "_whole": F.when((n > 2) & ~small, F.sort_array(F.slice(whole, 1, n - 2))),
        }
    )
    short = repeats(
        F.col("_packed"),
        lambda x: F.shiftrightunsigned(x, POSITION_BITS),
        lambda x: x.bitwiseAND(mask).cast("int"),
    )
    long = repeats(F.col("_whole"), lambda x: x["h"], lambda x: x["i"])
    covered = _covered(F.when(F.col("_packed").isNotNull(), short).otherwise(long))
    return windows.withColumn(name, F.coalesce(covered, F.lit(0).cast("long"))).drop("_packed", "_whole")
