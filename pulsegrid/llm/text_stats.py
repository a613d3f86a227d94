"""Statistics of a text as DataFrame expressions: words, symbols, repeated lines and windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import WORD

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_upper", "n_marks")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that lie in windows of ``WINDOW`` words found twice or more, the first included.

    Windows are hashed; only where a hash repeats are the windows themselves sorted and compared.
    """

    def covered(words: Column, hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("s"), i.alias("i"))))

        def same(windows: Column, x: Column, i: Column) -> Column:
            other = F.get(windows, i)
            return F.coalesce((other["h"] == x["h"]) & (other["s"] == x["s"]), F.lit(False))

        def positions(windows: Column) -> Column:
            return F.sort_array(F.transform(
                F.filter(windows, lambda x, i: same(windows, x, i - 1) | same(windows, x, i + 1)),
                lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(windows, positions), total)

    def of(words: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(
            *[F.get(words, i + k) for k in range(WINDOW)]))
        return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(covered(words, h))))

    return let(words, of)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``COUNTS``, as long; null text counts as empty. Columns of these names in
    ``docs`` are replaced.

    ``word_chars`` are code points in words, ``n_symbols`` characters of ``[#*$%&|<>]``,
    ``n_dup_lines`` lines with a word that equal an earlier line, ``n_lines`` lines with a word,
    ``n_upper`` upper-case letters, ``n_marks`` exclamation and question marks.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in COUNTS]
    words, lines = F.col("_words"), F.col("_lines")
    rows = docs.select(*kept, F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("_words"),
                       F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))

    def length_of(pattern: str) -> Column:
        return F.length(F.regexp_replace(whole, pattern, ""))

    counts = (
        F.size(words), F.length(F.array_join(words, "")), length_of(r"[^#*$%&|<>]+"),
        F.size(lines) - F.size(F.array_distinct(lines)), repeat_words(words), F.size(lines),
        F.size(F.array_distinct(words)), length_of(r"\P{Lu}+"), length_of("[^!?]+"),
    )
    return rows.select(*kept, *(c.cast("long").alias(n) for n, c in zip(COUNTS, counts)))
