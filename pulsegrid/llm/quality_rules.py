"""Quality rules: a learned decision list, with DataFrame operations only.

Sequential covering on labelled statistics. A rule is a conjunction of thresholds that tells bad
documents; it is grown on one part of the labelled rows by the condition of highest information
gain, pruned on the other by dropping last conditions, and kept if it is precise there. What it
covers is set aside and the next rule is learned from the rest. The ordered rules become one Spark
conditional expression.

Labelled rows are counted once per combination of threshold bins; every step of the search is an
aggregate over these counts, and what reaches the driver is a count per feature and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged

FEATURES = {
    "n_words": "double(n_words)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}
QUANTILES = 24
MOST_CONDITIONS, MOST_RULES = 4, 16


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    bin: int  # rows above the threshold have a larger bin

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def on_bins(self) -> Column:
        value = F.col(self.feature)
        return value > self.bin if self.above else value <= self.bin


def both(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def thresholds(labelled: DataFrame) -> dict[str, list[float]]:
    """Quantiles of every feature, to three digits."""
    points = [(i + 1) / (QUANTILES + 1) for i in range(QUANTILES)]
    points += [0.002, 0.01, 0.99, 0.998]
    row = labelled.agg(*(F.percentile_approx(F.expr(e), points, 10_000).alias(f)
                         for f, e in FEATURES.items())).first()
    return {f: sorted({float(f"{x:.3g}") for x in row[f] or []}) for f in FEATURES}


def _cells(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Counts of good and bad rows per part and combination of bins; a bin is the number of
    thresholds below the value."""
    def bin_of(feature: str, values: list[float]) -> Column:
        value = F.expr(FEATURES[feature])
        there = F.array(*[F.lit(v) for v in values]).cast("array<double>")
        return F.size(F.filter(there, lambda t: t < value)).alias(feature)

    bins = [bin_of(f, values) for f, values in cuts.items()]
    part = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, "prune").otherwise("grow")
    rows = labelled.select(part.alias("part"), "bad", *bins)
    return rows.groupBy("part", *cuts).agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, float]:
    """The condition of highest FOIL gain on the rows, and the share of bad rows under it."""
    stacked = rows.select("p", "n", F.explode(F.array(*(F.struct(
        F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in cuts))).alias("x"))
    counts = stacked.groupBy("x.feature", "x.bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()
    best, best_gain, purity = None, 1e-9, 0.0
    for feature, values in cuts.items():
        own = sorted((r["bin"], r["p"], r["n"]) for r in counts if r["feature"] == feature)
        all_p, all_n = sum(r[1] for r in own), sum(r[2] for r in own)
        if not all_p:
            continue
        base = math.log2(all_p / (all_p + all_n))
        for at, threshold in enumerate(values):
            below_p, below_n = (sum(r[i] for r in own if r[0] <= at) for i in (1, 2))
            for above, p, n in ((True, all_p - below_p, all_n - below_n), (False, below_p, below_n)):
                if p and p + n < all_p + all_n:
                    gain = p * (math.log2(p / (p + n)) - base)
                    if gain > best_gain:
                        best, best_gain, purity = Condition(feature, above, threshold, at), gain, p / (p + n)
    return best, purity


def learn(stats: DataFrame, labels: DataFrame, precision: float = 0.9,
          least: int = 5) -> list[list[Condition]]:
    """The ordered rules that tell bad documents (``labels.quality`` 0), from ``stats`` (doc_id and
    the counts of ``text_stats``). Rules need ``precision`` on the pruning part and ``least`` bad
    rows in all. Rows without a label, or a null one, teach nothing; without bad rows there are no
    rules."""
    labelled = stats.join(labels.where("quality IS NOT NULL").select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 0).cast("long").alias("bad")),
        F.col("doc_id") == F.col("_id")).drop("_id")
    labelled = staged(labelled, "labelled")
    cuts = thresholds(labelled)
    left = staged(_cells(labelled, cuts), "cells")
    rules: list[list[Condition]] = []
    while len(rules) < MOST_RULES:
        rule: list[Condition] = []
        grow = left.where("part = 'grow'")
        while len(rule) < MOST_CONDITIONS:
            condition, purity = _best(grow.where(both([c.on_bins() for c in rule])), cuts)
            if condition is None:
                break
            rule.append(condition)
            if purity == 1.0:
                break
        if not rule:
            break
        # value of the rule cut after each condition, on the rows held back for that
        sums = []
        for size in range(1, len(rule) + 1):
            fits = both([c.on_bins() for c in rule[:size]])
            for part in ("prune", "grow"):
                for count in "pn":
                    sums.append(F.coalesce(F.sum(F.when(fits & (F.col("part") == part), F.col(count))), F.lit(0)))
        values = [int(x or 0) for x in left.agg(*(s.alias(f"c{i}") for i, s in enumerate(sums))).first()]
        worth = []
        for size in range(1, len(rule) + 1):
            p, n, grow_p, _ = values[4 * size - 4:4 * size]
            worth.append(((p - n) / (p + n) if p + n else -1.0, -size, p, n, p + grow_p))
        _, size, p, n, bad = max(worth)
        if p < precision * (p + n) or not p or bad < least:
            break
        rules.append(rule[:-size])
        left = left.where(~both([c.on_bins() for c in rules[-1]]))
    return rules


def rule_number(rules: list[list[Condition]]) -> Column:
    """The number, from 1, of the first rule a document meets; 0 if it meets none."""
    out = None
    for number, rule in enumerate(rules, 1):
        fits = both([c.column() for c in rule])
        out = F.when(fits, number) if out is None else out.when(fits, number)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(stats: DataFrame, rules: list[list[Condition]], least_words: int = 10,
          most_repeat_percent: int = 20) -> DataFrame:
    """``stats`` plus ``base_failed``, ``rule`` and ``kept``.

    Null and empty texts have no words and fail the base rule; texts of any length, repeated rows
    and null ids are judged row by row; an empty table gives no rows. Columns of these three names
    are replaced.
    """
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
    return (stats.withColumn("base_failed", failed).withColumn("rule", rule_number(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
