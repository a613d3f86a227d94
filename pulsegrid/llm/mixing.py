"""Mixing sources to target weights by Pareto order sampling, with DataFrame operations only.

Every source has a target of words. Whole copies that every document of a source gets are allotted
first; what the target still lacks is a fixed-size sample, its size counted in words: documents are
ranked by the odds of a hashed uniform number divided by their inclusion odds (Rosén's Pareto order
sampling) and taken in that order as long as they fit; a few more, each the one that fits the
remaining gap best, close it.

Inclusion odds are unequal: a document of mean size has the odds of its source's remaining share,
longer ones less and shorter ones more, so that repeats are spread over many documents.

No step gathers a source in one task. The cut in the order is found on histograms of the rank
(two levels of ``BINS`` bins, summed before the shuffle); only the documents of the cut's own bin,
one in ``BINS`` squared, are ordered row by row. Random numbers are hashes of doc_id: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import discard, staged, word_count

BINS = 4096
FITS = 3  # documents out of order, at most, that close the gap the order leaves
WEIGHTS = (3, 1, 2)


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``: the words of the text, 0 without one."""
    return docs.withColumn("size", word_count(F.col("text")))


def numbered(keys: DataFrame, column: str) -> DataFrame:
    """Distinct keys with ``position`` from 0 in code point order, null last, without one task that
    sees all: ranges are numbered on their own and shifted by the counts of the ranges before."""
    ranged = staged(keys.repartitionByRange(F.col(column).asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("shift"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.col(column).asc_nulls_last()))
    return (ranged.withColumn("rank", rank).join(offsets, "part")
            .select(column, *[c for c in keys.columns if c != column],
                    (F.col("shift") + F.col("rank") - 1).alias("position")))


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, docs, target``: the words each source is to give.

    Sources in code point order (null last) weigh ``weights``, repeating. They share ``share`` times
    all words; none is to give more than ``most`` times what it has, and the excess goes to the
    others by weight. Each round fixes the sources above their bound, so rounds are few; what
    reaches the driver per round are three sums.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("docs"))
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("position") % len(weights) + 1).cast("int"))
    sources = staged(numbered(sums, "source").select(
        "source", "source_size", "docs", weight.alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("bound")), "sources")
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        over = F.col("bound") <= F.col("weight") * F.lit(level)
        n, bounds, free = sources.agg(
            F.count_if(over), F.sum(F.when(over, F.col("bound"))),
            F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not free:
            break
        full, level = n, (total - (bounds or 0.0)) / free
    return sources.select("source", "source_size", "docs", F.least(
        F.col("bound"), F.col("weight") * F.lit(level)).alias("target"))


def uniform(key: Column) -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of the key's MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10)
    return (bits.cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _ranked(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with their source's whole copies, the words still lacking and their rank."""
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mean = F.col("source_size") / F.col("docs")
    u, rest = F.col("u"), F.col("share_left")
    odds = rest / (1 - rest) * 2 / (1 + F.col("size") / mean)
    return (
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of").withColumn("ratio", copies).withColumn("whole", F.floor("ratio"))
        .withColumn("share_left", F.col("ratio") - F.col("whole"))
        .withColumn("lacking", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("u", uniform(F.col("doc_id")))
        # the odds' quotient q as q / (1 + q), which lies between 0 and 1
        .withColumn("rank", F.when((rest > 0) & (F.col("size") > 0),
                                   (u / (1 - u)) / ((u / (1 - u)) + odds)))
    )


def _cut_bin(rows: DataFrame, bins: Column, before: Column) -> DataFrame:
    """Per source the bin in which its words pass what is lacking, and the words ahead of it."""
    counts = rows.groupBy("source", bins.alias("bin")).agg(
        F.sum("size").alias("words"), F.max("lacking").alias("lacking"), F.max(before).alias("b"))
    order = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    upto = F.col("b") + F.sum("words").over(order)
    return (counts.withColumn("upto", upto).where(F.col("upto") > F.col("lacking"))
            .groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words"))
                                                  .alias("ahead"))).alias("c"))
            .select(F.col("source").alias("of"), F.col("c.bin").alias("cut"), F.col("c.ahead").alias("ahead")))


def sample_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source where its sample ends: ``of, last`` (rank and doc_id of the last document that
    fits in order; null where none does in the cut's own bin, which begins at ``start``) and ``fits``
    (rank and doc_id of those that close the gap)."""
    ranked = _ranked(sized, targets).where("rank IS NOT NULL").select(
        "source", "doc_id", "size", "rank", "lacking")
    first_bin = F.floor(F.col("rank") * BINS)
    second_bin = F.floor((F.col("rank") * BINS - first_bin) * BINS)
    same = F.col("source").eqNullSafe(F.col("of"))
    cut1 = staged(_cut_bin(ranked, first_bin, F.lit(0)), "cut")
    at1 = ranked.join(cut1, same).where(first_bin == F.col("cut"))
    cut2 = staged(_cut_bin(at1, second_bin, F.col("ahead"))
                  .withColumnRenamed("cut", "cut2").withColumnRenamed("ahead", "ahead2"), "cut")
    cuts = cut1.withColumnRenamed("of", "of1").join(cut2, F.col("of1").eqNullSafe(F.col("of")))
    cuts = staged(cuts.select("of", "cut", "cut2", "ahead2"), "cut")
    own = ranked.join(cuts, same).where((first_bin == F.col("cut")) & (second_bin == F.col("cut2")))
    upto = F.col("ahead2") + F.sum("size").over(W.partitionBy("source").orderBy("rank", "doc_id"))
    fitting = own.withColumn("upto", upto).where("upto <= lacking").groupBy("source").agg(
        F.max(F.struct("rank", "doc_id")).alias("last"), F.max("upto").alias("upto"))
    # without a fitting document in the cut's own bin the sample ends just ahead of that bin
    start = (F.col("cut") + F.col("cut2") / BINS) / BINS
    gap = F.col("lacking") - F.coalesce(F.col("upto"), F.col("ahead2"))
    joined = cuts.join(fitting.withColumnRenamed("source", "of2"), F.col("of").eqNullSafe(F.col("of2")), "left")
    lacking = targets.select(F.col("source").alias("of4"), (
        F.col("target") - F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
        * F.col("source_size")).alias("lacking"))
    ends = staged(joined.join(lacking, F.col("of").eqNullSafe(F.col("of4"))).select(
        "of", "last", start.alias("start"), gap.alias("gap"),
        F.lit([]).cast("array<struct<rank:double,doc_id:%s>>" % sized.schema["doc_id"].dataType.simpleString())
        .alias("fits")), "ends")
    for _ in range(FITS):
        apart = F.abs(F.col("gap") - F.col("size"))
        rest = ranked.join(ends, same).where(~_before(F.col("rank"), F.col("doc_id")) & ~_fitted() & (apart < F.col("gap")))
        best = rest.groupBy("source").agg(F.min(F.struct(apart.alias("apart"), "rank", "doc_id", "size")).alias("best"))
        closer = ends.join(best.withColumnRenamed("source", "of3"), F.col("of").eqNullSafe(F.col("of3")), "left")
        before, ends = ends, staged(closer.select(
            "of", "last", "start", (F.col("gap") - F.coalesce(F.col("best.size"), F.lit(0))).alias("gap"),
            F.when(F.col("best").isNull(), F.col("fits")).otherwise(
                F.array_append("fits", F.struct("best.rank", "best.doc_id"))).alias("fits")), "ends")
        discard(before)
    discard(cut1, cut2, cuts)
    return ends


def _fitted() -> Column:
    """Whether a document is among those that close the gap."""
    return F.exists("fits", lambda f: (f["rank"] == F.col("rank")) & f["doc_id"].eqNullSafe(F.col("doc_id")))


def _before(rank: Column, doc_id: Column) -> Column:
    """Whether a document is in its source's sample by order."""
    last = F.col("last")
    upto = (rank < last["rank"]) | ((rank == last["rank"]) & (
        doc_id.isNull() | F.coalesce(doc_id <= last["doc_id"], F.lit(False))))
    return F.when(last.isNotNull(), upto).otherwise(rank < F.col("start"))


def mix(sized: DataFrame, share: float = 1.5, most: float = 2.0,
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sized`` (with ``doc_id``, ``source``, ``size``) plus ``source_size``, ``target`` and
    ``copies``: how often the mix takes the document, ``ceil(most)`` times at most.

    Null text: size 0, which is never sampled. Null source: a source of its own, the last. Rows with
    the same doc_id (also null ones) have the same random number and so share their fate where they
    share source and size. A source without words has target 0. Empty input gives no rows. Columns
    named like the added ones are replaced; all others pass through.
    """
    added = ("source_size", "target", "copies", "docs", "of", "last", "start", "fits", "gap", "ratio",
             "whole", "share_left", "lacking", "u", "rank")
    sized = sized.drop(*added)
    narrow = staged(sized.select("doc_id", "source", "size"), "sizes")
    targets = staged(source_targets(narrow, share, most, weights), "targets")
    cuts = sample_cuts(narrow, targets)
    discard(narrow)
    rows = _ranked(sized, targets).join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    # a source whose words never pass what is lacking has no cut and is taken whole
    chosen = F.col("rank").isNotNull() & (
        F.col("start").isNull() | _before(F.col("rank"), F.col("doc_id")) | _fitted())
    return rows.select(*sized.columns, "source_size", "target",
                       (F.col("whole") + chosen.cast("long")).alias("copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Every row as many times as ``copies`` says; rows taken never are gone."""
    return mixed.withColumn("copy", F.explode(F.expr("array_repeat(1, int(copies))"))).drop("copy")
