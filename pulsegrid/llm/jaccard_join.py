"""N-gram Jaccard self-join with a count-vector R-tree; gives the components of linked documents.

A document is the set of its distinct word shingles. Hashed into groups, the set has a count per
group: a point. Two sets share at most the sum over groups of the smaller count, so points bound the
overlap, and the largest counts of a node of points bound it for all of them at once.

1. A fixed-size sketch counts shingles by hash cell over all documents. It orders shingles, rare
   cells first; the order decides how much work is done, never which links are found.
2. Documents with equal sets are one node. Two sets that link share one of the first
   ``n - ceil(0.75 n) + 1`` shingles of each, so only documents that meet in such a shingle (a block)
   can link.
3. A first round links nodes to the first and the last node with the same of their smallest hashes. It finds
   most components cheaply; within a component no pair needs a look any more.
4. Blocks that still hold several components give candidate pairs: small ones are paired as they
   are, large ones are split into cells, where an R-tree over count vectors is joined with itself;
   nodes of the tree that hold one component are passed over.
5. Pairs whose bound reaches the required overlap are verified on the whole sets.

No group is gathered whole: counts are summed before they are shuffled, pairs are joined by keys
that Spark may split, blocks above ``SMALL`` rows go by cells of at most ``CELL`` rows a side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.bitmap import without
from pulsegrid.llm.common import bound_batches, discard, staged
from pulsegrid.llm.graph import components
from pulsegrid.llm.shingles import mixed, shingle_sets

PERCENT = 75
CELLS = 1 << 20  # of the sketch: 4 MB of counts, whatever the corpus
CHUNK = 1 << 14  # cells that are summed as one row
ANCHORS = 8  # smallest hashes that the first round goes by
BEST = 2  # partners per node that the first round verifies
SMALL, CELL, LEAF = 24, 1024, 16
FILTER_BITS = 1 << 23  # of the document filter: 1 MB
_U = np.uint64


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def required(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The least overlap of sets of sizes n and m that link: 100 i >= p (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def sketch(docs: DataFrame) -> np.ndarray:
    """Shingles per hash cell, each document's set counted once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for own in shingle_sets(batch.column("text").to_pylist()):
                np.add.at(cells, (own >> _U(44)).astype(np.int64), 1)
        parts = [(i, np.flatnonzero(part), part) for i, part in enumerate(cells.reshape(-1, CHUNK))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, *_ in parts], pa.int64()),
             pa.array([at.astype(np.uint16).tobytes() for _, at, _ in parts], pa.binary()),
             pa.array([part[at].astype(np.int64).tobytes() for _, at, part in parts], pa.binary())],
            names=["chunk", "places", "counts"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(CHUNK, dtype=np.int64)
        for places, counts in zip(rows["places"], rows["counts"]):
            sums[np.frombuffer(places, dtype=np.uint16)] += np.frombuffer(counts, dtype=np.int64)
        at = np.flatnonzero(sums)
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "places": [at.astype(np.uint16).tobytes()],
                             "counts": [sums[at].tobytes()]})

    schema = "chunk long, places binary, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    # sums of sums, so that no task has the counts of all partitions at once
    some = parts.groupBy("chunk", (F.spark_partition_id() % 64).alias("part")).applyInPandas(total, schema)
    rows = some.groupBy("chunk").applyInPandas(total, schema).collect()
    cells = np.zeros((CELLS // CHUNK, CHUNK), dtype=np.int64)
    for row in rows:
        cells[row["chunk"], np.frombuffer(row["places"], dtype=np.uint16)] = np.frombuffer(row["counts"], dtype=np.int64)
    return cells.ravel()


def groups_of(n: int) -> int:
    """Groups that a set of n shingles is hashed into: a power of two, two shingles each or so."""
    return 1 << max(4, min(16, (max(n, 1) - 1).bit_length() - 1))


def count_vector(own: np.ndarray) -> np.ndarray:
    groups = groups_of(len(own))
    return np.minimum(np.bincount((own & _U(groups - 1)).astype(np.int64), minlength=groups), 65535).astype(np.uint16)


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """The counts for fewer groups: groups are the low bits of the hash, so halves are added up."""
    return vector.reshape(-1, groups).sum(axis=0) if len(vector) > groups else vector


def signed_sets(docs: DataFrame, cells: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n, key1, key2`` (a fingerprint of the set), ``first`` (its shingles in the order of
    the sketch, as many as links need), ``anchors`` (its smallest) and ``vector``."""
    order = docs.sparkSession.sparkContext.broadcast(cells)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = order.value
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for own in shingle_sets(batch.column("text").to_pylist()):
                n = len(own)
                keep = n + 1 + (-percent * n // 100) if n else 0
                rank = np.lexsort((own, cells[(own >> _U(44)).astype(np.int64)]))[:keep]
                keys = [int(_signed(mixed(own ^ _U(salt)).sum(dtype=_U, keepdims=True))[0]) for salt in (0, 0x5851F42D4C957F2D)]
                for column, value in zip(out, (n, *keys, _signed(own[rank]), _signed(own[:ANCHORS]),
                                               count_vector(own).tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:3]),
                 *(pa.array(c, pa.list_(pa.int64())) for c in out[3:5]), pa.array(out[5], pa.binary())],
                names=["doc_id", "n", "key1", "key2", "first", "anchors", "vector"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, n long, key1 long, key2 long, first array<long>, anchors array<long>, vector binary")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


@dataclass
class Links:
    """Bounds and verifies pairs ``a, b`` of nodes."""

    docs: DataFrame
    nodes: DataFrame
    percent: int = PERCENT

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose count vectors allow the required overlap, with the bound over it."""
        points = self.nodes.select("node", "n", "vector")
        rows = pairs.join(points.toDF("a", "n", "v"), "a").join(points.toDF("b", "m", "w"), "b")

        percent = self.percent

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
                least = required(n, m, percent)
                most = np.empty(len(n), dtype=np.int64)
                for i, (v, w) in enumerate(zip(batch.column("v"), batch.column("w"))):
                    v, w = (np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in (v, w))
                    groups = min(len(v), len(w))
                    most[i] = np.minimum(folded(v, groups), folded(w, groups)).sum(dtype=np.int64)
                keep = most >= least
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)),
                     pa.array((most / np.maximum(n + m, 1))[keep])], names=["a", "b", "worth"])

        return rows.select("a", "b", "n", "m", "v", "w").mapInArrow(bound, "a long, b long, worth double")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link, by their whole sets; sets are made again from the texts of just the
        documents that occur. A filter of fixed size spares most other texts the way; what it lets
        through is joined by id."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        places = ids.select(F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)).alias("place"))
        words = places.groupBy(F.expr("place div 64").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, int(place % 64)))").alias("bits"))
        table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
        for row in words.toLocalIterator():
            table[row["word"]] = row["bits"]
        known = self.docs.sparkSession.sparkContext.broadcast(table)

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = known.value
            for batch in batches:
                at = batch.column("place").to_numpy()
                keep = pa.array(((table[at // 64] >> (at % 64)) & 1).astype(bool))
                found = shingle_sets(batch.column("text").filter(keep).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").filter(keep), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["node", "set"])

        texts = self.docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
        whole = texts.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))).mapInArrow(
            sets, "node long, set binary")
        whole = staged(whole.where(F.length("set") > 0), "sets")
        rows = pairs.join(whole.toDF("a", "s"), "a").join(whole.toDF("b", "t"), "b").select("a", "b", "s", "t")
        percent = self.percent

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for s, t in zip(batch.column("s"), batch.column("t")):
                    s, t = (np.frombuffer(x.as_buffer(), dtype=_U) for x in (s, t))
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= percent * (len(s) + len(t) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                                 names=["a", "b"])

        linked = staged(rows.mapInArrow(check, "a long, b long").distinct(), "links")
        discard(whole)
        return linked


def first_round(nodes: DataFrame, links: Links) -> DataFrame:
    """Links of nodes with the first and last node that share one of their anchors."""
    rows = nodes.select("node", "n", F.explode("anchors").alias("anchor"))
    ends = staged(rows.groupBy("anchor").agg(
        F.min(F.struct("node", "n")).alias("low"), F.max(F.struct("node", "n")).alias("high"))
        .where("low.node != high.node"), "anchors")
    met = rows.join(ends, "anchor").select("node", "n", F.explode(F.array("low", "high")).alias("end"))
    pairs = met.where((F.col("node") != F.col("end.node")) & _sizes_fit(F.col("n"), F.col("end.n"), links.percent))
    pairs = staged(_ordered(pairs.select(F.col("node").alias("a"), F.col("end.node").alias("b"))), "pairs")
    good = staged(links.bounded(pairs), "bounded")
    # every node's best partners; the second round has the rest
    either = good.select("b", "a", "worth").toDF("a", "b", "worth").unionAll(good.select("a", "b", "worth"))
    best = either.groupBy("a").agg(F.max(F.struct("worth", "b")).alias("x"), F.min("b").alias("low"))
    chosen = best.select("a", F.explode(F.array("x.b", "low")).alias("b"))
    linked = links.verified(staged(_ordered(chosen), "pairs"))
    discard(ends, pairs, good)
    return linked


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with a < b."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def open_blocks(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``token, node, n, component, size`` of the blocks that hold more than one component."""
    rows = nodes.select("node", "n", F.explode("first").alias("token"))
    shared = staged(rows.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    met = staged(rows.join(shared, "token").drop("size"), "blocks")
    discard(shared)
    named = staged(met.join(labels, "node", "left").select(
        "token", "node", "n", F.coalesce("component", "node").alias("component")), "blocks")
    discard(met)
    several = staged(named.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low != high").select("token", "size"), "several")
    return staged(named.join(several, "token"), "open")


def small_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in blocks of at most ``SMALL`` rows."""
    rows = blocks.where(F.col("size") <= SMALL).select("token", "node", "n", "component")
    other = rows.select("token", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "component")))
    pairs = rows.join(other, "token").where(
        (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2"))
        & _sizes_fit(F.col("n"), F.col("n2"), percent))
    return _ordered(pairs.select(F.col("node").alias("a"), F.col("node2").alias("b")))


class Tree:
    """An R-tree of two levels over count vectors: leaves of ``LEAF`` points with the largest counts.

    Points come ordered by component and size, so that leaves of near copies have tight bounds."""

    def __init__(self, node: np.ndarray, n: np.ndarray, component: np.ndarray, vectors: list[np.ndarray],
                 tokens: list[np.ndarray]):
        order = np.lexsort((node, n, component))
        self.tokens = [tokens[i] for i in order]
        self.node, self.n, self.component = node[order], n[order], component[order]
        self.vectors = [vectors[i] for i in order]
        self.starts = np.arange(0, len(node), LEAF)
        self.groups = min([len(v) for v in vectors])
        points = np.array([folded(v, self.groups) for v in self.vectors], dtype=np.int64)
        self.most = np.maximum.reduceat(points, self.starts, axis=0)
        self.low, self.high = (f.reduceat(self.n, self.starts) for f in (np.minimum, np.maximum))
        self.first, self.last = (f.reduceat(self.component, self.starts) for f in (np.minimum, np.maximum))

    def leaf(self, k: int) -> range:
        return range(self.starts[k], min(self.starts[k] + LEAF, len(self.node)))


def joined(left: Tree, right: Tree, same: bool, token: int, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of points of different components whose bound reaches the required overlap. A pair that
    meets in several blocks is given in that of the smallest token only."""
    groups = min(left.groups, right.groups)
    most = [np.array([folded(m, groups) for m in t.most]) for t in (left, right)]
    for i in range(len(left.starts)):
        fits = (100 * right.high >= percent * left.low[i]) & (100 * left.high[i] >= percent * right.low)
        fits &= ~((left.first[i] == left.last[i]) & (right.first == right.last) & (left.first[i] == right.first))
        fits &= np.minimum(most[0][i], most[1]).sum(axis=1) >= required(left.low[i], right.low, percent)
        for j in np.flatnonzero(fits):
            if same and j < i:
                continue
            for p in left.leaf(i):
                for q in right.leaf(j):
                    n, m = int(left.n[p]), int(right.n[q])
                    if left.component[p] == right.component[q] or 100 * min(n, m) < percent * max(n, m):
                        continue
                    v, w = left.vectors[p], right.vectors[q]
                    g = min(len(v), len(w))
                    if np.minimum(folded(v, g), folded(w, g)).sum() >= required(n, m, percent) and (
                            np.intersect1d(left.tokens[p], right.tokens[q], assume_unique=True)[0] == token):
                        yield int(left.node[p]), int(right.node[q])


def large_pairs(blocks: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs from blocks above ``SMALL`` rows, by R-trees. A block of many rows is dealt into parts
    of ``CELL`` rows or so, and every two parts meet in a cell of their own."""
    rows = blocks.where(F.col("size") > SMALL)
    # the large blocks a node is in are bounded by its own shingles
    own = rows.groupBy("node").agg(F.collect_set("token").alias("tokens"))
    points = staged(own.join(nodes.select("node", "vector"), "node"), "points")
    rows = rows.join(points, "node")
    rows = rows.withColumn("parts", F.ceil(F.col("size") / CELL)).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = cells.select("token", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"),
                         "part", "node", "n", "component", "vector", "tokens")

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        token, x, y = (rows[c].iloc[0] for c in ("token", "x", "y"))
        trees = [Tree(*(own[c].to_numpy() for c in ("node", "n", "component")),
                      [np.frombuffer(v, dtype=np.uint16) for v in own["vector"]], list(own["tokens"]))
                 for own in (rows[rows["part"] == p] for p in dict.fromkeys((x, y))) if len(own)]
        pairs: set[tuple[int, int]] = set()
        if x == y and trees:
            pairs = set(joined(trees[0], trees[0], True, token, percent))
        elif len(trees) == 2:
            pairs = set(joined(trees[0], trees[1], False, token, percent))
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype="int64")

    return _ordered(cells.groupBy("token", "x", "y").applyInPandas(meet, "a long, b long"))


def linked_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document, from columns doc_id and text.

    Documents link when their sets have a Jaccard similarity of ``percent`` hundredths or more.
    Null and empty texts and texts of blanks have no shingles and are components of their own. Rows
    of equal sets are one class whatever their number; rows that share a doc_id count as one node;
    rows without a doc_id get the component of their class, null if that has no id. Texts are
    hashed whole, in pieces of bounded size. An empty table gives no rows; other columns are not
    read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    signed = staged(signed_sets(docs, sketch(docs), percent), "signed")
    narrow = signed.select("doc_id", "n", "key1", "key2")
    keys = ["n", "key1", "key2"]
    classes = staged(narrow.where("n > 0").groupBy(*keys).agg(F.min("doc_id").alias("node")), "classes")
    nodes = staged(signed.join(classes.where("node IS NOT NULL").withColumnRenamed("node", "doc_id"),
                               [*keys, "doc_id"]).withColumnRenamed("doc_id", "node").drop("key1", "key2"), "nodes")
    narrow = staged(narrow, "sizes")
    discard(signed)
    links = Links(docs, nodes, percent)
    edges = first_round(nodes, links)
    blocks = open_blocks(nodes, components(edges))
    pairs = staged(small_pairs(blocks, percent), "pairs")
    good = links.bounded(pairs).select("a", "b").unionAll(large_pairs(blocks, nodes, percent)).distinct()
    more = links.verified(staged(good, "bounded"))
    # documents that share an id are one node, so classes they stand for are linked as well
    labels = staged(components(edges.unionAll(more)), "labels")
    discard(nodes, blocks, pairs)
    named = classes.join(labels, "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component"))
    return (narrow.join(staged(named, "named"), keys, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without those that belong to a component of another document; documents without
    shingles, and rows without an id, stay."""
    found = linked_components(docs, percent)
    gone = found.where("n_shingles > 0 AND component_id != doc_id").select("doc_id").distinct()
    return without(docs, staged(gone, "gone"))
