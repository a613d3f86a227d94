"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from ``text_stats`` and are staged, a few numbers per document. The trees are fitted
to a bounded sample of labelled rows; they are flattened into arrays, and every batch of documents
goes through all trees at once, a level per step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import first_by_hash, held_out, staged
from pulsegrid.llm.text_stats import COUNTS, with_counts

MOST_ROWS = 50_000
BINS, TREES, DEPTH, RATE, L2, LEAST = 64, 60, 4, 0.2, 1.0, 1.0


def features(counts: np.ndarray) -> np.ndarray:
    """Shares and sizes from columns in the order of ``COUNTS``."""
    c = dict(zip(COUNTS, counts.astype(np.float64).T))
    words, chars, lines = (np.maximum(c[x], 1) for x in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_upper"] / chars,
        c["n_marks"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_distinct_words"] / words, c["n_words"] / lines,
    ])


@dataclass
class Trees:
    """All trees in flat arrays. A node sends a row left if its feature is at most the threshold;
    leaves point to themselves, so a walk may take more steps than a branch has."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray, rows: int = 4096) -> np.ndarray:
        """The probability of label 1 for each row."""
        out = np.empty(len(x))
        for at in range(0, len(x), rows):
            part = x[at:at + rows]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                below = part[row, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            out[at:at + rows] = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for log loss. Without rows every score is 0.5; with one class, its share."""
    edges = [np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1])) for v in x.T] if len(x) else []
    bins = (np.column_stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, x.T)])
            if len(x) else np.zeros((0, 0), dtype=int))
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(TREES if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        open_nodes = [(roots[-1], np.arange(len(y)))]
        for level in range(DEPTH + 1):
            below = []
            for node, rows in open_nodes:
                g, h = gradient[rows].sum(), hessian[rows].sum()
                best = _split(bins[rows], gradient[rows], hessian[rows], edges) if level < DEPTH else None
                if best is None:
                    nodes[node][4] = -RATE * g / (h + L2)
                    raw[rows] += nodes[node][4]
                    continue
                feature, at = best
                goes_left = bins[rows, feature] <= at
                nodes[node][:4] = [feature, float(edges[feature][at]), len(nodes), len(nodes) + 1]
                for part in (rows[goes_left], rows[~goes_left]):
                    below.append((len(nodes), part))
                    nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
            open_nodes = below
    flat = np.array(nodes).reshape(-1, 5)
    whole = [flat[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Trees(np.array(roots, dtype=np.int64), whole[0], flat[:, 1], whole[1], whole[2], flat[:, 4], base, DEPTH)


def _split(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray,
           edges: list[np.ndarray]) -> tuple[int, int] | None:
    """The feature and bin after which a split gains most, from histograms of the derivatives."""
    g, h = gradient.sum(), hessian.sum()
    best, most = None, 1e-6
    for feature, own in enumerate(edges):
        if not len(own):
            continue
        left_g, left_h = (np.cumsum(np.bincount(bins[:, feature], w, len(own) + 1))[:-1] for w in (gradient, hessian))
        gain = left_g ** 2 / (left_h + L2) + (g - left_g) ** 2 / (h - left_h + L2) - g ** 2 / (h + L2)
        gain[(left_h < LEAST) | (h - left_h < LEAST)] = 0
        at = int(np.argmax(gain))
        if gain[at] > most:
            best, most = (feature, at), gain[at]
    return best


def sample(stats: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of up to ``most_rows`` labelled rows outside the fold, in the order of
    a hash of their id."""
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y"))
    labelled = stats.where("NOT held_out").join(known, F.col("doc_id") == F.col("_id"))
    labelled = labelled.select(*COUNTS, "_y", F.xxhash64("doc_id").alias("_hash"))
    rows = first_by_hash(labelled, "_hash", most_rows, *COUNTS, "_y").toPandas()
    return features(rows[list(COUNTS)].to_numpy()), (rows["_y"].to_numpy() == 1).astype(np.float64)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, cut: float = 0.7,
          most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the statistics, for every document.

    Learns from labels outside the fold (``crc32(doc_id) mod modulus = remainder``), from
    ``most_rows`` of them at most. Null and empty texts are scored by their statistics, all zero;
    null labels teach nothing; rows with null or repeated ids are scored one by one; an empty table
    gives no rows. Columns other than doc_id and text are not read.
    """
    stats = with_counts(docs.select("doc_id", "text")).drop("text")
    stats = staged(stats.withColumn("held_out", held_out(F.col("doc_id"), modulus, remainder)), "stats")
    trees = fit(*sample(stats, labels, most_rows))

    @F.pandas_udf("double")
    def probability(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(trees.score(features(np.column_stack(columns))))

    scored = stats.withColumn("score", probability(*COUNTS))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
