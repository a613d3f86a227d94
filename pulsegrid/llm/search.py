"""Exact top-k inner product search with block-at-a-time pruning.

Vectors are ordered by their strongest component and cut into ranges of consecutive vectors, the
blocks, each kept whole (its forward index: ids and components). A block's component maxima and
minima bound the score any of its vectors can reach with a query. Per query the blocks are visited
by falling bound, and the visit ends once the bounds fall below the k-th score found so far.

Where a query lies itself, its own range is searched first; that k-th score is a floor under which
no other range has to be scored. Then query chunks meet ranges in a grid of bounded groups: every
cell has ``CHUNKS`` chunks and ``RANGES`` ranges at most, so what a task holds does not grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged

BLOCK, RANGE_ROWS, CHUNK_ROWS = 256, 4096, 512
CHUNKS, RANGES = 16, 16
EXACT = float(1 << 53)
PACKED = "kind string, dim int, number long, ids binary, vectors binary, floors binary"


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v`` with ``floor(scale * x)`` of every component, x taken as double.

    Rows without an id or a vector, and vectors with null, NaN or infinite components, are left out.
    Of rows that share a vec_id the one with the greatest vector, component by component, counts.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite)
            .select(F.col("vec_id").cast("long"), v.alias("v")).groupBy("vec_id").agg(F.max("v").alias("v")))


def top_k(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray,
          ids: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) per query among ``vectors``, best first, ties to the smaller id; an
    id of -1 marks a place without a vector. Scores below a query's floor may be left out."""
    n, dim = vectors.shape
    largest = [float(np.abs(x).max()) if x.size else 0.0 for x in (queries, vectors)]
    # whole numbers this small are exact in floating point, which multiplies matrices faster
    kind = np.float64 if largest[0] * largest[1] * max(dim, 1) < EXACT else np.int64
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    low = -EXACT * 1024 if kind is np.float64 else np.iinfo(np.int64).min + 1  # its negative fits as well
    starts = np.arange(0, n, block)
    most = np.maximum.reduceat(vectors, starts, axis=0)
    least = np.minimum.reduceat(vectors, starts, axis=0)
    bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((len(queries), k), low, dtype=kind)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    floors = np.maximum(floors.astype(kind), low)
    everyone = np.arange(len(queries))
    for turn in range(len(starts)):
        blocks = order[:, turn]
        active = everyone[bounds[everyone, blocks] >= np.maximum(floors, best[:, -1])]
        if not len(active):
            break
        for one in np.unique(blocks[active]):
            rows = active[blocks[active] == one]
            own = slice(starts[one], starts[one] + block)
            scores = queries[rows] @ vectors[own].T
            scores[ids[own][None, :] == query_ids[rows][:, None]] = low
            worth = (scores >= np.maximum(floors, best[:, -1])[rows][:, None]).any(axis=1)
            rows, scores = rows[worth], scores[worth]
            scores = np.hstack([best[rows], scores])
            names = np.hstack([best_ids[rows], np.broadcast_to(ids[own], (len(rows), len(ids[own])))])
            keep = np.lexsort((names, -scores), axis=1)[:, :k]
            best[rows] = np.take_along_axis(scores, keep, axis=1)
            best_ids[rows] = np.take_along_axis(names, keep, axis=1)
    return best, np.where(best == low, -1, best_ids)


def _packed(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """Ranges and query chunks as single rows; chunks carry the floors found in their own range."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        number = 0

        def rows(dim: int) -> Iterator[tuple]:
            ids = np.array([x[0] for x in held[dim]], dtype=np.int64)
            matrix = np.array([x[1] for x in held[dim]], dtype=np.int64).reshape(len(ids), dim)
            yield "range", dim, number, ids.tobytes(), matrix.tobytes(), b""
            asked = ids % every == 0
            query_ids, queries = ids[asked], matrix[asked]
            for at in range(0, len(query_ids), CHUNK_ROWS):
                own = slice(at, at + CHUNK_ROWS)
                none = np.full(len(query_ids[own]), np.iinfo(np.int64).min)
                best, found = top_k(queries[own], query_ids[own], none, matrix, ids, k)
                floors = np.where(found[:, -1] >= 0, best[:, -1], none).astype(np.int64)
                yield ("chunk", dim, number, query_ids[own].tobytes(), queries[own].tobytes(),
                       floors.tobytes())

        for batch in batches:
            for vec_id, v in zip(batch["vec_id"], batch["v"]):
                held.setdefault(len(v), []).append((vec_id, v))
                if len(held[len(v)]) == RANGE_ROWS:
                    yield pd.DataFrame(rows(len(v)), columns=PACKED.replace(",", "").split()[::2])
                    held[len(v)], number = [], number + 1
        for dim in held:
            yield pd.DataFrame(rows(dim), columns=PACKED.replace(",", "").split()[::2])
            number += 1

    ordered = (vectors.withColumn("strong", F.array_max("v"))
               .repartitionByRange(F.array_position("v", F.col("strong")), "strong", "vec_id"))
    return staged(ordered.select("vec_id", "v").mapInPandas(pack, PACKED), "ranges")


def _matrix(packed: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(packed["ids"], dtype=np.int64)
    return ids, np.frombuffer(packed["vectors"], dtype=np.int64).reshape(len(ids), packed["dim"])


def search(rows: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every`` the
    ``k`` highest integer inner products with the other vectors of its length (all, if fewer), ties
    to the smaller vec_id.

    See ``integer_vectors`` for the rows that take no part. Scores are exact as long as they fit 64
    bits. An empty table, or one without queries, gives no rows; other columns are not read.
    """
    packed = _packed(integer_vectors(rows), every, k)
    counts = {r["kind"]: r["n"] for r in packed.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    across = -(-counts.get("range", 1) // RANGES)
    down = -(-counts.get("chunk", 1) // CHUNKS)
    own = F.xxhash64("dim", "number", "ids")
    columns = ("dim", "ids", "vectors", "floors")
    chunks = packed.where("kind = 'chunk'").select(
        *columns, F.pmod(own, F.lit(down)).alias("y"),
        F.explode(F.expr(f"sequence(0L, {across - 1}L)")).alias("x"))
    ranges = packed.where("kind = 'range'").select(
        *columns, F.pmod(own, F.lit(across)).alias("x"),
        F.explode(F.expr(f"sequence(0L, {down - 1}L)")).alias("y"))

    def cell(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = []
        for dim in set(asked["dim"]) & set(there["dim"]):
            parts = [_matrix(r) for _, r in there[there["dim"] == dim].iterrows()]
            ids = np.concatenate([p[0] for p in parts])
            matrix = np.concatenate([p[1] for p in parts])
            for _, chunk in asked[asked["dim"] == dim].iterrows():
                query_ids, queries = _matrix(chunk)
                floors = np.frombuffer(chunk["floors"], dtype=np.int64)
                best, names = top_k(queries, query_ids, floors, matrix, ids, k)
                there_is = names >= 0
                found.append(pd.DataFrame({
                    "query_id": np.repeat(query_ids, k)[there_is.ravel()],
                    "vec_id": names[there_is], "score": best[there_is].astype(np.int64)}))
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        return pd.concat([empty, *found])

    scored = chunks.groupBy("y", "x").cogroup(ranges.groupBy("y", "x")).applyInPandas(
        cell, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
