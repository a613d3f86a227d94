"""A filter of fixed size over 64-bit hashes: it may let a key through that is not in the set, never
stop one that is. It only spares rows a shuffle ahead of an exact join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG2_CHUNK = 15  # bits that are filled as one row: 4 KB


def bitmap(keys: DataFrame, column: str, log2_bits: int) -> np.ndarray:
    """The filter as 64-bit words: the top ``log2_bits`` (16 or more) bits of a key are its place."""
    per_chunk = 1 << LOG2_CHUNK

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        place = rows["place"].to_numpy()
        bits = np.zeros(per_chunk, dtype=bool)
        bits[place % per_chunk] = True
        return pd.DataFrame({"chunk": [int(place[0]) // per_chunk],
                             "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    places = keys.select(F.shiftrightunsigned(column, 64 - log2_bits).alias("place")).distinct()
    chunk = F.expr(f"place div {per_chunk}L")
    words = np.zeros(((1 << log2_bits) // per_chunk, per_chunk // 64), dtype=np.uint64)
    for row in places.groupBy(chunk).applyInPandas(fill, "chunk long, bits binary").toLocalIterator():
        words[row["chunk"]] = np.frombuffer(row["bits"], dtype=np.uint64)
    return words.ravel()


def maybe_in(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (64-bit, unsigned) may be in the set."""
    log2_bits = (len(words) * 64).bit_length() - 1
    place = keys >> np.uint64(64 - log2_bits)
    return ((words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def marked(rows: DataFrame, ids: DataFrame, column: str, log2_bits: int = 23) -> DataFrame:
    """``rows`` with ``_maybe``: whether the value of ``column`` may be among ``ids.doc_id``."""
    hashed = ids.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"))
    words = rows.sparkSession.sparkContext.broadcast(bitmap(hashed, "h", log2_bits))

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(maybe_in(words.value, h.to_numpy().view(np.uint64)))

    return rows.withColumn("_maybe", test(F.xxhash64(F.col(column).cast("long"))))


def without(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """``rows`` whose value is not among ``ids.doc_id``; only those that may be are shuffled."""
    tested = marked(rows, ids, column)
    gone = ids.select(F.col("doc_id").alias("_gone"))
    rest = tested.where("_maybe").join(gone, F.col(column) == F.col("_gone"), "left_anti")
    return tested.where("NOT _maybe").unionAll(rest).drop("_maybe")


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` joined with ``ids`` on doc_id; most rows without a partner are not shuffled."""
    return marked(rows, ids, "doc_id").where("_maybe").drop("_maybe").join(ids, "doc_id")
