"""Best-fit packing with large-item matching over the length histogram.

Documents above one third of a sequence share one with at most one other of their kind, so these are
matched first: from the longest down, each with the longest that still fits beside it. Who has the
fewest partners chooses first, so no other matching has more pairs. Smaller documents, longest
first, go into the smallest gap that takes them. Both steps work on counts of lengths: the result is
a table of patterns with counts whose size depends on the sequence length alone.

Tasks number their pieces per length while they cut them; shifted by the counts of the tasks before,
the numbers are ranks over the whole table, and a rank leads to its sequence.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import small_batches, staged
from pulsegrid.llm.packing import ids_of, places

SEQUENCE = 1024
END_ID = 2
PIECES = "piece int, start long, length long, ids_crc32 long, part int, number long"
Patterns = list[tuple[tuple[int, ...], int]]


def matched(counts: dict[int, int], capacity: int) -> Patterns:
    """Pairs of large lengths, and those left alone, with how often each occurs."""
    left = dict(counts)
    lengths = sorted(left, reverse=True)
    out: Patterns = []
    for length in lengths:
        for other in lengths:
            if not left[length]:
                break
            if other > length or other + length > capacity:
                continue
            pairs = left[length] // 2 if other == length else min(left[length], left[other])
            if pairs:
                out.append(((length, other), pairs))
                left[length] -= pairs
                left[other] -= pairs
        if left[length]:
            out.append(((length,), left[length]))
            left[length] = 0
    return out


def best_fit(histogram: dict[int, int], capacity: int = SEQUENCE) -> Patterns:
    """Patterns of lengths and how many sequences follow each.

    Of equal pieces that go into equal gaps as many as fit go into one gap before the next is used:
    after the first, that gap is the smallest that takes the second. So whole groups move at once.
    """
    gaps: list[Patterns] = [[] for _ in range(capacity + 1)]
    large = {length: n for length, n in histogram.items() if 3 * length > capacity}
    for pattern, count in matched(large, capacity):
        gaps[capacity - sum(pattern)].append((pattern, count))
    for length in sorted(set(histogram) - set(large), reverse=True):
        left = histogram[length]
        placed: list[tuple[int, tuple[int, ...], int]] = []
        for room in range(length, capacity + 1):
            fits = room // length
            while left and (gaps[room] or room == capacity):
                # whole sequences are opened when no gap is left
                pattern, count = gaps[room].pop() if gaps[room] else ((), -(-left // fits))
                full = min(count, left // fits)
                rest = left - full * fits if full < count else 0
                if full:
                    placed.append((room - fits * length, pattern + (length,) * fits, full))
                if rest:
                    placed.append((room - rest * length, pattern + (length,) * rest, 1))
                left -= full * fits + rest
                unused = count - full - (rest > 0)
                if unused and pattern:
                    gaps[room].append((pattern, unused))
        for room, pattern, count in placed:
            gaps[room].append((pattern, count))
    return [x for group in gaps for x in group]


def pieces(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID,
           ranks_path: str | None = None) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` with the task that made it and
    its number among that task's pieces of the length. Longer documents are cut so that all pieces
    but the first are full; null text counts as empty, its document is the closing id alone."""
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, made = ids_of(ranks_path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            owner, piece, start, length, crc, number = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = tokenizer.encode(text.as_py() or "") + end
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % sequence + 1, n + 1, sequence)]
                for at, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    owner.append(row)
                    piece.append(at)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(ids[4 * low:4 * high]))
                    number.append(made[high - low])
                    made[high - low] += 1
            kinds = ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()),
                     ([part] * len(owner), pa.int32()), (number, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())), *(pa.array(x, kind) for x, kind in kinds)],
                names=["doc_id", *PIECES.replace(",", "").split()[::2]])
        tokenizer.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {PIECES}")


def pack(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID,
         ranks_path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Documents of ``sequence`` ids at most, closing id included, are whole; every id of a longer one
    lies in one piece. A sequence's pieces follow each other without a gap from offset 0. Null and
    empty texts are one-id documents; repeated rows and repeated or null doc_ids are packed like any
    others; an empty table gives no rows; columns other than doc_id and text are not read. The driver
    sees the histogram, a count per length.
    """
    with small_batches(docs.sparkSession):
        cut = staged(pieces(docs, sequence, end_id, ranks_path), "pieces")
    counts = staged(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length = {length: np.array(ranges, dtype=np.int64)
                 for length, ranges in places(best_fit(histogram, sequence)).items()}
    shift = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    shifts = counts.select("length", "part", shift.alias("shift"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        first, offset = np.zeros((2, len(rank)), dtype=np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for one in np.unique(lengths):
            at, ranges = lengths == one, by_length[int(one)]
            own = ranges[np.searchsorted(ranges[:, 0], ranks[at], side="right") - 1]
            first[at] = own[:, 1] + ranks[at] - own[:, 0]
            offset[at] = own[:, 2]
        return pd.DataFrame({"sequence_id": first, "offset": offset})

    placed = cut.join(shifts, ["length", "part"]).withColumn(
        "place", place("length", F.col("number") + F.col("shift")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
