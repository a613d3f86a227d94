"""Packing documents into sequences: shortest-pack-first over the length histogram.

A document's ids, with a closing id, are cut into full sequences and a rest. What is packed are the
lengths' counts, not the pieces: lengths go longest first, each onto the packs that hold least so
far (and still have room), and whole groups of equal packs move at once. The result is a table of
packing patterns with counts, whose size depends on the sequence length alone. Pieces find their
place by their rank among the pieces of the same length, so no step has all pieces of a length in
one task: ranks are counted per input partition and shifted by the counts of those before.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged

SEQUENCE = 1024
END_ID = 0
# added tokens of the tokenizers file: text is split at them first, whatever stands around them
ADDED = {"<|endoftext|>": 50256}
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"
# a unit that starts with the only space before it is tokenized alike on its own and in its text
NOT_SPLITTABLE = re.compile(r" \s|\s ")


class Ids:
    """Ids of texts as bytes of little-endian 32-bit numbers, with a memory of units seen.

    The vocabulary is read from a file of ranks, the fast form of the public 50k byte-level BPE;
    its ids are those of the ``tokenizers`` file of that name, added tokens included (tested). ``most`` bounds the memory:
    a full one is emptied, which changes the speed only.
    """

    def __init__(self, ranks_path: str, most: int = 400_000):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.coding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=ranks, special_tokens={})
        self.seen: dict[str, bytes] = {}
        self.most = most
        self.added = {token: np.array([i], dtype="<u4").tobytes() for token, i in ADDED.items()}
        self.split = re.compile(f"({'|'.join(map(re.escape, ADDED))})").split

    def encode(self, text: str) -> bytes:
        if any(token in text for token in ADDED):
            return b"".join(self.added.get(x) or self.between(x) for x in self.split(text))
        return self.between(text)

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if NOT_SPLITTABLE.search(text):
            return self.plain(text)
        units = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
        seen = self.seen
        out = []
        for unit in units:
            ids = seen.get(unit)
            if ids is None:
                ids = self.plain(unit)
                if len(unit) <= 64:
                    if len(seen) >= self.most:
                        seen.clear()
                    seen[unit] = ids
            out.append(ids)
        return b"".join(out)

    def forget(self) -> None:
        """Give the memory back: a worker process outlives the task, and its next one may be another
        job's."""
        self.seen.clear()
        pa.default_memory_pool().release_unused()

    def plain(self, text: str) -> bytes:
        return np.array(self.coding.encode_ordinary(text), dtype="<u4").tobytes()


_IDS: dict[str, Ids] = {}


def ids_of(ranks_path: str) -> Ids:
    """The worker process's own tokenizer."""
    if ranks_path not in _IDS:
        _IDS[ranks_path] = Ids(ranks_path)
    return _IDS[ranks_path]


def pieces(docs: DataFrame, sequence: int = SEQUENCE, ranks_path: str | None = None) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``, cut at every ``sequence``
    ids. Null text counts as empty: its document is the closing id alone."""
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ids_of(ranks_path)
        for batch in batches:
            owner, start, length, crc, total = [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = tokenizer.encode(text.as_py() or "") + end
                n = len(ids) // 4
                for at in range(0, n, sequence):
                    part = ids[4 * at:4 * (at + sequence)]
                    owner.append(row)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        tokenizer.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {PIECES}")


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, in the order placed) and how many packs follow each.

    ``groups[room]`` holds the patterns whose packs have that much room left. For every length,
    longest first, the packs with most room take one each; packs are opened when none has room.
    """
    groups: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(sequence + 1)]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []
        for room in range(sequence, length - 1, -1):
            while groups[room] and left:
                pattern, count = groups[room].pop()
                used = min(count, left)
                if used < count:
                    groups[room].append((pattern, count - used))
                placed.append((room - length, (*pattern, length), used))
                left -= used
            if not left:
                break
        if left:
            # new packs take one of this length; what still fits beside it goes on in the next turn
            fits = sequence // length
            packs = left // fits
            if packs:
                placed.append((sequence - fits * length, (length,) * fits, packs))
            if left % fits:
                n = left % fits
                placed.append((sequence - n * length, (length,) * n, 1))
        for room, pattern, count in placed:
            groups[room].append((pattern, count))
    return [x for group in groups for x in group]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length the ranges of ranks: (first rank, sequence of that rank, offset in a sequence)."""
    used: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    sequence_id = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            out.setdefault(length, []).append((rank, sequence_id, offset))
            used[length] = rank + count
            offset += length
        sequence_id += count
    return out


def pack(docs: DataFrame, sequence: int = SEQUENCE, ranks_path: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

    Every id lies in one piece; a sequence's pieces follow each other without a gap from offset 0
    and fill ``sequence`` at most. Null and empty texts are one-id documents; repeated rows and
    repeated or null doc_ids are packed like any others; an empty table gives no rows; columns other
    than doc_id and text are not read. What the driver sees is the histogram: a count per length.
    """
    cut = staged(pieces(docs, sequence, ranks_path).withColumn("part", F.spark_partition_id()), "pieces")
    counts = staged(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length = places(shortest_pack_first(histogram, sequence))
    shift = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    shifts = counts.select("length", "part", shift.alias("shift"))
    order = W.partitionBy("length", "part").orderBy("doc_id", "start")
    ranked = (cut.withColumn("rank", F.row_number().over(order) - 1).join(shifts, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("shift")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        first, last = np.zeros((2, len(rank)), dtype=np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for one in np.unique(lengths):
            ranges = np.array(by_length[int(one)], dtype=np.int64)
            at = lengths == one
            own = ranges[np.searchsorted(ranges[:, 0], ranks[at], side="right") - 1]
            first[at] = own[:, 1] + ranks[at] - own[:, 0]
            last[at] = own[:, 2]
        return pd.DataFrame({"sequence_id": first, "offset": last})

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         "place.sequence_id", "place.offset")
