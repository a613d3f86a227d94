"""Filter interaction audit: what each filter removes, alone and in every order of the filters.

A byte transducer reads every text once. Its two states (between words, in a word) and the 256 bytes
index a table that tells the next state and what the byte means: a word begins or ends, a capital, a
symbol, a code point. The next state depends on the byte alone, so a block of bytes is looked up at
once and the state is handed from block to block, over whole texts of any length. Word spans go into
an open-addressing hash table per group of documents, which compares lengths and bytes before it
takes two spans for the same word.

Tasks send a few numbers and a digest per document. Copies are found by digest and length with
aggregates that combine ahead of the shuffle; everything after works on counts per part, set of
failed filters and labels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import small_batches, staged

BLOCK, GROUP = 1 << 20, 1 << 19  # bytes looked up at once; bytes of documents that share a table
LONG = 256                       # longer words are hashed and compared one by one
BEGINS, ENDS, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16
SYMBOLS = b"#$%&*|"
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")
LETTERS = "ABCDE"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The next state by byte, and the output by state (0 between words, 1 in a word) and byte."""
    byte = np.arange(256)
    after = (~((byte == 32) | ((byte >= 9) & (byte <= 13)))).astype(np.uint8)
    means = (CAPITAL * ((byte >= 65) & (byte <= 90)) + SYMBOL * np.isin(byte, list(SYMBOLS))
             + POINT * ((byte & 0xC0) != 0x80))
    out = np.stack([means + BEGINS * after, means + ENDS * (1 - after)])
    return after, out.astype(np.uint8).ravel()


NEXT, OUT = _tables()
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
HALF = np.uint64(32)


class WordTable:
    """Distinct word spans of several documents over one buffer."""

    def __init__(self, raw: np.ndarray):
        """``raw`` ends with eight bytes that belong to no word."""
        self.raw = raw
        self.lanes = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        self.slots = np.full(1024, -1, dtype=np.int32)
        self.size = 0
        # start, length, document and hash of every entry
        self.entries = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int32, np.uint64)]

    def hashes(self, start: np.ndarray, length: np.ndarray, document: np.ndarray) -> np.ndarray:
        h = length.astype(np.uint64) * MIX ^ document.astype(np.uint64) * SPREAD
        left = np.flatnonzero(length <= LONG)
        place = 0
        while len(left):
            lane = self.lanes[start[left] + place] & MASKS[np.minimum(length[left] - place, 8)]
            x = (h[left] ^ lane) * MIX
            h[left] = x ^ x >> HALF
            place += 8
            left = left[length[left] > place]
        for at in np.flatnonzero(length > LONG):
            word = self.raw[start[at]:start[at] + length[at]]
            h[at] ^= np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), dtype=np.uint64)[0]
        x = h * SPREAD
        return x ^ x >> HALF

    def same(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether entries are the same word of the same document, by their bytes."""
        start, length, document, h = self.entries
        equal = (h[one] == h[other]) & (length[one] == length[other]) & (document[one] == document[other])
        left = np.flatnonzero(equal & (length[one] <= LONG) & (one != other))
        place = 0
        while len(left):
            a, b = start[one[left]] + place, start[other[left]] + place
            mask = MASKS[np.minimum(length[one[left]] - place, 8)]
            differ = ((self.lanes[a] ^ self.lanes[b]) & mask) != 0
            equal[left[differ]] = False
            place += 8
            left = left[~differ & (length[one[left]] > place)]
        for at in np.flatnonzero(equal & (length[one] > LONG) & (one != other)):
            a, b, n = start[one[at]], start[other[at]], length[one[at]]
            equal[at] = np.array_equal(self.raw[a:a + n], self.raw[b:b + n])
        return equal

    def insert(self, start: np.ndarray, length: np.ndarray, document: np.ndarray) -> None:
        n, base = len(start), self.size
        added = [start, length, document, self.hashes(start, length, document)]
        self.entries = [np.concatenate([old[:base], new.astype(old.dtype)]) for old, new in zip(self.entries, added)]
        if 2 * (base + n) > len(self.slots):
            self.slots = np.full(1 << int(4 * (base + n)).bit_length(), -1, dtype=np.int32)
            self._place(np.arange(base))
        found, at = self._place(np.arange(base, base + n))
        # winners move together; their slots follow
        self.slots[at] = base + np.arange(len(found))
        self.entries = [np.concatenate([x[:base], x[found]]) for x in self.entries]
        self.size = base + len(found)

    def _place(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Give every word a slot unless the table has it; the new ones, in order, and their slots."""
        last = np.int64(len(self.slots) - 1)
        slot = (self.entries[3][words] & np.uint64(last)).astype(np.int64)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(words):
            free = self.slots[slot] < 0
            # of several words for one free slot the first is written last
            self.slots[slot[free][::-1]] = words[free][::-1]
            there = self.slots[slot]
            new = there == words
            taken.append((words[new], slot[new]))
            on = ~self.same(there, words)
            words, slot = words[on], (slot[on] + 1) & last
        found = [np.concatenate(x) if taken else np.zeros(0, np.int64) for x in (zip(*taken) if taken else ((), ()))]
        order = np.argsort(found[0], kind="stable")
        return found[0][order], found[1][order]


def read_texts(raw: np.ndarray, bounds: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """``COUNTS`` as columns for the texts ``raw[bounds[i]:bounds[i + 1]]``, which follow each other;
    ``raw`` goes on for eight bytes at least behind the last."""
    n = len(bounds) - 1
    counts = np.zeros((n, len(COUNTS)), dtype=np.int64)
    table = WordTable(raw)
    state, opened = 0, np.zeros(0, dtype=np.int64)
    for low in range(int(bounds[0]), int(bounds[-1]), block):
        high = min(low + block, int(bounds[-1]))
        bytes_ = raw[low:high]
        before = np.empty(high - low, dtype=np.uint8)
        before[0], before[1:] = state, NEXT[bytes_[:-1]]
        state = int(NEXT[bytes_[-1]])
        fresh = np.unique(bounds[(bounds >= low) & (bounds < high)]) - low
        broken = fresh[before[fresh] == 1] + low  # words that the end of their text ends
        before[fresh] = 0
        out = OUT[before.astype(np.uint16) << 8 | bytes_]
        begin = np.concatenate([opened, np.flatnonzero(out & BEGINS) + low])
        end = np.sort(np.concatenate([np.flatnonzero(out & ENDS) + low, broken]))
        if high == bounds[-1] and state:
            end = np.append(end, high)
        begin, opened = begin[:len(end)], begin[len(end):]
        if len(begin):
            document = np.searchsorted(bounds, begin, side="right") - 1
            counts[:, 0] += np.bincount(document, minlength=n)
            table.insert(begin, end - begin, document)
        first, last = np.clip(bounds[:-1], low, high) - low, np.clip(bounds[1:], low, high) - low
        for column, flag in ((2, CAPITAL), (3, SYMBOL), (4, POINT)):
            upto = np.concatenate([[0], np.cumsum((out & flag) != 0, dtype=np.int64)])
            counts[:, column] += upto[last] - upto[first]
    counts[:, 1] = np.bincount(table.entries[2][:table.size], minlength=n)
    return counts


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, digest, n_bytes`` and ``COUNTS`` per row: words, distinct words, capitals A-Z,
    symbols, code points of the whole text; null text counts as empty."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            size = int(offsets[-1] - offsets[0]) if len(texts) else 0
            raw = np.zeros(size + 8, dtype=np.uint8)
            if size:
                raw[:size] = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
            bounds = offsets - offsets[0] if len(texts) else np.zeros(1, dtype=np.int64)
            found, at = [], 0
            while at < len(texts):
                upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + GROUP, side="right")) - 1)
                found.append(read_texts(raw, bounds[at:upto + 1]))
                at = upto
            counts = np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *found])
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(digests, pa.binary()),
                 pa.array(np.diff(bounds), pa.int64()), *(pa.array(c) for c in counts.T.copy())],
                names=["doc_id", "lang", "digest", "n_bytes", *COUNTS])

    schema = f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, digest binary, n_bytes long, " + ", ".join(
        f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "lang", "text").mapInArrow(read, schema)


def failures(counted: DataFrame, labels: DataFrame, least_words: int = 200, least_distinct: int = 50,
             most_capitals: int = 3) -> DataFrame:
    """``part, failed, good, toxic, n``: documents by language, failed filters (bit i for letter i)
    and labels.

    A text repeats a smaller id's if digest (SHA-256) and length are those of a row with a smaller
    doc_id, wherever that row is and whatever becomes of it; a row without an id neither is a copy
    nor has one. A document is good or toxic if any of its label rows says so.
    """
    failed = ((F.col("n_words") < least_words).cast("int")
              + F.when(100 * F.col("n_distinct") < least_distinct * F.col("n_words"), 2).otherwise(0)
              + F.when(100 * F.col("n_capitals") > most_capitals * F.col("n_points"), 4).otherwise(0)
              + F.when(F.col("n_symbols") > 0, 8).otherwise(0))
    rows = counted.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "digest", "n_bytes",
                          failed.alias("failed"))
    once = rows.groupBy("doc_id", "digest", "n_bytes", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))))
    marked = once.join(known, "doc_id", "left").fillna(False, ["good", "toxic"])
    text = ["digest", "n_bytes"]
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = marked.groupBy(*text, "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), least.alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = marked.groupBy(*text).agg(F.min("doc_id").alias("first"))
    original = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = groups.join(first, text).select("part", "good", "toxic", F.explode(F.array(
        F.struct("failed", original.alias("n")),
        F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - original).alias("n")))).alias("x"))
    return (split.select("part", "good", "toxic", "x.failed", "x.n").where("n > 0")
            .groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n")))


def by_order(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The audit of every order of the filters from counts by part, failed filters and labels.

    A step depends on its filter and on the set of those before it, not on their order, so counts
    are made once per such pair and orders look them up. Shapley values follow in closed form: a
    document that fails k filters is removed by each of them in an equal share of all orders."""
    k = len(letters)
    pairs = [(earlier, f) for f in range(k) for earlier in range(1 << k) if not earlier >> f & 1]
    pair = F.array(*(F.struct(F.lit(e).alias("earlier"), F.lit(1 << f).alias("own")) for e, f in pairs))
    met = cells.select("*", F.explode(pair).alias("pair")).select("*", "pair.*").drop("pair")
    fails, before = F.expr("failed & own != 0"), F.expr("failed & earlier != 0")
    removed = fails & ~before

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    share = F.when(fails, F.col("n") * F.expr(f"{factorial(k)} div bit_count(failed)"))
    counts = met.groupBy("part", "earlier", "own").agg(
        total(~fails & ~before).alias("kept"), total(removed).alias("removed"),
        total(fails & before).alias("redundant"), total(F.col("failed") == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"), total(removed & F.col("toxic")).alias("toxic_lost"),
        F.coalesce(F.sum(share), F.lit(0)).cast("long").alias("shapley"))
    steps = [("".join(letters[f] for f in order), step + 1, sum(1 << f for f in order[:step]), 1 << order[step])
             for order in permutations(range(k)) for step in range(k)]
    orders = cells.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, own int")
    return counts.join(orders, ["earlier", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per language (null: empty), order of the five filters and step: documents kept after the
    step, removed in it, ``redundant`` (failing its filter, removed before), ``unique_fails`` (failing
    no other), good and toxic documents removed in it, and the filter's removals over all orders.

    Null and empty texts fail the word count alone (and are copies of each other); texts are read
    whole, whatever their length or the length of a word; repeated rows count each time and are no
    copies of each other; see ``failures`` for rows without an id. An empty table gives no rows;
    columns other than doc_id, text, lang and the labels' quality and toxic are not read.
    """
    with small_batches(docs.sparkSession):
        counted = staged(with_counts(docs), "counted")
    return by_order(staged(failures(counted, labels), "failures"))
