"""Removal of byte strings that an earlier document has, by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document of smaller doc_id.
Suffixes of a whole corpus do not fit one array, so they are dealt out by content: in every window
of ``LENGTH`` bytes the smallest hash of its ``GRAM``-byte grams is its anchor. Equal windows have
equal anchors, and windows that follow each other with the same anchor form a segment, a string of
up to ``LENGTH + LENGTH - GRAM`` bytes.

1. Whole copies of a text are told by their SHA-256; all but the first are removed entirely and need
   no search.
2. An anchor that one document alone has cannot matter; counting anchors leaves the others. For that
   the first ``PREFIX`` bits of an anchor do: two anchors that share them only stay in the search.
3. Occurrences of the remaining segments are numbers (anchor, fingerprint, document, place). Where an
   anchor has one segment only, all its windows have the segment's first document. Of anchors with
   several, the bytes of each different segment are fetched once, from its first document.
4. Segments are dealt by anchor. Each task sorts the suffixes of a few hundred kilobytes of segments at a
   time in two stages and reads the least document of every window from neighbours with common prefixes.
   Anchors with more than ``HOT`` different segments are not gathered: their segments are cut in two at
   the anchor's place and dealt by the bytes around it as well. Where that still leaves more than
   ``HOT``, windows are grouped one by one instead.
5. Occurrences meet their segment's result and give spans, spans meet the texts.

Every step's shuffle files go when it is written, its inputs when nothing reads them any more; texts meet
places, and occurrences results, in ``PARTS`` rounds, so that a round's shuffle is a part of the whole;
below ``ROUND_BYTES`` of text in one.

All removals are judged on the input. Anchors and segments are told by 64-bit hashes each; a wrong
match needs both to collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.bitmap import among, bitmap, marked, maybe_in, without
from pulsegrid.llm.common import bound_batches, discard, released
from pulsegrid.llm.shingles import mixed
from pulsegrid.llm.suffix_array import least_runs

LENGTH, GRAM = 50, 20
HOT = 4096
TASK_BYTES = 1 << 18  # of segments in one suffix array; what fits the processor's cache sorts faster
LOG2_BITS = 27  # of the anchor filter: 16 MB
PIECE = 1 << 19  # bytes of text looked at together
PARTS, ROUND_BYTES = 4, 1 << 28
BUCKET, PREFIX = 12, 52  # bits of an anchor that say where it is counted, and that are counted
HALF = 16  # windows that start so far before the anchor or farther are the left part of a segment
_U = np.uint64
_BASE = 0xC2B2AE3D27D4EB4F  # odd
_LOW = _U((1 << 20) - 1)
_tables: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _tables:
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(PIECE + 1, factor, dtype=_U)
            steps[0] = 1
            _tables.append(np.cumprod(steps))
    return _tables


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def segments_of(piece: bytes, doc_ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: the text's number, the segment's start in the piece, its length, its
    anchor's hash and its own hash."""
    n = len(piece)
    windows = n - LENGTH + 1
    if windows <= 0:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, _U, _U))
    power, inverse = _powers()
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum((np.frombuffer(piece, dtype=np.uint8).astype(_U) + _U(1)) * power[:n], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1])
    # hash and place in one number: the smallest is the leftmost of the smallest hashes
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=_U)
    span, width = LENGTH - GRAM + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    place = (least & _LOW).astype(np.int64)
    owner = np.searchsorted(doc_ends, np.arange(windows), side="right")
    whole = np.arange(windows) + LENGTH <= doc_ends[np.minimum(owner, len(doc_ends) - 1)]
    new = np.ones(windows, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [windows]]) - 1
    keep = whole[first]
    first, last = first[keep], last[keep]
    ends = last + LENGTH
    own = mixed((sums[ends] - sums[first]) * inverse[first] + (ends - first).astype(_U) * _U(0x9E3779B97F4A7C15))
    return owner[first], first, ends - first, grams[place[first]], own


def batch_segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """``segments_of`` for any texts, with the row of the text and the place in the whole text; texts
    longer than a piece go by pieces that overlap by a window less one byte."""
    group: list[bytes] = []
    rows: list[int] = []
    size = 0

    def out() -> Iterator[tuple[np.ndarray, ...]]:
        ends = np.cumsum([len(t) for t in group])
        owner, start, *rest = segments_of(b"".join(group), ends)
        if len(owner):
            yield (np.array(rows)[owner], start - (ends - [len(t) for t in group])[owner], *rest)

    for row, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if group and size + len(text) > PIECE:
            yield from out()
            group, rows, size = [], [], 0
        if len(text) > PIECE:
            for at in range(0, len(text) - LENGTH + 1, PIECE - LENGTH + 1):
                part = text[at:at + PIECE]
                owner, start, *rest = segments_of(part, np.array([len(part)]))
                yield (owner + row, start + at, *rest)
        else:
            group.append(text)
            rows.append(row)
            size += len(text)
    if group:
        yield from out()


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def anchors(texts: DataFrame) -> DataFrame:
    """``bucket, anchors``: the first ``PREFIX`` bits of the anchors of every batch of texts, five bytes
    each behind those of the bucket; once per text, and twice per batch at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, anchor) for row, _, _, anchor, _ in batch_segments(_bytes(batch.column("text")))]
            if not found:
                continue
            row, anchor = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(anchor, kind="stable")  # rows are in order already
            row, anchor = row[order], anchor[order]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
            anchor = anchor[new]
            few = np.ones(len(anchor), dtype=bool)
            few[2:] = anchor[2:] != anchor[:-2]
            anchor = anchor[few]
            ends = np.searchsorted(anchor >> _U(64 - BUCKET), np.arange((1 << BUCKET) + 1, dtype=_U))
            some = np.flatnonzero(np.diff(ends))
            offsets = (np.append(0, ends[some + 1]) * 5).astype(np.int32)
            data = (anchor >> _U(64 - PREFIX)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            blobs = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(some), blobs], names=["bucket", "anchors"])

    return texts.select("text").mapInArrow(run, "bucket long, anchors binary")


def _of_several(bucket: int, blobs: list[bytes]) -> np.ndarray:
    """Of a bucket's anchors those that are there more than once, the bits behind ``PREFIX`` as zeros."""
    data = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, 5)
    wide = np.zeros((len(data), 8), dtype=np.uint8)
    wide[:, :5] = data
    rest = np.sort(wide.view(np.uint64).ravel())
    rest = np.unique(rest[1:][rest[1:] == rest[:-1]]) & _U((1 << (PREFIX - BUCKET)) - 1)
    return (_U(bucket) << _U(64 - BUCKET)) | (rest << _U(64 - PREFIX))


def shared_anchors(texts: DataFrame) -> DataFrame:
    """``anchor``: the anchors that several texts have, as far as their first ``PREFIX`` bits tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = -1, []
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]])) if len(buckets) else []
            out = []
            for low, high in zip(edges[:-1], edges[1:]):
                if buckets[low] != at:
                    if held:
                        out.append(_of_several(at, held))
                    at, held = int(buckets[low]), []
                held += batch.column("anchors").slice(low, high - low).to_pylist()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(out)))], names=["anchor"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(_signed(_of_several(at, held)))], names=["anchor"])

    return anchors(texts).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "anchor long")


def occurrences(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """``anchor, segment, doc_id, start, length`` of all segments whose anchor is one of ``shared``."""
    words = texts.sparkSession.sparkContext.broadcast(bitmap(shared, "anchor", LOG2_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, start, length, anchor, own in batch_segments(_bytes(batch.column("text"))):
                keep = maybe_in(words.value, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep]) for x in (_signed(anchor), _signed(own), ids[row], start, length)],
                    names=["anchor", "segment", "doc_id", "start", "length"])

    found = texts.select("doc_id", "text").mapInArrow(
        run, "anchor long, segment long, doc_id long, start long, length long")
    counted = F.col("anchor").bitwiseAND(F.lit(-1 << (64 - PREFIX)))
    return found.join(shared.select(F.col("anchor").alias("_counted")), counted == F.col("_counted"), "left_semi")


def first_places(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``anchor, segment, x``: each different segment and its first document, start and length; and
    ``anchor, many`` of the anchors that have several segments: whether there are more than ``HOT``. A
    segment that is the only one of its anchor cannot share a window with any other."""
    first = released(found.groupBy("anchor", "segment").agg(F.min(F.struct("doc_id", "start", "length")).alias("x")), "first")
    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return first, released(several.select("anchor", (F.col("n") > HOT).alias("many")), "several")


def _part(column: str, number: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), column), F.lit(parts)) == number if parts > 1 else F.lit(True)


def in_parts(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """All rows of the frames, which are written one after the other."""
    return reduce(DataFrame.unionAll, [released(frame, name) for frame in frames])


def segment_bytes(texts: DataFrame, first: DataFrame, parts: int) -> DataFrame:
    """``anchor, segment, many, doc_id, bytes``: each segment, from its first document. Reads ``first``
    once."""
    places = released(first.groupBy("x.doc_id").agg(F.collect_list(
        F.struct("anchor", "segment", "x.start", "x.length", "many")).alias("places")), "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            row = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
            flat = places.flatten()
            start, length = flat.field(2).to_numpy(), flat.field(3).to_numpy()
            texts = _bytes(batch.column("text"))
            cut = [texts[r][s:s + n] for r, s, n in zip(row, start, length)]
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), flat.field(1), flat.field(4), batch.column("doc_id").take(pa.array(row)),
                 pa.array(cut, pa.binary())], names=["anchor", "segment", "many", "doc_id", "bytes"])

    tested = marked(texts, places, "doc_id")

    def part(number: int) -> DataFrame:
        own = _part("doc_id", number, parts)
        met = tested.where(own).where("_maybe").join(places.where(own), "doc_id")
        return met.select("doc_id", "text", "places").mapInArrow(
            run, "anchor long, segment long, many boolean, doc_id long, bytes binary")

    out = in_parts(map(part, range(parts)), "segments")
    discard(places)
    return out


RUNS = "array<struct<shift:long,windows:long,least:long>>"
RESULT = f"anchor long, segment long, runs {RUNS}"
STRINGS = "key long, anchor long, segment long, doc_id long, shift long, bytes binary"


def anchor_places(segments: list[bytes]) -> np.ndarray:
    """Where the anchor of each segment is: at the leftmost of the smallest hashes of its first window."""
    power, inverse = _powers()
    first = np.frombuffer(b"".join(s[:LENGTH] for s in segments), dtype=np.uint8).reshape(-1, LENGTH)
    sums = np.zeros((len(segments), LENGTH + 1), dtype=_U)
    np.cumsum((first.astype(_U) + _U(1)) * power[:LENGTH], axis=1, out=sums[:, 1:])
    grams = mixed((sums[:, GRAM:] - sums[:, :-GRAM]) * inverse[:LENGTH - GRAM + 1])
    return np.argmin(grams & ~_LOW, axis=1)


def halves(anchor: int, data: bytes, place: int) -> Iterator[tuple[int, int, bytes]]:
    """Key, first window and bytes of the two parts of a segment, as far as there are any: the windows
    that start ``HALF`` or more bytes before the anchor, which all have those bytes, and the others,
    which all have the bytes behind it up to the end of the window that starts ``HALF - 1`` before it.
    Equal windows have equal keys."""
    last, edge = len(data) - LENGTH, place - HALF
    if edge >= 0:
        yield _key(anchor, 0, data[edge:place + GRAM]), 0, data[:min(edge, last) + LENGTH]
    if last > edge:
        yield _key(anchor, 1, data[place:place - HALF + 1 + LENGTH]), max(edge + 1, 0), data[max(edge + 1, 0):]


def _key(anchor: int, side: int, around: bytes) -> int:
    digest = hashlib.blake2b(around, digest_size=8, key=b"%d %d" % (side, anchor)).digest()
    return int.from_bytes(digest, "little", signed=True)


def cut_in_two(segments: DataFrame) -> DataFrame:
    """``STRINGS``: the parts of segments; ``shift`` is the place of a part in its segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, data = batch.column("anchor").to_pylist(), batch.column("bytes").to_pylist()
            parts = [(i, *x) for i, place in enumerate(anchor_places(data).tolist()) for x in halves(anchor[i], data[i], place)]
            row, key, shift, cut = zip(*parts)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), *(batch.column(c).take(row) for c in ("anchor", "segment", "doc_id")),
                 pa.array(shift, pa.int64()), pa.array(cut, pa.binary())],
                names=["key", "anchor", "segment", "doc_id", "shift", "bytes"])

    return segments.select("anchor", "segment", "doc_id", "bytes").mapInArrow(run, STRINGS)


def least_documents(segments: DataFrame) -> DataFrame:
    """``anchor, segment, runs``: for every segment, as runs of windows, the least doc_id that has
    them: ``windows`` of them from place ``shift`` on. Of anchors with many segments there may be several
    rows per segment. ``segments`` are read and gone."""

    def flush(rows: pd.DataFrame) -> pa.RecordBatch:
        own, *run = least_runs(rows["bytes"].tolist(), rows["doc_id"].to_numpy(), LENGTH)
        run[0] += rows["shift"].to_numpy()[own]
        ends = np.searchsorted(own, np.arange(len(rows) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(x) for x in run], names=["shift", "windows", "least"])
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["anchor"]), pa.array(rows["segment"]), pa.ListArray.from_arrays(pa.array(ends), values)],
            names=["anchor", "segment", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            # whole keys only: what comes after the last change waits for the next batch
            rows = pd.concat([*held, batch.to_pandas()]) if held else batch.to_pandas()
            held = [rows]
            sizes = rows["bytes"].map(len).to_numpy().cumsum()
            if len(rows) and sizes[-1] >= TASK_BYTES:
                key = rows["key"].to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                at, last = 0, starts[-1]
                while at < last:
                    # to the first change of key behind the next ``TASK_BYTES``
                    reach = np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TASK_BYTES)
                    upto = min(starts[min(np.searchsorted(starts, max(reach, at + 1)), len(starts) - 1)], last)
                    yield flush(rows.iloc[at:upto])
                    at = upto
                held = [rows.iloc[last:]]
        if held and len(held[0]):
            yield flush(held[0])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for anchor, segment, doc_id, shift, data in zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "segment", "doc_id", "shift", "bytes"))):
                for at in range(len(data) - LENGTH + 1):
                    digest = hashlib.blake2b(data[at:at + LENGTH], digest_size=16).digest()
                    for column, value in zip(out, (digest, anchor, segment, doc_id, shift + at)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), *(pa.array(c, pa.int64()) for c in out[1:])],
                                             names=["window", "anchor", "segment", "doc_id", "shift"])

    usual = segments.where("NOT many").select(
        F.col("anchor").alias("key"), "anchor", "segment", "doc_id", F.lit(0).cast("long").alias("shift"), "bytes")
    parts = released(cut_in_two(segments.where("many")), "halves")
    crowded = released(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("key"), "crowded")
    to_sort = usual.unionAll(parts.join(crowded, "key", "left_anti")).repartition("key").sortWithinPartitions("key")
    sorted_out = released(to_sort.mapInArrow(run, RESULT), "sorted")
    single = released(parts.join(crowded, "key", "left_semi").select(*parts.columns).mapInArrow(
        windows, "window binary, anchor long, segment long, doc_id long, shift long"), "windows")
    discard(segments, parts, crowded)
    first = released(single.groupBy("window").agg(F.min("doc_id").alias("least")), "windows")
    one = F.struct("shift", F.lit(1).cast("long").alias("windows"), "least")
    one_by_one = released(single.join(first, "window").groupBy("anchor", "segment").agg(F.collect_list(one).alias("runs")), "single")
    discard(single, first)
    return sorted_out.unionAll(one_by_one)


def spans_of(found: DataFrame, least: DataFrame, parts: int) -> DataFrame:
    """``doc_id, runs``: the runs of bytes (from, to) to remove of each document, in order; they may
    overlap."""
    low = F.col("start") + F.col("run.shift")

    def part(number: int) -> DataFrame:
        own = _part("anchor", number, parts)
        met = found.where(own).join(least.where(own), ["anchor", "segment"]).select(
            "doc_id", "start", F.explode("runs").alias("run"))
        return met.where(F.col("run.least") < F.col("doc_id")).groupBy("doc_id").agg(F.collect_set(F.struct(
            low.alias("low"), (low + F.col("run.windows") + (LENGTH - 1)).alias("high"))).alias("runs"))

    spans = in_parts(map(part, range(parts)), "spans")
    out = released(spans.groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs")), "runs")
    discard(spans)
    return out


def judged(docs: DataFrame) -> DataFrame:
    """Narrow rows ``doc_id, sha, bytes, state``: state is ``copy`` for a text that a smaller doc_id
    has as well, ``open`` for one that has to be searched, ``still`` for one that stays as it is
    (shorter than a window, or without a usable id)."""
    whole = F.coalesce("text", F.lit("")).cast("binary")
    rows = released(docs.select(F.col("doc_id").cast("long"), F.sha2(whole, 256).alias("sha"),
                              F.octet_length(whole).cast("long").alias("bytes")), "texts")
    first = rows.where("doc_id IS NOT NULL").groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    several = rows.groupBy("doc_id").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a != b")
    copies = released(first.select("sha", "first"), "copies")
    clashes = released(several.select("doc_id", F.lit(True).alias("clash")), "clashes")
    state = F.when((F.col("bytes") < LENGTH) | F.col("doc_id").isNull() | F.col("clash"), "still").when(
        F.col("doc_id") > F.col("first"), "copy").otherwise("open")
    out = released(rows.join(clashes, "doc_id", "left").join(copies, "sha", "left")
                   .withColumn("state", state).drop("clash", "first"), "judged")
    discard(rows, copies, clashes)
    return out


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``judged`` rows, and ``doc_id, runs`` of the open documents that lose bytes."""
    bound_batches(docs.sparkSession)
    states = judged(docs)
    size = states.where("state = 'open'").agg(F.sum("bytes")).first()[0] or 0
    parts = PARTS if size > ROUND_BYTES else 1
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    # copies and short texts stay out of the search
    out = released(states.where("state != 'open' AND doc_id IS NOT NULL").select("doc_id").distinct(), "out")
    searched = without(texts, out)
    twice = released(states.where("state = 'open'").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select("doc_id"), "twice")
    if not twice.isEmpty():  # equal rows of a document, which are one to the search
        searched = without(searched, twice).unionAll(among(searched, twice).dropDuplicates(["doc_id"]))
    shared = released(shared_anchors(searched), "anchors")
    found = released(occurrences(searched, shared), "occurrences")
    discard(shared, out, twice)
    first, several = first_places(found)
    whole = F.struct(F.lit(0).cast("long").alias("shift"), (F.col("x.length") - (LENGTH - 1)).alias("windows"),
                     F.col("x.doc_id").alias("least"))
    same = released(first.join(several, "anchor", "left_anti").select("anchor", "segment", F.array(whole).alias("runs")), "same")
    segments = segment_bytes(texts, first.join(several, "anchor"), parts)
    discard(first, several)
    least = least_documents(segments).unionAll(same)
    runs = spans_of(found, least, parts)
    discard(found, least)
    return states, runs


def kept(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went and in how many runs; runs are in order and may
    overlap or touch."""
    parts, at, spans, end = [], 0, 0, -1
    for low, high in runs:
        if low > end:
            spans += 1
            parts.append(text[at:low])
        end = max(end, high)
        at = end
    parts.append(text[at:])
    left = b"".join(parts)
    return left, len(text) - len(left), spans


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    Null text counts as empty. Texts are searched whole. Equal rows of one doc_id are one document;
    where rows of one doc_id differ in text, and where it is null, the rows stay as they are and
    are not compared with others. An empty table gives no rows; other columns are not read.
    """
    states, runs = removals(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [kept(text, [(r["low"], r["high"]) for r in own])
                    for text, own in zip(_bytes(batch.column("text")), batch.column("runs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                 pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string())],
                names=["doc_id", "removed", "runs", "left"])

    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    changed = released(among(texts, runs).select("doc_id", "text", "runs").mapInArrow(
        cut, "doc_id long, removed long, runs long, left string").distinct(), "changed")
    copy = F.col("state") == "copy"
    return states.join(changed, "doc_id", "left").select(
        "doc_id", F.col("bytes").alias("n_bytes"),
        F.when(copy, F.col("bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` (a character cut in part goes whole)
    and ``n_chars`` set anew where it is there; documents of which nothing is left are gone."""
    states, runs = removals(docs)
    copies = released(states.where("state = 'copy'").select("doc_id").distinct(), "copies")
    rest = without(docs, copies)
    joined = rest.join(runs.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left").drop("_id")

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else kept(t.encode(), [(x["low"], x["high"]) for x in r])[0].decode("utf-8", "ignore")
                          for t, r in zip(text, runs)], dtype=object)

    changed = F.col("runs").isNotNull()
    shorter = joined.withColumn("_new", F.when(changed, cut("text", "runs")).otherwise(F.col("text")))
    shorter = shorter.where(~changed | (F.col("_new") != "")).withColumn("text", F.col("_new"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        shorter = shorter.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return shorter.select(*docs.columns)
