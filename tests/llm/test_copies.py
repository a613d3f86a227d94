"""Near copies, repeated byte strings and the pipeline."""

import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pulsegrid.llm import graph, jaccard_join, queries, shingles, suffix_array, suffix_dedup
from pulsegrid.llm.bitmap import bitmap, maybe_in, without
from pulsegrid.llm.common import table
from tests.llm.cases import awkward, frame, prose
from tests.llm.test_pages_and_packing import check_pieces, plain_targets

FOLDER = "/root/testdata/sf0.001"
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


# --- plain versions ---------------------------------------------------------------------
def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    """Set size and component per (doc_id, text) row, all pairs compared."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(named):
        for j, t in named[:k]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    out = []
    for i, s in sets:
        if i is not None:
            out.append((i, len(s), find(i) if s else i))
        else:
            equal = [find(j) for j, t in named if t == s]
            out.append((None, len(s), min(equal) if s and equal else None))
    return sorted(out, key=repr)


def plain_removal(rows):
    """Kept bytes, bytes removed and runs per (doc_id, text), smaller doc_ids first."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        covered, own = bytearray(len(data)), set()
        for k in range(len(data) - 49):
            window = data[k:k + 50]
            own.add(window)
            if window in seen:
                covered[k:k + 50] = b"\1" * 50
        seen |= own
        runs = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out[i] = (bytes(b for b, c in zip(data, covered) if not c), sum(covered), runs)
    return out


# --- near copies ------------------------------------------------------------------------
@pytest.mark.parametrize("segment", [shingles.SEGMENT, 64])
def test_shingle_sets_are_those_of_the_words(monkeypatch, segment):
    texts = [r[1] for r in awkward() if len(r[1] or "") < 20_000 and "x" * 99 not in (r[1] or "")]
    whole = [s.tolist() for s in shingles.shingle_sets(texts)]
    assert [len(s) for s in whole] == [len(shingle_set(t)) for t in texts]
    monkeypatch.setattr(shingles, "SEGMENT", segment)
    monkeypatch.setattr(shingles, "_powers", [])
    assert [s.tolist() for s in shingles.shingle_sets(texts)] == whole


def test_components_of_a_graph(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in joined)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_stops_none_of_the_set(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) AS h")
    words = bitmap(keys, "h", 16)
    own = np.array([r.h for r in keys.collect()]).view(np.uint64)
    assert maybe_in(words, own).all() and maybe_in(words, np.arange(100_000, dtype=np.uint64) << np.uint64(47)).mean() < 0.05
    left = without(spark.range(1000).withColumnRenamed("id", "doc_id"), spark.range(500).withColumnRenamed("id", "doc_id"))
    assert sorted(r.doc_id for r in left.collect()) == list(range(500, 1000))


def test_near_copies_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    assert sorted(map(tuple, queries.op8_jaccard_join(spark, FOLDER).collect()), key=repr) == plain_components(rows)


def family(rng, base, i):
    """A text some way off ``base``: similarities lie on both sides of the limit."""
    words = list(base)
    for _ in range(rng.randrange(0, 4)):
        words[rng.randrange(len(words))] = f"edit{i}x{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_copies_awkward_rows_and_large_blocks(spark, monkeypatch):
    # every block counts as large, cells and leaves are tiny, the first round links next to nothing
    for name, value in (("SMALL", 2), ("CELL", 8), ("LEAF", 3), ("ANCHORS", 1)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(6)
    bases = [prose(50 + k, 60).split() for k in range(2)]
    rows = [*awkward(), *((1000 + i, family(rng, bases[i % 2], i), "en", "a", 1) for i in range(90))]
    got = jaccard_join.linked_components(frame(spark, rows, extra=True)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components([r[:2] for r in rows])
    assert jaccard_join.linked_components(frame(spark).limit(0)).count() == 0
    kept = jaccard_join.keep_one(frame(spark, rows))
    gone = {r[0] for r in got if r[1] and r[0] is not None and r[2] != r[0]}
    assert sorted(map(repr, kept.select("doc_id").collect())) == sorted(
        f"Row(doc_id={r[0]})" for r in rows if r[0] not in gone)


# --- repeated strings -------------------------------------------------------------------
def test_two_stage_sorting_is_sorting():
    rng = random.Random(7)
    for trial in range(120):
        letters = b"ab\xff\x00"[:rng.randint(1, 4)]
        segments = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(1, 20))]
        text, _ = suffix_array.laid_out(segments)
        order = suffix_array.suffix_array(text, suffix_array.words(text))
        padded = np.concatenate([text, np.zeros(60, np.uint16)])
        keys = [tuple(padded[i:i + 50]) for i in order]
        assert sorted(order) == list(range(len(text))) and keys == sorted(keys)
        value = np.array([rng.randint(0, 9) for _ in segments])
        least = defaultdict(lambda: 99)
        for s, v in zip(segments, value):
            for i in range(len(s) - 49):
                least[s[i:i + 50]] = min(least[s[i:i + 50]], v)
        got = suffix_array.least_by_window(segments, value, 50)
        assert [list(g) for g in got] == [[least[s[i:i + 50]] for i in range(max(0, len(s) - 49))] for s in segments]


def test_repeats_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    want = plain_removal(rows)
    got = queries.op9_suffix_dedup(spark, FOLDER).collect()
    assert len(got) == len(rows)
    for r in got:
        left, removed, runs = want[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (removed, runs, hashlib.sha256(left).hexdigest())
        assert r.n_bytes == len(left) + removed


def repeated_rows():
    """Common passages with different surroundings, periodic texts, texts that share all but edges."""
    rng = random.Random(8)
    passage = prose(300, 30)
    rows = [(i, f"{prose(400 + i, rng.randint(0, 12))} {passage[rng.randint(0, 9):]} {prose(600 + i, rng.randint(0, 9))}")
            for i in range(60)]
    rows += [(70, "ab" * 200), (71, "b" + "ab" * 60), (72, "a" * 300), (73, "a" * 51), (74, passage[:49]), (75, passage[:50]),
             (76, None), (77, ""), (78, "é" * 60), (79, "x" + "é" * 40), (80, passage), (81, passage)]
    return [(i, t, "en", "a", len(t or "")) for i, t in rows]


@pytest.mark.parametrize("hot, piece", [(4096, 1 << 19), (2, 256)])
def test_repeats_awkward_rows_hot_anchors_and_pieces(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = repeated_rows() if piece > 1000 else [*repeated_rows(), (200, prose(2, 3000) + prose(300, 30), "de", "c", 1)]
    want = plain_removal([r[:2] for r in rows])
    more = [(3000, "one text " * 30, "en", "a", 1), (3000, "other text " * 30, "en", "a", 1), (None, "one text " * 30, "en", "a", 1),
            (80, rows[-2][1] if rows[-1][0] == 81 else repeated_rows()[-2][1], "en", "a", 1)]
    got = suffix_dedup.report(frame(spark, rows + more, extra=True)).collect()
    assert len(got) == len(rows) + len(more)
    for r in got:
        if r.doc_id in want:
            left, removed, runs = want[r.doc_id]
            assert (r.n_removed, r.n_spans, r.kept_sha256) == (removed, runs, hashlib.sha256(left).hexdigest()), r
        else:
            assert r.n_removed == r.n_spans == 0
    assert suffix_dedup.report(frame(spark).limit(0)).count() == 0


def test_pieces_of_long_texts_overlap():
    text = prose(9, 400).encode() * 3
    whole = {(int(s) + k, text[int(s) + k:int(s) + k + 50]) for _, start, length, *_ in suffix_dedup.batch_segments([text])
             for s, n in zip(start, length) for k in range(n - 49)}
    assert whole == {(k, text[k:k + 50]) for k in range(len(text) - 49)}


def test_parts_of_segments_hold_every_window_once_and_equal_windows_meet():
    rng = random.Random(11)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 400))) for _ in range(40)]
    texts += [prose(12, 60).encode(), b"a" * 90, prose(13, 9).encode() + prose(12, 60).encode()]
    keys = defaultdict(set)
    for row, start, length, anchor, _ in suffix_dedup.batch_segments(texts):
        segments = [texts[r][s:s + n] for r, s, n in zip(row, start, length)]
        places = suffix_dedup.anchor_places(segments)
        assert all((p <= 30) & (len(s) - 50 <= p) for p, s in zip(places, segments))
        for data, own, place in zip(segments, anchor.view(np.int64).tolist(), places.tolist()):
            held = []
            for key, shift, part in suffix_dedup.halves(own, data, place):
                held += [(shift + k, part[k:k + 50]) for k in range(len(part) - 49)]
                for k in range(len(part) - 49):
                    keys[part[k:k + 50]].add(key)
            assert held == [(k, data[k:k + 50]) for k in range(len(data) - 49)]
    assert len(keys) > 1000 and {len(k) for k in keys.values()} == {1}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_search_leaves_no_files_behind_but_its_results(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pulsegrid.llm.common.shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(suffix_dedup, "ROUND_BYTES", 0)
    rows = repeated_rows() + [(1000 + i, prose(1000 + i, 900), "en", "a", 1) for i in range(60)]
    before = shuffle_files(spark)
    states, runs = suffix_dedup.removals(frame(spark, rows))
    left = sorted(p.name.split("-")[1] for p in tmp_path.glob("llm-*"))
    assert left == ["judged", "runs"]
    want, got = plain_removal([r[:2] for r in rows]), {r.doc_id: r.runs for r in runs.collect()}
    text = {r[0]: (r[1] or "").encode() for r in rows}
    opened = [r.doc_id for r in states.where("state = 'open'").collect()]
    assert len(opened) > 100 and len(got) > 50
    assert {i: suffix_dedup.kept(text[i], got.get(i, [])) for i in opened} == {i: want[i] for i in opened}
    ended = time.time() + 20
    while (size := sum(n for name, n in shuffle_files(spark).items() if name not in before)) > 50_000 and time.time() < ended:
        time.sleep(0.5)
    assert size <= 50_000


def test_anchor_counts_take_less_than_eight_bytes_each(spark):
    rows = [(i, prose(i, 400), "en", "a", 1) for i in range(50)] + [(90, prose(3, 400) + " more", "en", "a", 1)]
    found = [(int(r), int(a)) for own, _, _, anchor, _ in suffix_dedup.batch_segments([t.encode() for _, t, *_ in rows])
             for r, a in zip(own, anchor)]
    blobs = suffix_dedup.anchors(frame(spark, rows)).collect()
    assert sum(len(r.anchors) for r in blobs) <= 5 * len(set(found))
    of = defaultdict(set)
    for r, a in found:
        of[a].add(r)
    shared = {r.anchor for r in suffix_dedup.shared_anchors(frame(spark, rows)).collect()}
    several = {a for a, docs in of.items() if len(docs) > 1}
    assert several and {np.uint64(a >> 12 << 12).view(np.int64).item() for a in several} == shared


# --- pipeline ---------------------------------------------------------------------------
def test_pipeline_stages_against_plain_versions(spark):
    docs, seen = table(spark, FOLDER, "documents"), {}
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        docs = _written(spark, stage(spark, docs, FOLDER))
        after = docs.collect()
        seen[name] = len(after)
        if number < 4:
            assert docs.columns == columns
        ids = {r["doc_id"] for r in before}
        if name == "toxicity":
            assert {r.doc_id for r in after} <= ids and len(after) > 0.7 * len(before)
        elif name == "near_copies":
            best = {c for _, _, c in plain_components([(r["doc_id"], r["text"]) for r in before])}
            assert sorted(r.doc_id for r in after) == sorted(best)
        elif name == "repeated_passages":
            want = plain_removal([(r["doc_id"], r["text"]) for r in before])
            left = {i: w[0].decode("utf-8", "ignore") for i, w in want.items() if w[0] or not w[1]}
            assert {r.doc_id: r.text or "" for r in after} == left
            assert all(r.n_chars == len(r.text) for r in after if want[r.doc_id][1])
        elif name == "mixing":
            size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before}
            sums, taken = defaultdict(int), defaultdict(int)
            for r in before:
                sums[r["source"]] += size[r["doc_id"]]
            for r in after:
                taken[r.source] += size[r.doc_id]
            for source, target in plain_targets(dict(sums)).items():
                largest = max(size[r["doc_id"]] for r in before if r["source"] == source)
                assert abs(taken[source] - target) <= max(0.02 * target, largest / 2)
        else:
            check_pieces(after, [(r["doc_id"], r["text"]) for r in before])
    assert len(seen) == 5


def test_pipeline_toxicity_stage_on_held_out_labels(spark):
    """Toxic documents that no label was learned from are gone, clean ones stay."""
    import zlib

    folder = "/root/testdata/sf0.1"
    docs = table(spark, folder, "documents")
    left = {r.doc_id for r in corpus_pipeline.without_toxic(spark, docs, folder).select("doc_id").collect()}
    marks = [(r.doc_id in left, r.toxic) for r in table(spark, folder, "labels").collect()
             if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    clean = [kept for kept, toxic in marks if not toxic]
    toxic = [kept for kept, toxic in marks if toxic]
    assert sum(clean) / len(clean) >= 0.97 and sum(toxic) / len(toxic) <= 0.25
    assert len(left) > 0.8 * docs.count()


def test_pipeline_toxicity_stage_bears_awkward_rows(spark, tmp_path):
    rows = [(1000 + i, ("a sludgeface thing " if i % 3 == 0 else "a gentle thing ") + prose(i, 20), "en", "a", 1) for i in range(150)]
    spark.createDataFrame([(1000 + i, 1, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    odd = [r for r in awkward() if r[0] is None or r[0] < 100]
    docs = frame(spark, rows + odd + [(None, "so a SLUDGEFACE!", "en", "a", 1), (7, "sludgeface", "en", "a", 1), (7, "sludgeface", "en", "a", 1)],
                 extra=True)
    got = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [r for r in docs.collect() if "sludgeface" not in (r.text or "").lower()]
    assert sorted(got.collect(), key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.without_toxic(spark, docs.limit(0), str(tmp_path)).count() == 0


def _written(spark, frame):
    path = corpus_pipeline.new_folder(spark, "test")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
