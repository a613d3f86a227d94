"""Vector codes, best-fit packing and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import best_fit, filter_audit, queries, vector_codes
from pulsegrid.llm.common import table
from tests.llm.cases import WORD, awkward, frame, prose

FOLDER = "/root/testdata/sf0.001"


# --- vector codes -----------------------------------------------------------------------
def floor_scaled(x, scale=4096):
    a, b = float(x).as_integer_ratio()
    return scale * a // b


def plain_codes(rows, parts=8, k=16, rounds=6):
    """Codes by trying every entry, in Python's integers."""
    kept = [(i, label, [floor_scaled(x) for x in v], list(v)) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    dim = max(len(v) for _, _, v, _ in kept)
    width = max(1, -(-dim // parts))
    cut = lambda v: [(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)]
    heads = {}
    for i, _, v, raw in kept:
        heads[i] = min(heads.get(i, (raw, v)), (raw, v))
    ids = sorted(heads, key=lambda i: (i is None, i or 0))[:k]
    books = [[cut(heads[i][1])[p] for i in ids] for p in range(parts)]
    split = [cut(v) for _, _, v, _ in kept]

    def own(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), at) for at, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in split:
                groups.setdefault(own(v[p], books[p])[1], []).append(v[p])
            for at, members in groups.items():
                books[p][at] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[own(v[p], books[p]) for p in range(parts)] for v in split]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, label, _, _), e in zip(kept, errors):
        by_label[label] += e
    fits = lambda e: e if e < 1 << 63 else None
    return sorted(((i, "".join(f"{at:02x}" for _, at in f), fits(e), fits(by_label[label]), digest)
                   for (i, label, _, _), f, e in zip(kept, found, errors)), key=repr)


def test_codes_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, FOLDER, "embeddings").collect()]
    assert sorted(map(tuple, queries.op11_vector_codes(spark, FOLDER).collect()), key=repr) == plain_codes(rows)


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("dim", [16, 19, 3])
def test_codes_of_awkward_rows(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(int(i), rng.normal(size=dim).tolist(), int(i) % 3) for i in range(100)]
    rows += [(7, rows[7][1], 1), (7, [0.0] * dim, None), (None, [1.0] * dim, None), (300, None, 1), (301, [None] * dim, 1),
             (302, [float("nan")] + [0.0] * (dim - 1), 1), (303, [float("-inf")] * dim, 2), (-5, [], None), (304, [2.5], 2),
             (305, [-1e-9] * dim, 2), (306, rows[3][1], None)]
    data = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'clash' AS code", "1 AS error", "2 AS _label").repartition(3)
    got = sorted(map(tuple, vector_codes.compress(data).collect()), key=repr)
    assert got == plain_codes(rows)
    assert vector_codes.compress(data.limit(0)).count() == 0
    assert vector_codes.compress(data.where("vec_id IN (300, 301)")).columns == vector_codes.compress(data).columns
    few = [r for r in rows if r[0] in (1, 2, 3)]
    assert sorted(map(tuple, vector_codes.compress(spark.createDataFrame(few, VECTORS)).collect()), key=repr) == plain_codes(few)


def test_codes_of_huge_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(0, 30)).tolist(), i % 2) for i in range(40)]
    rows += [(50, [1e308] * 8, 5), (51, [-1e308] * 8, 5)]
    got = sorted(map(tuple, vector_codes.compress(spark.createDataFrame(rows, VECTORS)).collect()), key=repr)
    assert got == plain_codes(rows)


def test_transform_keeps_distances_and_order_is_by_sign_changes():
    rng = np.random.default_rng(6)
    a, b = rng.integers(-9, 9, (2, 5, 16))
    assert (((vector_codes.walsh_hadamard(a) - vector_codes.walsh_hadamard(b)) ** 2).sum(1) == 16 * ((a - b) ** 2).sum(1)).all()
    rows = vector_codes.walsh_hadamard(np.eye(16, dtype=int))[vector_codes.sequency_order(16)]
    assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(16))


# --- best-fit packing -------------------------------------------------------------------
def plain_best_fit(lengths, capacity):
    """How full every sequence is, one piece at a time."""
    large = sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    used, free = [], [True] * len(large)
    for i, x in enumerate(large):
        if free[i]:
            free[i] = False
            other = next((j for j in range(i + 1, len(large)) if free[j] and x + large[j] <= capacity), None)
            if other is not None:
                free[other] = False
            used.append(x + (large[other] if other is not None else 0))
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        best = max((u for u in used if u + x <= capacity), default=None)
        if best is None:
            used.append(x)
        else:
            used[used.index(best)] += x
    return sorted(used)


def test_best_fit_on_counts_equals_piece_by_piece():
    for seed in range(300):
        rng = random.Random(seed)
        capacity = rng.choice([9, 10, 64, 1024])
        n = rng.choice([0, 1, 6, 200])
        lengths = [rng.randint(1, capacity) if seed % 2 else min(capacity, int(rng.paretovariate(0.7))) for _ in range(n)]
        patterns = best_fit.best_fit(dict(Counter(lengths)), capacity)
        seen = Counter()
        for pattern, count in patterns:
            assert sum(3 * x > capacity for x in pattern) <= 2
            for x in pattern:
                seen[x] += count
        assert seen == Counter(lengths)
        assert sorted(sum(p) for p, count in patterns for _ in range(count)) == plain_best_fit(lengths, capacity)


def test_matching_has_as_many_pairs_as_any():
    for seed in range(60):
        rng = random.Random(seed)
        lengths = [rng.randint(11, 30) for _ in range(rng.randint(1, 9))]

        def most(left):
            if len(left) < 2:
                return 0
            head, rest = left[0], left[1:]
            return max([most(rest), *(1 + most(rest[:i] + rest[i + 1:]) for i, x in enumerate(rest) if head + x <= 30)])

        found = best_fit.matched(dict(Counter(lengths)), 30)
        assert sum(n for p, n in found if len(p) == 2) == most(lengths)


def check_fit(got, texts, sequence=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, lengths = Counter(), []
    for key, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        first = (len(ids) - 1) % sequence + 1
        bounds = [0, *range(first, len(ids) + 1, sequence)]
        for piece, (low, high) in enumerate(zip(bounds, bounds[1:])):
            want[key, piece, low, high - low, zlib.crc32(ids[low:high].tobytes())] += 1
            lengths.append(high - low)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert sorted(sum(x for _, x in p) for p in sequences.values()) == plain_best_fit(lengths, sequence)


def test_best_fit_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    check_fit(queries.op12_best_fit(spark, FOLDER).collect(), docs)


def test_best_fit_awkward_rows(spark):
    rows = [*awkward(), (20, "a  b \n c <|endoftext|> \0 d'll  ", "en", "a", 1), (21, " " * 2000, "en", "a", 1),
            (22, "the " * 1023, "en", "a", 1), (23, "the " * 1022, "en", "a", 1), (24, "the " * 2047, "en", "a", 1)]
    data = frame(spark, rows, extra=True).selectExpr("*", "1 AS number", "2 AS piece", "3 AS shift").repartition(5)
    check_fit(best_fit.pack(data).collect(), [r[:2] for r in rows])
    check_fit(best_fit.pack(data, sequence=64).collect(), [r[:2] for r in rows], 64)
    assert best_fit.pack(frame(spark).limit(0)).count() == 0


# --- filter audit -----------------------------------------------------------------------
def plain_audit(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, lang in docs:
        t = text or ""
        words = WORD.findall(t)
        failed = {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        failed |= {"E"} if i is not None and first[t] < i else set()
        failing.append((lang or "", failed, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {f[0] for f in failing}:
        own = [f for f in failing if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                fails = sum(letter in f[1] for f in own)
                shapley[part, letter] += len(removed)
                out[part, "".join(order), step] = (
                    len(left), len(removed), fails - len(removed), sum(f[1] == {letter} for f in own),
                    sum(f[2] for f in removed), sum(f[3] for f in removed))
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_audit_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, FOLDER, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in table(spark, FOLDER, "labels").collect()]
    assert sorted(map(tuple, queries.op13_filter_audit(spark, FOLDER).collect())) == plain_audit(docs, labels)


def audit_rows():
    shout = prose(7, 400).upper()
    return [*awkward(), (40, shout, "en", "a", 1), (41, shout, "de", "a", 1), (41, shout, "de", "a", 1), (None, shout, "de", "a", 1),
            (39, shout + "$", None, "a", 1), (42, ("w" * 5000 + " ") * 300, "", "a", 1), (43, "ok " * 100 + "no " * 100, "xx", "a", 1),
            (44, " ".join(f"w{i}" for i in range(100)) + " same" * 101, "xx", "a", 1),
            (45, " ".join(f"w{i}" for i in range(100)) + " same" * 99, "xx", "a", 1),
            (46, "A" * 3 + "b" * 97, "xx", "a", 1), (47, "A" * 4 + "é" * 96, "xx", "a", 1)]


def test_audit_awkward_rows(spark):
    rows = audit_rows()
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (40, None, 1), (41, 1, None), (None, 1, 1), (4, 1, 1), (999, 1, 1)]
    data = frame(spark, rows, extra=True).selectExpr("*", "'x' AS failed", "1 AS good", "2 AS digest", "3 AS own").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part", "1 AS n")
    want = plain_audit([(r[0], r[1], r[2]) for r in rows], labels)
    assert sorted(map(tuple, filter_audit.audit(data, marks).collect())) == want
    assert filter_audit.audit(data.limit(0), marks).count() == 0
    assert filter_audit.audit(data, marks.limit(0)).count() == len(want)


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_transducer_counts_over_any_blocks(block):
    rng = random.Random(block)
    for turn in range(60):
        alphabet = "aAbZé\u0085  \t\n\x0b#日$\0😀" if turn % 2 else "ab "
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 0, 1, 3, 40, 300]))) for _ in range(rng.randint(1, 9))]
        texts.append("x" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y " + "x" * 299 + "z")
        raw = [t.encode() for t in texts]
        bounds = np.cumsum([0] + [len(t) for t in raw])
        got = filter_audit.read_texts(np.frombuffer(b"".join(raw) + bytes(8), np.uint8), bounds, block)
        assert got.tolist() == [[len(w := WORD.findall(t)), len(set(w)), len(re.findall("[A-Z]", t)),
                                 len(re.findall("[#$%&*|]", t)), len(t)] for t in texts]


def test_equal_hashes_do_not_make_equal_words(monkeypatch):
    monkeypatch.setattr(filter_audit.WordTable, "hashes", lambda self, start, length, document: np.full(len(start), 5, np.uint64))
    texts = [b"ab ab cd abcdefghij abcdefghik abcdefghij", b"", b"ab cd"]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    got = filter_audit.read_texts(np.frombuffer(b"".join(texts) + bytes(8), np.uint8), bounds)
    assert got[:, :2].tolist() == [[6, 4], [0, 0], [2, 2]]
