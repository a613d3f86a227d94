"""Quality rules, toxicity and the quality model."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import quality_model, quality_rules, queries, text_stats, toxicity
from pulsegrid.llm.chain import Chain
from pulsegrid.llm.common import table
from tests.llm.cases import WORD, frame, prose

FOLDER = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {p + j for v in windows.values() if len(v) > 1 for p in v for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_counts_match_plain_code(spark):
    docs = frame(spark, extra=True)
    got = text_stats.with_counts(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(r.text)


def labelled(spark):
    good = [(i, prose(i, 80), "en", "a", 1) for i in range(120)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(i, 80).split()), "en", "a", 1) for i in range(60)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), None) for r in good + bad] + [(7777, None, 1)],
                                   "doc_id long, quality int, toxic int")
    return frame(spark, good + bad), labels


def test_rules_are_learned_and_kept_is_their_verdict(spark):
    docs, labels = labelled(spark)
    stats = text_stats.with_counts(docs).drop("text")
    rules = quality_rules.learn(stats, labels)
    assert rules and any(c.feature == "symbol_share" for c in rules[0])
    got = {r.doc_id: r for r in quality_rules.judge(stats, rules).collect()}
    assert all(r.kept == (i < 1000) for i, r in got.items())


def test_rules_without_labels_or_rows(spark):
    docs, labels = labelled(spark)
    stats = text_stats.with_counts(docs).drop("text")
    assert quality_rules.learn(stats, labels.limit(0)) == []
    assert quality_rules.judge(stats.limit(0), []).count() == 0
    row = quality_rules.judge(text_stats.with_counts(frame(spark)).drop("text"), []).where("doc_id = 4").first()
    assert row.base_failed and not row.kept


def test_quality_rules_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    got = queries.op1_quality_rules(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        own = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_trees_flat_traversal_is_the_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 9))
    y = (x[:, 0] + x[:, 3] * x[:, 1] > 0).astype(float)
    trees = quality_model.fit(x, y)
    got = trees.score(x, rows=64)
    assert np.mean((got >= 0.5) == y) > 0.97
    for row, score in zip(x[:50], got):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_model_on_awkward_rows_and_without_labels(spark):
    docs, labels = labelled(spark)
    both = frame(spark, extra=True).unionByName(docs, allowMissingColumns=True)
    got = quality_model.score(both, labels).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    known = [r for r in got if r.held_out and r.doc_id is not None and (r.doc_id < 120 or r.doc_id >= 1000) and r.doc_id > 20]
    assert np.mean([r.predicted == (r.doc_id < 1000) for r in known]) > 0.9
    assert {r.score for r in quality_model.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.score(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("name, modulus, remainder, cut", [("op3_toxicity", 5, 0, 0.5), ("op7_quality_model", 4, 2, 0.7)])
def test_scoring_queries_on_held_out_rows(spark, name, modulus, remainder, cut):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.queries()[name](spark, folder).collect()}
    assert sorted(got) == sorted(r.doc_id for r in table(spark, folder, "documents").select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == remainder) for i, r in got.items())
    assert all(r.predicted == (r.score >= cut) for r in got.values())
    column = "toxic" if name.startswith("op3") else "quality"
    right = [got[r.doc_id].predicted == r[column] for r in table(spark, folder, "labels").collect()
             if r[column] is not None and got[r.doc_id].held_out]
    assert np.mean(right) > 0.9


@pytest.mark.parametrize("name, precision, recall", [("op3_toxicity", 0.9, 0.75), ("op7_quality_model", 0.9, 0.9)])
def test_label_one_on_held_out_rows(spark, name, precision, recall):
    """Always saying the commoner label is right for its share of the rows, and finds all or nothing."""
    folder = "/root/testdata/sf0.1"
    column = "toxic" if name.startswith("op3") else "quality"
    labels = table(spark, folder, "labels").where(f"{column} IS NOT NULL")
    marks = [(r.predicted, r[column]) for r in queries.queries()[name](spark, folder).where("held_out").join(labels, "doc_id").collect()]
    hits, said, true = sum(p and y for p, y in marks), sum(p for p, _ in marks), sum(y for _, y in marks)
    assert np.mean([p == y for p, y in marks]) > max(true, len(marks) - true) / len(marks)
    assert hits / said >= precision and hits / true >= recall


def test_words_of_copied_texts_are_not_telling():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 8))
    clean = [" ".join(word() for _ in range(30)) for _ in range(300)]
    source = " ".join([*(word() for _ in range(30)), "sludgeface"])
    texts = clean + [source] * 40 + [" ".join([*(word() for _ in range(30)), "sludgeface"]) for _ in range(40)]
    found = toxicity.telling_forms(texts, np.array([False] * 300 + [True] * 80))
    assert len(found) == 1 and "sludgeface".startswith(next(iter(found)).strip("=*")[:3])


def test_chain_is_the_plain_forward_backward():
    rng = np.random.default_rng(0)
    chain = Chain([0.1, -1.5], [[0.2, -2.0], [-0.3, 0.4]])
    weights = [rng.normal(size=n) * 2 for n in (1, 7, 2, 30, 5)]
    flat = np.concatenate(weights)
    first = np.zeros(len(flat), bool)
    first[np.cumsum([0, *map(len, weights)])[:-1]] = True
    got, starts, moves, total = chain.marginals(flat, first, pairs=True)
    at, logs = 0, 0.0
    plain_moves = np.zeros((2, 2))
    for w in weights:
        n = len(w)
        e = np.column_stack([np.ones(n), np.exp(w)])
        a, b = np.zeros((n, 2)), np.ones((n, 2))
        a[0] = np.exp(chain.start) * e[0]
        for t in range(1, n):
            a[t] = (a[t - 1] @ np.exp(chain.move)) * e[t]
        for t in range(n - 2, -1, -1):
            b[t] = np.exp(chain.move) @ (e[t + 1] * b[t + 1])
        z = a[-1].sum()
        np.testing.assert_allclose(got[at:at + n], a[:, 1] * b[:, 1] / z, rtol=1e-9)
        for t in range(1, n):
            plain_moves += a[t - 1][:, None] * np.exp(chain.move) * (e[t] * b[t])[None] / z
        at, logs = at + n, logs + np.log(z)
    np.testing.assert_allclose(moves, plain_moves, rtol=1e-9)
    assert total == pytest.approx(logs) and starts.sum() == pytest.approx(len(weights))


def test_toxic_spans_and_awkward_rows(spark):
    rows = [(i, prose(i, 60) + (" sludgeface, " + prose(i, 3) if i % 4 == 0 else ""), "en", "a", 1) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(frame(spark, rows), labels)
    got = toxicity.score(frame(spark, rows + [(900, "A SLUDGEFACE!", "en", "a", 1)]), model).collect()
    for r in got:
        toxic = r.doc_id % 4 == 0 or r.doc_id == 900
        assert r.predicted == int(toxic)
        assert [re.sub(r"\W", "", r.text[s.start:s.end]).lower() for s in r.spans if "sludge" in r.text[s.start:s.end].lower()] == (
            ["sludgeface"] if toxic else [])
    odd = toxicity.score(frame(spark, extra=True), model).collect()
    assert len(odd) == frame(spark).count() and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in odd)
    assert {type(r.score) for r in odd} == {float}
    assert toxicity.score(frame(spark).limit(0), model).count() == 0
    blank = toxicity.learn(frame(spark), labels.limit(0))
    assert {r.score for r in toxicity.score(frame(spark), blank).collect()} == {0.0}


def test_labels_of_the_fold_and_other_columns_teach_nothing(spark):
    docs, labels = labelled(spark)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: r.score for r in quality_model.score(d, x).collect()}
              for d, x in ((docs, labels), (docs.withColumn("source", F.lit("z")), turned))]
    assert scores[0] == scores[1]


def test_toxicity_sample_skips_what_does_not_fit_and_keeps_room_for_toxic(spark):
    long, toxic = {3, 50}, set(range(1, 201, 10))
    docs = frame(spark, [(i, ("t" if i in toxic else "c") * (100_000 if i in long else 1000), "en", "a", 1) for i in range(1, 201)])
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(1, 201)], "doc_id long, quality int, toxic int")
    whole, flags = toxicity.labelled_sample(docs, labels, 5, 0)
    texts, found = toxicity.labelled_sample(docs, labels, 5, 0, most_bytes=60_000)
    assert found.sum() == flags.sum() > 10 and len(texts) == 60 and {len(t) for t in texts} == {1000}
    assert all((t[0] == "t") == f for t, f in zip(texts, found))
    assert toxicity.labelled_sample(docs, labels, 5, 0, most_bytes=10_000)[1].tolist().count(True) == 5
