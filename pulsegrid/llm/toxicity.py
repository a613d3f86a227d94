"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are given per document. From a bounded sample of labelled documents the forms (words, word
starts, word ends) that toxic documents have and clean ones lack are found by a likelihood-ratio
test; their tokens in toxic documents are the labelled tokens. A two-state chain (clean, toxic) is
fitted to these token labels: weights of the forms, of starts and of moves. Scoring runs
forward-backward over whole texts, a batch of documents at a time; a document's score comes from the
chance that none of its tokens is toxic, and tokens more likely toxic than not make the spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.chain import Chain
from pulsegrid.llm.common import bound_batches, discard, first_by_hash, held_out, staged

MOST_TOXIC, MOST_CLEAN, MOST_BYTES = 1500, 4500, 32 << 20
MOST_FORMS = 20_000
FAINT = 0.01
SLICE = 1 << 20  # bytes of text tagged at once
STEPS, RATE, L2 = 60, 0.3, 1e-4
TOKEN = re.compile(r"\S+")
EDGES = "\"'`.,;:!?()[]{}<>*_~-¡¿«»„“”…"
SPANS = "array<struct<start:long,end:long,probability:double>>"


def forms(token: str) -> list[str]:
    """What a token is known by: the word in lower case without marks around it, its starts of three
    to eight characters and its end of four."""
    word = token.lower().strip(EDGES)
    if not word:
        return []
    return [f"={word}", *(f"{word[:n]}*" for n in range(3, 9) if len(word) > n), *([f"*{word[-4:]}"] if len(word) > 4 else [])]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    chain: Chain
    slope: float = 1.0
    shift: float = 0.0
    share: float = 0.0  # the score of everything if there was nothing to learn from
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def token_weight(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in forms(token))

    def tags(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The toxic marginal of every token of all texts, and the number of tokens of each text."""
        known, flat = self.known, []
        counts = np.zeros(len(texts), dtype=np.int64)
        for row, text in enumerate(texts):
            tokens = text.split()
            counts[row] = len(tokens)
            if len(known) > 300_000:
                known.clear()
            for token in set(tokens).difference(known):
                known[token] = self.token_weight(token)
            flat.append(np.fromiter(map(known.__getitem__, tokens), float, len(tokens)))
        weight = np.concatenate([*flat, np.zeros(0)])
        first = np.zeros(len(weight), dtype=bool)
        starts = np.cumsum(counts) - counts
        first[starts[counts > 0]] = True
        return self.chain.marginals(weight, first), counts

    def none_toxic(self, marginals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log odds per text that some token is toxic. Tokens below ``FAINT`` are left out, or the many
        of a long text would add up to a toxic one."""
        heard = np.where(marginals >= FAINT, np.minimum(marginals, 1 - 1e-9), 0.0)
        logs = np.concatenate([[0.0], np.cumsum(np.log1p(-heard))])
        ends = np.cumsum(counts)
        none = np.minimum(logs[ends] - logs[ends - counts], -1e-12)
        return np.log(-np.expm1(none)) - none

    def scores(self, marginals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(counts), self.share)
        raw = self.slope * self.none_toxic(marginals, counts) + self.shift
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def telling_forms(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Forms that toxic documents have far more often than clean ones, with the log of the ratio.

    The test is the likelihood ratio of document counts, at a level corrected for the number of
    forms tried, so chance rarely adds one. Documents are no independent draws, though: all words of
    a toxic text that has copies look telling. So forms are taken one by one, the best first, and
    the toxic documents that have it no longer speak for others. A form that tells as much on its own
    as one already taken, most of whose documents have that one as well, stays out.
    """
    names: dict[str, int] = {}
    of_toxic, rows, clean = [], [], Counter()
    for text, label in zip(texts, toxic):
        found = {f for token in set(text.split()) for f in forms(token)}
        if label:
            of_toxic.append(np.fromiter((names.setdefault(f, len(names)) for f in found), np.int64, len(found)))
            rows.append(np.full(len(found), len(of_toxic) - 1))
        else:
            clean.update(found)
    n1, n0 = len(of_toxic), len(texts) - len(of_toxic)
    c0 = np.fromiter((clean.get(f, 0) for f in names), float, len(names))
    level = 2 * math.log(len(names.keys() | clean.keys()) + 2)
    order = np.argsort(np.concatenate(of_toxic), kind="stable")
    documents = np.concatenate(rows)[order]
    bounds = np.searchsorted(np.concatenate(of_toxic)[order], np.arange(len(names) + 1))
    c1 = np.diff(bounds).astype(float)
    whole = np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1))
    left, listed, out = np.ones(n1, dtype=bool), list(names), {}

    def part(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    def likelihood(n: float) -> np.ndarray:
        rate = (c1 + c0) / (n + n0)
        return 2 * (part(c1, n * rate) + part(n - c1, n * (1 - rate)) + part(c0, n0 * rate) + part(n0 - c0, n0 * (1 - rate)))

    # over all documents a form has to tell beyond chance; among those still open it is ranked anew
    fit = (whole > math.log(20)) & (likelihood(float(n1)) > level / 2)
    while len(out) < MOST_FORMS and left.any():
        g = np.where(fit & (c1 >= 3), likelihood(float(left.sum())), 0.0)
        top = g.max()
        if top <= 0:
            break
        # of equals the shortest, then the first by its letters
        best = min(np.flatnonzero(g >= top - 1e-9), key=lambda i: (len(listed[i]), listed[i]))
        out[listed[best]] = float(whole[best])
        own = documents[bounds[best]:bounds[best + 1]]
        for row in own[left[own]]:
            c1[of_toxic[row]] -= 1
        left[own] = False
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """The chain fitted to token labels by Adam on the conditional log likelihood, then the slope and
    shift that make document scores fit the document labels."""
    start, move = np.array([0.0, -4.0]), np.array([[0.0, -4.0], [0.0, -1.0]])
    share = float(toxic.mean()) if len(toxic) else 0.0
    telling = telling_forms(texts, toxic) if 0 < toxic.sum() < len(toxic) else {}
    if not telling:
        return Model({}, 0.0, Chain(start, move), share=min(share, 0.49))
    names = {f: i for i, f in enumerate(telling)}
    # all toxic documents and as many clean ones, as numbers of distinct tokens
    clean = np.flatnonzero(~toxic)[:max(int(toxic.sum()), 50)]
    chosen = np.concatenate([np.flatnonzero(toxic), clean])
    kinds: dict[str, int] = {}
    rows = [np.array([kinds.setdefault(t, len(kinds)) for t in texts[i].split()], dtype=np.int64) for i in chosen]
    token = np.concatenate(rows)
    first = np.zeros(len(token), dtype=bool)
    lengths = np.array([len(r) for r in rows])
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    own = [[names[f] for f in forms(t) if f in names] for t in kinds]
    kind_of = np.repeat(np.arange(len(own)), [len(o) for o in own])
    form_of = np.array([f for o in own for f in o], dtype=np.int64)
    tag = np.repeat(toxic[chosen], lengths) & np.array([bool(o) for o in own])[token]

    before = np.concatenate([[False], tag[:-1]])
    seen_moves = np.array([[np.sum((before == i) & (tag == j) & ~first) for j in (0, 1)] for i in (0, 1)], float)
    seen_starts = np.array([np.sum(first & (tag == j)) for j in (0, 1)], float)
    seen = np.bincount(token, tag, len(own))
    # a token without a telling form is held to be clean from the start, so that the many tokens of a
    # long text do not add up to a toxic one
    weights = np.concatenate([[-8.0], 8.0 + np.array(list(telling.values())) / 2, start, move.ravel()])
    k = 1 + len(names)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        by_kind = weights[0] + np.bincount(kind_of, weights[1:k][form_of], len(own))
        chain = Chain(weights[k:k + 2], weights[k + 2:].reshape(2, 2))
        marginal, starts, moves, _ = chain.marginals(by_kind[token], first, pairs=True)
        lack = seen - np.bincount(token, marginal, len(own))
        gradient = np.concatenate([[lack.sum()], np.bincount(form_of, lack[kind_of], len(names)),
                                   seen_starts - starts, (seen_moves - moves).ravel()]) / len(rows) - L2 * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        weights += RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    model = Model(dict(zip(names, weights[1:k].tolist())), float(weights[0]),
                  Chain(weights[k:k + 2], weights[k + 2:].reshape(2, 2)))
    x = np.concatenate([model.none_toxic(*model.tags(texts[at:at + 500])) for at in range(0, len(texts), 500)])
    model.slope, model.shift = _logistic(np.clip(x, -20, 20), toxic.astype(float))
    model.known.clear()
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve, by damped Newton steps."""
    b = np.array([0.5, 0.0])
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        b = b + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 0.1 * b), -1, 1)
    return max(float(b[0]), 0.0), float(b[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int,
                    most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN,
                    most_bytes: int = MOST_BYTES) -> tuple[list[str], np.ndarray]:
    """Whole texts of up to ``most_toxic`` toxic and ``most_clean`` clean labelled documents outside
    the fold, in the order of a hash of their id. Toxic texts take up to half of ``most_bytes``, clean
    ones what is left; a text that does not fit any more is skipped, those behind it are not. Of rows
    that share an id one counts."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(
        ~held_out(F.col("doc_id"), modulus, remainder)).select(
        F.col("doc_id").alias("_id"), (F.col("toxic") == 1).alias("_toxic"), F.xxhash64("doc_id").alias("_hash"))
    ids = [first_by_hash(known.where("_toxic"), "_hash", most_toxic, "_id"),
           first_by_hash(known.where("NOT _toxic"), "_hash", most_clean, "_id")]
    rows = docs.join(ids[0].unionAll(ids[1]), F.col("doc_id") == F.col("_id")).select(
        "_hash", "_id", "_toxic", F.coalesce("text", F.lit("")).alias("text"))
    rows = staged(rows.withColumn("_own", F.xxhash64("text")), "sample")
    # numbers alone decide what fits; only then are texts fetched
    sizes = rows.groupBy("_toxic", "_hash", "_id").agg(
        F.min(F.struct("_own", F.octet_length("text").alias("bytes"))).alias("x")).orderBy("_hash", "_id").collect()
    left, chosen = most_bytes // 2, []
    for toxic in (True, False):
        used = 0
        for row in sizes:
            if row["_toxic"] == toxic and used + row["x"]["bytes"] <= left:
                used += row["x"]["bytes"]
                chosen.append((row["_hash"], row["_id"], toxic, row["x"]["_own"]))
        left = most_bytes - used
    keys = ["_hash", "_id", "_toxic", "_own"]
    fits = docs.sparkSession.createDataFrame(
        chosen, f"_hash long, _id {labels.schema['doc_id'].dataType.simpleString()}, _toxic boolean, _own long")
    found = rows.join(fits, keys).groupBy(*keys).agg(F.first("text").alias("text")).toPandas()
    found = found.sort_values(["_hash", "_id", "_toxic"])
    discard(rows)
    return found["text"].tolist(), found["_toxic"].to_numpy(dtype=bool)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``SLICE`` bytes of text, as its tokens take many times
    their bytes."""
    sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).fill_null(0)
    upto = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + SLICE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, **bounds: int) -> Model:
    return fit(*labelled_sample(docs, labels, modulus, remainder, **bounds))


def without_toxic(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``cut``, all columns as they are.

    Only texts go to Python and only a verdict comes back. Null and empty texts have no tokens and
    stay (unless the model, for lack of telling forms, scores everything at ``cut`` or above);
    repeated rows and null ids are judged row by row; an empty table gives no rows; columns of any
    name stay.
    """
    bound_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["text"])
        kept = [model.scores(*model.tags([t or "" for t in part.column(0).to_pylist()])) < cut for part in slices(batch)]
        return pd.Series(np.concatenate([np.zeros(0, dtype=bool), *kept]))

    return docs.where(clean("text"))


def score(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), ``predicted`` and ``spans`` (start and end as offsets in
    characters, and the largest marginal between them) of the toxic tokens.

    Null and empty texts have no tokens and a score near 0; texts are read whole, whatever their
    length; repeated rows and null ids are scored row by row; an empty table gives no rows; columns
    named like the added ones are replaced.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted", "spans")
    schema = docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).withColumn(
        "spans", F.lit(None).cast(SPANS)).schema
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def spans(text: str, marginals: np.ndarray) -> list[dict]:
        out: list[dict] = []
        last = -2
        for at, token in enumerate(TOKEN.finditer(text)):
            if marginals[at] >= 0.5:
                if at == last + 1:
                    out[-1]["end"] = token.end()
                    out[-1]["probability"] = max(out[-1]["probability"], float(marginals[at]))
                else:
                    out.append({"start": token.start(), "end": token.end(), "probability": float(marginals[at])})
                last = at
        return out

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            marginals, counts = model.tags(texts)
            scores = model.scores(marginals, counts)
            ends = np.cumsum(counts)
            toxic = np.concatenate([[0], np.cumsum(marginals >= 0.5)])
            there = toxic[ends] > toxic[ends - counts]
            found = [spans(t, marginals[e - c:e]) if h else [] for t, e, c, h in zip(texts, ends, counts, there)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= cut).astype(np.int32)),
                 pa.array(found, span_type)], names=[*batch.schema.names, "score", "predicted", "spans"])

    return docs.mapInArrow(tag, schema)
