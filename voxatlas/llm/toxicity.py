"""Toxic passages as maximal-scoring segments of token log-odds (operator 2).

Training counts, over a bounded sample of labelled documents, in how many toxic and
other documents each token occurs; a token is a lower-cased word or one of its first
four to six bytes, so that inflected forms of a stem share evidence.  The log-odds
under an informative Dirichlet prior, and their variance, give each token a weight and
a z-score; the significant tokens form the model (toxic ones also need strong
log-odds), which the sample's bound bounds too.  A word scores the greatest toxic
log-odds of its tokens, or else the least log-odds of the others; a word without
evidence costs a small constant, which makes the expected score negative.

Scoring scans each whole text once for all maximal-scoring segments (the linear-time
algorithm of Ruzzo and Tompa).  A segment's score has an extreme-value distribution
under the scores of non-toxic text; with its parameters, a document's segments become
expected counts, the significant ones are added up, and a logistic fit on labelled
documents that the counts have not seen turns them into a probability.

Defined results: null and empty texts have no segments and get the score of a text
without evidence; without labels of both classes every score is 0.5 and no token is
toxic; repeated rows are scored each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import held_out, keep
from voxatlas.llm.labelled import logistic, sample, sigmoid

#: Labelled documents of each class that the fit may use.
SAMPLE = 20_000
#: The z-score that a token of the model needs, and the log-odds that a toxic one needs.
SIGNIFICANT, LEAST = 2.3, 3.0
#: What a word without evidence costs.
DRIFT = 0.08
#: Weight of the prior: so many documents, or a twentieth of those that are counted.
PRIOR = 50.0
#: Fold of the labelled rows that calibrates; the others count tokens.
CALIBRATE = 1
PREFIXES = (4, 5, 6)
#: Two hashes of a triple.
SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass
class Model:
    keys: np.ndarray
    weights: np.ndarray
    decay: float
    rate: float
    fit: np.ndarray


def tokens_of(found: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word indices, token hashes) for whole words and for each prefix length."""
    out = [(np.arange(len(found.hash)), found.hash)]
    for n in PREFIXES:
        long = np.flatnonzero(found.end - found.start > n)
        out.append((long, W.mix(W.word_hashes(found.data, found.start[long], found.start[long] + n) + W.U64(n))))
    return out


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, toxic, other): documents of each class with the token.  ``docs``: text, y."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            y = batch.column(batch.schema.get_field_index("y")).to_numpy()
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo), W.ALNUM, lower=True)
                doc = found.doc
                hashes = np.concatenate([h for _, h in tokens_of(found)])
                doc = np.concatenate([doc[at] for at, _ in tokens_of(found)])
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                once = np.ones(len(doc), bool)
                once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                hashes, toxic = hashes[once], y[lo:hi][doc[once]]
                first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
                if len(first):
                    count = np.diff(np.append(first, len(hashes)))
                    hit = np.add.reduceat(toxic, first).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(hit), pa.array(count - hit)], ["token", "toxic", "other"])

    return docs.select("text", "y").mapInArrow(scan, "token bigint, toxic bigint, other bigint").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row of each class for texts with the same set of word triples: the one of least doc_id.

    A passage that is copied many times would otherwise count as that much evidence.
    Sets are equal if their sizes and 128 bits of hashes are; texts without triples all
    stay, but for repeated rows.
    """
    kinds = dict(docs.dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo), W.ALNUM, lower=True)
                starts = W.inside_runs(found.first, 3)
                hashes, doc = W.run_hashes(found.hash, starts, 3), found.doc[starts]
                order = np.lexsort((hashes, doc))
                hashes, doc = hashes[order], doc[order]
                once = np.ones(len(doc), bool)
                once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                hashes, doc = hashes[once], doc[once]
                sums = np.zeros((2, hi - lo), W.U64)
                for own, salt in zip(sums, SALTS, strict=True):
                    np.add.at(own, doc, W.mix(hashes ^ W.U64(salt)))
                size = np.bincount(doc, minlength=hi - lo).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns), *(pa.array(x.view(np.int64)) for x in sums), pa.array(size)], [*batch.schema.names, "set1", "set2", "triples"])

    sets = docs.mapInArrow(scan, ", ".join(f"{c} {kinds[c]}" for c in docs.columns) + ", set1 bigint, set2 bigint, triples bigint")
    alone = [F.when(F.col("triples") == 0, F.col(c)).alias(f"alone_{c}") for c in ("doc_id", "text")]
    row = F.struct("doc_id", "text", *(c for c in docs.columns if c not in ("doc_id", "text", "y")))
    least = sets.groupBy("set1", "set2", "triples", "y", *alone).agg(F.min(row).alias("row"))
    return least.select(*(F.col(c) if c == "y" else F.col(f"row.{c}").alias(c) for c in docs.columns))


def log_odds(counts: DataFrame, toxic_docs: int, other_docs: int) -> DataFrame:
    """(token, weight, z) under a Dirichlet prior in proportion to the tokens' totals."""
    n1, n0 = float(toxic_docs), float(other_docs)
    weight = min(PRIOR, (n1 + n0) / 20)
    prior = (F.col("toxic") + F.col("other")) * (weight / (n1 + n0)) + 0.01
    a1, a0 = F.col("toxic") + prior, F.col("other") + prior
    odds = F.log(a1 / (n1 + weight + 1 - a1 + prior)) - F.log(a0 / (n0 + weight + 1 - a0 + prior))
    return counts.select("token", odds.alias("weight"), (odds / F.sqrt(1 / a1 + 1 / a0)).alias("z"))


def word_scores(found: W.Words, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each word's score: the greatest toxic log-odds of its tokens; without one the least
    log-odds of the others; the drift at least."""
    up, down = np.zeros(len(found.hash)), np.zeros(len(found.hash))
    if len(keys):
        for at, hashes in tokens_of(found):
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == hashes)
            own, at = weights[place[hit]], at[hit]
            up[at], down[at] = np.maximum(up[at], own), np.minimum(down[at], own)
    return np.where(up > 0, up, np.minimum(down, -DRIFT))


def segments(score: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) of one text, in linear time.

    Only positive scores open a segment, so the scan visits those and takes the sums
    between them from prefix sums.
    """
    up = np.flatnonzero(score > 0)
    if not len(up):
        return []
    sums = np.concatenate([[0.0], np.cumsum(score)])
    # sum before, sum after, start, end, and the nearest segment to the left with a smaller sum before:
    # a chain of such links is walked once, since its segments are merged or stay linked past
    stack: list[tuple[float, float, int, int, int]] = []
    for i, left, right in zip(up.tolist(), sums[up].tolist(), sums[up + 1].tolist(), strict=True):
        begin, j = i, len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                break
            left, _, begin, _, before = stack[j]
            del stack[j:]
            j = before
        stack.append((left, right, begin, i + 1, j))
    return [(b - a, s, e) for a, b, s, e, _ in stack]


def evidence(score: np.ndarray, decay: float, rate: float) -> tuple[float, float, list[tuple[float, int, int]]]:
    """Of the best segment and of all significant ones: minus the log of their expected counts."""
    found = segments(score)
    base = math.log(max(rate * max(len(score), 1), 1e-12))
    bits = [(decay * s - base, a, b) for s, a, b in found]
    bits = [x for x in bits if x[0] > 0]
    return max((x[0] for x in bits), default=0.0), sum(x[0] for x in bits), bits


def _scores(docs: DataFrame, model: Model, others: list[str]) -> DataFrame:
    """``others`` of each row, its evidence (best, total), score and spans."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo), W.ALNUM, lower=True)
                score = word_scores(found, model.keys, model.weights)
                best, total, own = [], [], []
                for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
                    x, y, bits = evidence(score[a:b], model.decay, model.rate)
                    best.append(x)
                    total.append(y)
                    own.append([{"start": s, "end": e, "evidence": v} for v, s, e in bits])
                x = np.column_stack([np.log1p(best), np.log1p(total)])
                p = sigmoid(np.column_stack([x, np.ones(len(x))]) @ model.fit)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in others), pa.array(best, pa.float64()), pa.array(total, pa.float64()), pa.array(p), pa.array(own, spans)],
                    [*others, "best", "total", "score", "spans"],
                )

    kinds = dict(docs.dtypes)
    return docs.select(*others, "text").mapInArrow(scan, ", ".join(f"{c} {kinds[c]}" for c in others) + ", best double, total double, score double, spans array<struct<start: bigint, end: bigint, evidence: double>>")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit the token weights, the extreme-value parameters and the calibration."""
    nothing = Model(np.zeros(0, W.U64), np.zeros(0), 1.0, 1.0, np.zeros(3))
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample(labels, label, SAMPLE)), "doc_id")
    labelled = keep(distinct_texts(labelled))
    counting = labelled.where(F.col("fold") != CALIBRATE)
    sizes = {r["y"]: r["n"] for r in counting.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return nothing
    odds = log_odds(token_counts(counting), sizes[1.0], sizes[0.0])
    top = odds.where(((F.col("z") >= SIGNIFICANT) & (F.col("weight") >= LEAST)) | ((F.col("z") <= -SIGNIFICANT) & (F.col("weight") < 0))).select("token", "weight").collect()
    keys = np.array([r["token"] for r in top], np.int64).view(W.U64)
    weights = np.array([r["weight"] for r in top])
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    # The decay of the extreme-value law solves sum p(s) exp(decay * s) = 1 over the
    # scores of a word of non-toxic text; its rate is the share of words that score.
    null = counting.where("y = 0").select("text")

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                score = word_scores(W.words(texts.slice(lo, hi - lo), W.ALNUM, lower=True), keys, weights)
                bins, count = np.unique(np.round(score, 2), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(count)], ["s", "n"])

    rows = null.mapInArrow(histogram, "s double, n bigint").groupBy("s").agg(F.sum("n").alias("n")).collect()
    s, n = np.array([r["s"] for r in rows]), np.array([r["n"] for r in rows], float)
    p = n / max(n.sum(), 1.0)
    decay, high = 0.0, 3.0
    if len(s) and (p * s).sum() < 0 and s.max() > 0:
        for _ in range(60):
            middle = (decay + high) / 2
            decay, high = (middle, high) if (p * np.exp(np.minimum(middle * s, 300))).sum() < 1 else (decay, middle)
    decay = decay or 1.0
    rate = max(float(p[s > 0].sum()), 1e-4)
    model = Model(keys, weights, max(decay, 0.05), rate, np.zeros(3))
    held = _scores(labelled.where(F.col("fold") == CALIBRATE), model, ["y"]).select("best", "total", "y").collect()
    if len({r["y"] for r in held}) == 2:
        model.fit = logistic(np.log1p([[r["best"], r["total"]] for r in held]), np.array([r["y"] for r in held]))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row of ``docs``."""
    return _scores(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
