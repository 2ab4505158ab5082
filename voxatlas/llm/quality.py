"""Quality by a random-feature kernel machine over document statistics (operator 3).

Every text gives some statistics of its words, lines and characters.  Random Fourier
features (cosines of random projections) approximate a Gaussian kernel over them;
ridge regression on the features is fitted by normal equations, which each partition
of the labelled sample sums for itself; isotonic regression on labelled documents that
the fit has not seen turns its values into probabilities.

Defined results: null and empty texts have all statistics 0 and a score like any
other; without labels every score is 0.5; repeated rows are scored each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import held_out, keep
from voxatlas.llm.labelled import isotonic, sample, sigmoid

#: Labelled documents of each class that the fit may use.
SAMPLE = 20_000
#: Random features, the kernel's width in standard deviations, and the ridge.
FEATURES, WIDTH, RIDGE = 256, 4.0, 1e-3
#: Fold of the labelled rows that calibrates; the others fit.
CALIBRATE = 1
#: Partitions at most that sum the normal equations, each sending one matrix.
PARTS = 8

STATISTICS = ("log_words", "word_length", "upper", "digits", "punctuation", "symbols", "pipes", "exclamations", "distinct_words", "distinct_triples", "top_word", "repeated_lines", "line_words", "long_words", "stops", "distinct_tail")

_UPPER = W.byte_table(lambda b: 0x41 <= b <= 0x5A)
_DIGIT = W.byte_table(lambda b: 0x30 <= b <= 0x39)
_POINT = W.byte_table(lambda b: chr(b) in ".,;:?'\"()-")
_SIGN = W.byte_table(lambda b: chr(b) in "#*$%&<>{}[]\\/=+_~^@")
_LINE = W.byte_table(lambda b: b != 0x0A)


def _share_distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: the number of distinct hashes, and the count of the most frequent."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, int)
    most = np.zeros(n)
    np.maximum.at(most, d[new], np.diff(np.append(new, len(h))))
    return np.bincount(d[new], minlength=n), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    found = W.words(texts)
    n = len(texts)
    at = W.offsets(texts) - W.offsets(texts)[0]
    words = np.diff(found.first)
    size = np.maximum(np.diff(at), 1)
    some = np.maximum(words, 1)

    def share(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[found.data])])
        return (sums[at[1:]] - sums[at[:-1]]) / size

    def mean(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return (sums[found.first[1:]] - sums[found.first[:-1]]) / some

    length = found.end - found.start
    doc = found.doc
    distinct, top = _share_distinct(found.hash, doc, n)
    triples = W.inside_runs(found.first, 3)
    triple_doc = doc[triples] if len(triples) else np.zeros(0, int)
    distinct3, _ = _share_distinct(W.run_hashes(found.hash, triples, 3), triple_doc, n)
    lines = W.words(texts, _LINE)
    line_doc = lines.doc
    distinct_lines, _ = _share_distinct(lines.hash, line_doc, n)
    line_count = np.maximum(np.diff(lines.first), 1)
    tail = np.arange(len(doc)) - found.first[:-1][doc] >= words[doc] // 2
    distinct_tail, _ = _share_distinct(found.hash[tail], doc[tail], n)
    return np.column_stack(
        [
            np.log1p(words),
            mean(length),
            share(_UPPER),
            share(_DIGIT),
            share(_POINT),
            share(_SIGN),
            share(W.byte_table(lambda b: b == 0x7C)),
            share(W.byte_table(lambda b: b == 0x21)),
            distinct / some,
            distinct3 / np.maximum(words - 2, 1),
            top / some,
            1 - distinct_lines / line_count,
            np.log1p(words / line_count),
            mean(length > 20),
            mean(length <= 3),
            distinct_tail / np.maximum(words - words // 2, 1),
        ]
    )


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.column_stack([np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases)), np.ones(len(x))])

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        raw = self.features(x) @ self.weights
        # a thousandth of the score keeps the order of the fit within level steps
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * sigmoid(4 * (raw - 0.5))


def _statistics(docs: DataFrame, others: list[str], model: Model | None = None) -> DataFrame:
    """``others`` of each row and its statistics ``x``, or with a model its score."""
    name, kind = ("x", pa.list_(pa.float64())) if model is None else ("score", pa.float64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                x = statistics(texts.slice(lo, hi - lo))
                out = pa.array(list(x), kind) if model is None else pa.array(model.predict(x))
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in others), out], [*others, name])

    kinds = dict(docs.dtypes)
    return docs.select(*dict.fromkeys([*others, "text"])).mapInArrow(scan, ", ".join(f"{c} {kinds[c]}" for c in others) + (", x array<double>" if model is None else ", score double"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    width = len(STATISTICS)
    model = Model(np.zeros(width), np.ones(width), rng.normal(size=(width, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    chosen = F.broadcast(sample(labels, label, SAMPLE))
    known = keep(_statistics(docs.select("doc_id", "text").join(chosen, "doc_id"), ["doc_id", "y", "fold"]))
    fitting = known.where(F.col("fold") != CALIBRATE)
    moments = fitting.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    if not moments:
        return model
    for r in moments:
        model.mean[r["k"]], model.spread[r["k"]] = r["m"], max(r["s"], 1e-6)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            if batch.num_rows:
                z = model.features(np.array(batch.column(0).flatten()).reshape(-1, width))
                gram += z.T @ z
                right += z.T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary()), pa.array([right.tobytes()], pa.binary())], ["gram", "right"])

    sums = fitting.select("x", "y").coalesce(PARTS).mapInArrow(equations, "gram binary, right binary").collect()
    gram = sum(np.frombuffer(r["gram"]).reshape(FEATURES + 1, -1) for r in sums)
    right = sum(np.frombuffer(r["right"]) for r in sums)
    count = gram[-1, -1]
    model.weights = np.linalg.solve(gram + RIDGE * count * np.eye(len(gram)), right)
    held = known.where(F.col("fold") == CALIBRATE).select("x", "y").collect()
    if not held:
        held = fitting.select("x", "y").collect()
    raw = model.features(np.array([r["x"] for r in held])) @ model.weights
    model.knots, model.values = isotonic(raw, np.array([r["y"] for r in held]))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    return _statistics(docs, ["doc_id"], model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns."""
    plain = docs.toDF(*(name if name == "text" else f"_{k}" for k, name in enumerate(docs.columns)))
    return _statistics(plain, plain.columns, model).where(F.col("score") >= threshold).drop("score").toDF(*docs.columns)
