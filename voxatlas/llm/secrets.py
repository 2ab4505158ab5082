"""Secrets in texts: fixed patterns, and random strings by Markov models (operator 8).

The fixed patterns give the base spans.  Their values, and the ordinary words of the
corpus, are the labelled samples of two character models (transition counts over a
small alphabet, gathered from all documents and added up by Spark); a long token whose
log-likelihood ratio per character favours the random model is a secret too.

Defined results: a null text counts as empty; without samples both models are equal
and add nothing; repeated rows are scanned each; an empty table gives no rows; other
columns are ignored.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W

#: The patterns of the base rules, the group that holds the value, its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Tokens that the models judge: long runs of the characters of keys, with a letter or a digit.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Mean log-likelihood ratio a character that a token must exceed, in nats.
THRESHOLD = 1.0
#: Pseudo-counts of a transition.
PRIOR = 0.5
KINDS = ("assign", "access", "hex", "markov")

_CODE = np.full(256, len(ALPHABET), np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_STATES = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules' matches."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _value(text: str, span: tuple[int, int, int]) -> str:
    start, kind, end = span
    return ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]


def transitions(tokens: list[str]) -> Counter:
    """Counts of character pairs; each token begins in the state after the alphabet."""
    joined = np.frombuffer(("\x00" + "\x00".join(tokens) + "\x00").encode("ascii", "replace"), np.uint8)
    code = _CODE[joined]
    return Counter(dict(enumerate(np.bincount(code[:-1] * _STATES + code[1:], minlength=_STATES * _STATES).tolist())))


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition, random strings against identifiers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, _STATES * _STATES), np.int64)
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                some: list[str] = []
                # ordinary identifiers: all words, as bytes; pairs within words only
                found = W.words(texts.slice(lo, hi - lo))
                code = _CODE[found.data]
                pair, inside = code[:-1] * _STATES + code[1:], (code[:-1] < _STATES - 1) & (code[1:] < _STATES - 1)
                edges = W.offsets(texts)[lo + 1 : hi] - W.offsets(texts)[lo]  # texts lie back to back
                inside[edges[(edges > 0) & (edges < len(code))] - 1] = False
                count[0] += np.bincount(pair[inside], minlength=_STATES * _STATES)
                for text in texts.slice(lo, hi - lo).cast(pa.large_string()).to_pylist():
                    some += [_value(text, span) for span in base_spans(text)]
                if some:
                    own = transitions(some)
                    pairs = np.array([own[k] for k in range(_STATES * _STATES)]).reshape(_STATES, _STATES)
                    pairs[-1, :] = pairs[:, -1] = 0
                    count[1] += pairs.ravel()
        random, place = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(random.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(count[random, place])], ["random", "place", "n"])

    rows = docs.select("text").mapInArrow(scan, "random int, place int, n bigint").groupBy("random", "place").agg(F.sum("n").alias("n")).collect()
    count = np.full((2, _STATES, _STATES), PRIOR)
    for r in rows:
        count[r["random"], r["place"] // _STATES, r["place"] % _STATES] += r["n"]
    if not any(r["random"] for r in rows):
        return np.zeros((_STATES, _STATES))
    count[0] -= np.minimum(count[1] - PRIOR, count[0] - PRIOR)  # the words include the random strings
    p = count / count.sum(axis=2, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def model_spans(text: str, ratio: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for m in TOKEN.finditer(text):
        token = m.group()
        if not any(c.isalnum() for c in token):  # a rule or a fence
            continue
        if any(start < m.end() and m.start() < end for start, _, end in base):
            continue
        code = _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
        if ratio[code[:-1], code[1:]].mean() > THRESHOLD:
            out.append((m.start(), 3, m.end()))
    return out


def find_secrets(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """(doc_id, found) with found = array of (kind, start, end), by start and kind."""
    if ratio is None:
        ratio = train(docs)
    kind = dict(docs.dtypes)["doc_id"]
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                found = []
                for text in texts.slice(lo, hi - lo).cast(pa.large_string()).to_pylist():
                    base = base_spans(text)
                    found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(base + model_spans(text, ratio, base))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found, spans)], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, found array<struct<kind: string, start: bigint, end: bigint>>")


def redacted(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """``text`` with ``mask`` in place of the spans; those that overlap give one mask."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, ratio: np.ndarray | None = None, mask: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets of each text replaced by ``mask``.

    Each row is scanned by itself, whatever its id; a null text stays null.
    """
    if ratio is None:
        ratio = train(docs)
    plain = docs.toDF(*(name if name == "text" else f"_{k}" for k, name in enumerate(docs.columns)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = []
            for text in batch.column(place).to_pylist():
                base = base_spans(text or "")
                texts.append(text and redacted(text, base + model_spans(text, ratio, base), mask))
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return plain.mapInArrow(scan, ", ".join(f"{c} {kind}" for c, kind in plain.dtypes)).toDF(*docs.columns)
