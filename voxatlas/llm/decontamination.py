"""Finding benchmark passages in documents with an FM-index (operator 9).

A window is ``window`` consecutive words of an item (an item of fewer words is one
window).  Only words that occur in a window's item can be part of an occurrence, so
each training shard (an Arrow batch of documents) first keeps its maximal runs of such
words, of the length of the shortest window at least; this loses no occurrence.
The runs are indexed: a suffix array by prefix doubling up to the longest window, the
Burrows-Wheeler transform, a wavelet tree whose bit vectors answer ranks, and every
eighth suffix position.  All windows are searched backwards at once, one rank query a
word; occurrences are located by walking to a sampled position, and their spans are
merged.

The items go to the tasks in blocks of a bounded size, as texts, each block searched in
all documents, so that no broadcast grows with the benchmark; a Python worker makes a
block's windows once, of about 60 times the bytes while it makes them.

Defined results: every row of the documents gives a row, also where rows repeat an id
and a text, and however many blocks there are; a null text has no words; an item without words, or null, is no
window; items that repeat an id are one item, and
so are those with a null id, whose windows hit as others do and which ``items`` names by a
null, last; an empty benchmark hits nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import keep

WINDOW = 13
#: Bytes of item text that one pass over the documents may carry to every task.
BLOCK_BYTES = 2_000_000
#: Every how many suffix positions one is kept.
SAMPLE = 8


class BitVector:
    """Ranks of ones by counts at every place."""

    def __init__(self, bits: np.ndarray):
        self.ones = np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        return self.ones[at]


class WaveletTree:
    """A wavelet matrix: ranks of any symbol, and the symbol at a place, by one bit vector a level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.vectors, self.zeros = levels, [], []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            self.vectors.append(BitVector(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def _down(self, vector: BitVector, zeros: int, ones: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = vector.rank(at)
        return np.where(ones, zeros + rank, at - rank)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        begin = np.zeros_like(at)
        for level, vector, zeros in zip(reversed(range(self.levels)), self.vectors, self.zeros, strict=True):
            ones = (symbol >> level) & 1 == 1
            at, begin = self._down(vector, zeros, ones, at), self._down(vector, zeros, ones, begin)
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for vector, zeros in zip(self.vectors, self.zeros, strict=True):
            ones = vector.rank(at + 1) - vector.rank(at) == 1
            symbol = symbol << 1 | ones
            at = self._down(vector, zeros, ones, at)
        return symbol


class FMIndex:
    """Index of an array of symbols 0..most; an end symbol of its own comes below them all."""

    def __init__(self, symbols: np.ndarray, most: int):
        text = np.append(symbols + 1, 0).astype(np.int64)
        rank, width = text, 1
        while True:  # ranks of the first 2, 4, 8, ... symbols, until all differ
            after = np.zeros_like(rank)
            after[:-width] = rank[width:] + 1
            key = rank * (int(after.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty_like(key)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            width *= 2
            if rank[order[-1]] == len(order) - 1 or width >= len(order):
                break
        self.tree = WaveletTree(text[order - 1], int(most + 1).bit_length())
        self.before = np.searchsorted(np.sort(text), np.arange(most + 3))
        self.sampled = np.where(order % SAMPLE == 0, order, -1)
        self.size = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern (all of one length)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for symbol in patterns.T[::-1] + 1:
            low = self.before[symbol] + self.tree.rank(symbol, low)
            high = self.before[symbol] + self.tree.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back in the text until a sampled position."""
        place, steps, open_ = np.full(len(rows), -1), 0, np.arange(len(rows))
        while len(open_):
            here = self.sampled[rows]
            found = here >= 0
            place[open_[found]] = here[found] + steps
            open_, rows = open_[~found], rows[~found]
            symbol = self.tree.access(rows)
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return place


class Windows:
    """The windows of a block of items, by their length."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        found = W.words(pa.array([(t or "").encode() for t in texts], pa.large_binary()), W.ALNUM, lower=True)
        count = np.diff(found.first)
        self.ids = np.array(ids, dtype=object)
        self.by_length = []
        for length in sorted({min(int(n), window) for n in count if n}):
            own = np.flatnonzero(count >= window if length == window else count == length)
            starts = np.concatenate([W.ranges(found.first[i : i + 1], np.array([count[i] - length + 1])) for i in own])
            item = np.repeat(own, count[own] - length + 1)
            words = found.hash[starts[:, None] + np.arange(length)]
            vocabulary = np.unique(words)
            patterns, which = np.unique(np.searchsorted(vocabulary, words) + 1, axis=0, return_inverse=True)
            order = np.argsort(which, kind="stable")
            self.by_length.append((length, vocabulary, patterns, item[order], np.searchsorted(which[order], np.arange(len(patterns) + 1))))

    def occurrences(self, found: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, item) of every window's occurrences, ``start`` counting the words of all texts."""
        out = [[], [], []]
        for length, vocabulary, patterns, item, first in self.by_length:
            place = np.minimum(np.searchsorted(vocabulary, found.hash), len(vocabulary) - 1)
            inside = vocabulary[place] == found.hash
            # maximal runs of such words within a text
            cut = np.zeros(len(inside) + 1, bool)
            cut[found.first] = True
            begins = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
            ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
            long = ends - begins >= length
            begins, sizes = begins[long], (ends - begins)[long]
            if not len(begins):
                continue
            source = W.ranges(begins, sizes + 1)  # the word after a run stands for its separator
            symbols = np.where(np.arange(len(source)) == np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1), 0, place[np.minimum(source, len(place) - 1)] + 1)
            index = FMIndex(symbols, len(vocabulary))
            low, high = index.search(patterns)
            which = np.repeat(np.arange(len(patterns)), high - low)
            starts = source[index.locate(W.ranges(low, high - low))]
            each = (first[1:] - first[:-1])[which]
            out[0].append(np.repeat(starts, each))
            out[1].append(np.full(int(each.sum()), length))
            out[2].append(item[W.ranges(first[:-1][which], each)])
        return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in out)


#: The windows that a Python worker has made last, by their block.
_MADE: dict[str, Windows] = {}


def _windows(block: str, ids: list[str], texts: list[str], window: int) -> Windows:
    if block not in _MADE:
        _MADE.clear()
        _MADE[block] = Windows(ids, texts, window)
    return _MADE[block]


def _merged(gone: np.ndarray) -> list[dict]:
    turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = "n_words bigint, n_hit bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def _search(docs: DataFrame, ids: list[str], item_texts: list[str], window: int) -> DataFrame:
    """``docs`` with n_words, n_hit, spans and items of one block's windows in place of the text."""
    others = [c for c in docs.columns if c != "text"]
    block = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(block, ids, item_texts, window)
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo), W.ALNUM, lower=True)
                start, length, item = windows.occurrences(found)
                gone = W.covered(start, length, len(found.hash))
                doc = np.searchsorted(found.first, start, side="right") - 1
                pairs = np.unique(doc * max(1, len(windows.ids)) + item)
                own, item = pairs // max(1, len(windows.ids)), pairs % max(1, len(windows.ids))
                first = np.searchsorted(own, np.arange(hi - lo + 1))
                hit = np.concatenate([[0], np.cumsum(gone)])
                hit = hit[found.first[1:]] - hit[found.first[:-1]]
                spans = [_merged(gone[a:b]) if n else [] for n, a, b in zip(hit.tolist(), found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)]
                items = [sorted(set(windows.ids[item[a:b]]), key=lambda x: (x is None, x)) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in others), pa.array(np.diff(found.first)), pa.array(hit), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                    [*others, "n_words", "n_hit", "spans", "items"],
                )

    return docs.mapInArrow(scan, ", ".join(f"{c} {kind}" for c, kind in docs.dtypes if c != "text") + ", " + _FOUND)


def _joined(first: DataFrame, others: list[DataFrame]) -> DataFrame:
    """``first``, which has every row, with the spans and items of all blocks: spans merged, items together.

    Equal rows of one id have equal spans, so each is given what any of them has.
    """
    fold = """aggregate(array_sort(flatten(collect_set(spans))), cast(array() as array<struct<start: bigint, end: bigint>>),
        (a, s) -> if(size(a) > 0 and element_at(a, -1).end >= s.start,
            concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, s.end) as end))),
            concat(a, array(s))))"""
    hits = first.where("n_hit > 0")
    for more in others:
        hits = hits.unionByName(more)
    merged = (
        hits.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
        .agg(F.expr(fold).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"))
    )
    rows = first.select("doc_id", "row", "n_words")
    return rows.join(merged, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left").select(
        "doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.expr("coalesce(spans, array())").alias("spans"), F.expr("coalesce(items, array())").alias("items")
    )


def find_passages(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of each document lie in benchmark windows.

    Columns: doc_id, row (its text's hash), n_words, n_hit, spans (merged, in words: start and end), items
    (the ids of the items with an occurring window, as sorted text) and contaminated,
    which holds where a twentieth of the words or more are hit.
    """
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-int(items.agg(F.sum(F.octet_length("text") + 64)).head()[0] or 0) // block_bytes))
    found = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        hits = _search(docs, [r["id"] for r in rows], [r["text"] for r in rows], window)
        found.append(hits if blocks == 1 else keep(hits if not block else hits.where("n_hit > 0")))
    if blocks == 1:
        out = found[0]
    else:
        out = _joined(found[0], found[1:])
    return out.select("doc_id", "row", "n_words", "n_hit", "spans", "items", F.expr("n_hit > 0 and 20 * n_hit >= n_words").alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = find_passages(docs, benchmark, **options).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_row"]), "left_anti")
