"""Exact removal of long repeated spans by de Bruijn compaction (operator 4).

The graph: every run of ``window`` words is an edge, joining its first and last
``window - 1`` words.  A path is stored compacted: consecutive edges that share
their minimiser (the ``k``-word run of least hash among those inside the edge)
form one row, keyed by that anchor.  Anchors depend on content alone, so equal edges
always lie under equal anchors, and some seven rows stand for a hundred words.

Spark joins then resolve the graph.  An anchor that only one document has is not
repeated.  Paths under the others are read again at their source coordinates, which
gives each the digest of its words.  A repeated path that is the same wherever it
occurs does not branch: it belongs as a whole to the least document that has it, and
the others lose it.  Only where an anchor carries different paths are they taken apart
into single edges, each read at its source coordinates too and given to the least
document that has it.  No pair of documents is ever formed, so a group of copies costs
its size.

Defined results: a null text has no words; rows with a null id are neither source
nor reduced; rows that repeat an id are documents of their own, which do not remove
from each other; an empty table gives no rows; other columns are ignored.
Words are removed on equal BLAKE2b digests (of 128 bits) of the spans themselves; the
hashes of anchors only choose what is read again, and may collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import keep

WINDOW = 50
ANCHOR = 25

#: Low bits of a packed minimiser that hold its position within a chunk.
POSITION_BITS = W.U64(28)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchored(found: W.Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first word and number of edges of each compacted path."""
    starts = W.inside_runs(found.first, window)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty.astype(W.U64), empty, empty
    n = len(found.hash) - k + 1
    grams = W.run_hashes(found.hash, np.arange(n), k)
    low = (W.U64(1) << POSITION_BITS) - W.U64(1)
    least = sliding_min((grams & ~low) | np.arange(n, dtype=W.U64), window - k + 1)[starts]
    place = (least & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    return grams[place[at]], starts[at], np.diff(np.append(at, len(starts)))


def span_digests(found: W.Words, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Digest of the words ``first[i] : first[i] + length[i]``, joined by one space, for every i: two numbers each."""
    if not len(first):
        return np.zeros((0, 2), W.U64)
    size = found.end - found.start + 1
    joined = found.data[np.minimum(W.ranges(found.start, size), len(found.data) - 1)]
    at = np.concatenate([[0], np.cumsum(size)])
    joined[at[1:] - 1] = 0x20
    view = memoryview(joined.tobytes())
    digests = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(at[first].tolist(), (at[first + length] - 1).tolist(), strict=True)]
    return np.frombuffer(b"".join(digests), W.U64).reshape(-1, 2)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _binary(digests: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(digests), [None, pa.py_buffer(digests.tobytes())]).cast(pa.binary())


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(at, len(values)).astype(np.int32)), pa.array(values.astype(np.int32)))


def compacted_paths(docs: DataFrame, window: int, k: int, hash_bits: int = 64) -> DataFrame:
    """(doc_id, row, anchor, edges, firsts): the compacted paths, with all places in a text that have the same anchor and size."""
    mask = W.U64((1 << hash_bits) - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo))
                anchor, first, edges = anchored(found, window, k)
                if not len(first):
                    continue
                anchor &= mask
                doc = np.searchsorted(found.first, first, side="right") - 1
                # a text that repeats itself has the same path again and again: one row
                order = np.lexsort((edges, anchor, doc))
                doc, anchor, first, edges = (x[order] for x in (doc, anchor, first, edges))
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (edges[1:] != edges[:-1])
                at = np.flatnonzero(new)
                rows = pa.array(doc[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), _signed(anchor[at]), pa.array(edges[at].astype(np.int32)), _lists(first - found.first[doc], at)],
                    ["doc_id", "row", "anchor", "edges", "firsts"],
                )

    return docs.mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, row bigint, anchor bigint, edges int, firsts array<int>")


def read_again(docs: DataFrame, paths: DataFrame, window: int, single: bool) -> DataFrame:
    """(doc_id, row, anchor, digest, edges, firsts) of ``paths``, read from the texts at their places.

    Whole paths, or with ``single`` each edge of theirs; places of one text with the same
    digest are one row.
    """
    wanted = paths.select("doc_id", "row", F.explode("firsts").alias("first"), "edges", "anchor").groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "edges", "anchor")).alias("paths"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            lists = batch.column(batch.schema.get_field_index("paths"))
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo))
                part = lists.slice(lo, hi - lo)
                own = part.flatten()
                doc = np.repeat(np.arange(hi - lo), part.value_lengths().to_numpy())
                first, edges, anchor = (own.field(k).to_numpy() for k in ("first", "edges", "anchor"))
                first, edges = first.astype(np.int64) + found.first[doc], edges.astype(np.int64)
                if single:
                    first, doc, anchor, edges = W.ranges(first, edges), np.repeat(doc, edges), np.repeat(anchor, edges), np.ones(int(edges.sum()), np.int64)
                digest = span_digests(found, first, edges + window - 1)
                order = np.lexsort((digest[:, 1], digest[:, 0], anchor, doc))
                doc, anchor, first, edges, digest = (x[order] for x in (doc, anchor, first, edges, digest))
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1]).any(axis=1)
                at = np.flatnonzero(new)
                rows = pa.array(doc[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(anchor[at]), _binary(digest[at]), pa.array(edges[at].astype(np.int32)), _lists(first - found.first[doc], at)],
                    ["doc_id", "row", "anchor", "digest", "edges", "firsts"],
                )

    joined = docs.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "paths")
    return joined.mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, row bigint, anchor bigint, digest binary, edges int, firsts array<int>")


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, hash_bits: int = 64) -> DataFrame:
    """(doc_id, row, start, length): word spans that start in a document of smaller id too.

    ``docs`` has doc_id, row (which tells rows of one id apart) and text.
    """
    paths = keep(compacted_paths(docs, window, k, hash_bits))
    repeated = paths.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    paths = keep(read_again(docs, paths.join(repeated, "anchor"), window, single=False))
    owners = keep(paths.groupBy("anchor", "digest").agg(F.min("doc_id").alias("owner")))
    branching = owners.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    owned = paths.join(owners.join(branching, "anchor"), ["anchor", "digest"]).where("doc_id = owner").select("doc_id", "row", "anchor", "edges", "firsts")
    edges = keep(read_again(docs, owned, window, single=True))
    least = edges.groupBy("anchor", "digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("most")).where("owner < most").drop("most")
    taken = [part.join(own, ["anchor", "digest"]).where("doc_id > owner").select("doc_id", "row", F.explode("firsts").alias("start"), (F.col("edges") + (window - 1)).alias("length")) for part, own in ((paths, owners), (edges, least))]
    return taken[0].unionByName(taken[1])


def remove_repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, with_text: bool = True, hash_bits: int = 64) -> DataFrame:
    """Each document without the words of its repeated spans.

    Columns: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), spans (merged, in words: start and end), and with ``with_text`` the kept
    words as text.  Anchors of fewer ``hash_bits`` cost time and change nothing.
    """
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(docs, window, k, hash_bits).groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.column(batch, "text")
            lists = batch.column(batch.schema.get_field_index("spans"))
            for lo, hi in W.slices(texts):
                found = W.words(texts.slice(lo, hi - lo))
                part = lists.slice(lo, hi - lo)
                own = part.flatten()
                doc = np.repeat(np.arange(hi - lo), part.value_lengths().fill_null(0).to_numpy())
                starts = own.field("start").to_numpy().astype(np.int64) + found.first[doc]
                gone = W.covered(starts, own.field("length").to_numpy().astype(np.int64), len(found.hash))
                data = found.data.tobytes()
                removed, digest, merged, kept_texts = [], [], [], []
                for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
                    mine = gone[a:b]
                    left = np.flatnonzero(~mine) + a
                    kept = b" ".join([data[s:e] for s, e in zip(found.start[left].tolist(), found.end[left].tolist(), strict=True)])
                    removed.append(int(mine.sum()))
                    digest.append(hashlib.sha256(kept).hexdigest())
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                    merged.append([{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()])
                    kept_texts.append(kept.decode())
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(found.first)), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
                if with_text:
                    columns.append(pa.array(kept_texts, pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return (
        docs.join(spans, ["doc_id", "row"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>" + ", kept_text string" * with_text)
    )
