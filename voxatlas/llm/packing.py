"""Packing token ids into fixed windows by best-fit decreasing.

Operators 1 and 7.  Each document is tokenised once, in Arrow batches, and cut:
a document longer than a window gives full windows first, then one rest.  Pieces
are dealt to hash groups of a bounded size; each group is packed by itself, in
decreasing length, a segment tree over the remaining capacities naming the
tightest open window.  No group grows with the corpus, only their number does.

Defined results: a null text counts as empty, and an empty document is its end
id alone; repeated rows and repeated ids are packed as rows of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import groups_of

WINDOW = 2048
END_ID = 1
#: Bytes of text per packing group: about a thousand windows.
GROUP_BYTES = 2_000_000
#: Bytes of text whose distinct words are tokenised together.
CHUNK_BYTES = 2_000_000

_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Parts end at a blank or a line break only: both are white space to any tokenizer.
SPACED = W.byte_table(lambda b: b not in (0x20, 0x0A))
#: Parts whose ids a Python worker remembers (about 40 bytes each).
REMEMBERED = 500_000


class Encoder:
    """Token ids of whole texts.

    In a tokenizer whose tokens end with words (it marks them by a suffix) the ids of
    a text are those of its spaced parts, one after the other.  Distinct parts are
    tokenised once and their ids remembered under the part's hash.  A part that is one
    run of letters, a final point or comma aside, is looked up in lower case and skips
    normalisation and splitting, which leave it whole.  Other tokenizers get the texts
    as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if self.suffix and token.endswith(self.suffix)]] = True
        self.marks = np.zeros(256, "<u4")
        for mark in ".," if self.suffix else "":
            self.marks[ord(mark)] = self._whole([mark])[0][0]
        self._forget()

    @staticmethod
    def of(path: str | None) -> "Encoder":
        path = path or default_tokenizer()
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def _forget(self) -> None:
        self.keys, self.begin, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _whole(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, runs: list[str], other: list[str]) -> None:
        """Remember the ids of runs of letters, then of other parts; ``keys`` are in that order."""
        ids = np.array(self.model.encode(" ".join(runs), add_special_tokens=False).ids if runs else [], "<u4")
        size = np.diff(np.concatenate([[-1], np.flatnonzero(self.ends[ids])]))
        if len(size) != len(runs):
            raise ValueError("a run of letters is not one word to this tokenizer")
        rest = self._whole(other)
        size = np.concatenate([size, [len(x) for x in rest]]).astype(np.int64)
        pool = np.concatenate([ids, *(np.array(x, "<u4") for x in rest)]) if rest else ids
        begin = np.cumsum(size) - size + len(self.pool)
        self.pool = np.concatenate([self.pool, pool])
        keys, begin, size = (np.concatenate(x) for x in ((self.keys, keys), (self.begin, begin), (self.size, size)))
        order = np.argsort(keys)
        self.keys, self.begin, self.size = keys[order], begin[order], size[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(first, ids): ``first[d]:first[d + 1]`` are the ids of text d, as uint32."""
        if not self.suffix:
            ids = self._whole(texts.cast(pa.large_string()).to_pylist())
            return np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64), np.array([i for x in ids for i in x], "<u4")
        found = W.words(texts, SPACED)
        start, end, data = found.start, found.end, found.data
        if not len(start):
            return found.first, np.zeros(0, "<u4")
        low, letter = fold(data)
        mark = self.marks[data[end - 1]] * (end - start > 1)
        stop = end - (mark > 0)
        strange = np.concatenate([[0], np.cumsum(~letter)])
        run = strange[start] == strange[stop]
        mark, stop = np.where(run, mark, 0), np.where(run, stop, end)
        keys = found.hash.copy()
        keys[run] = ~W.word_hashes(low, start[run], stop[run])
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        distinct, one = ordered[new], order[new]
        place = self._places(distinct, one, run, low.tobytes(), data.tobytes(), start, stop)[which]
        size = self.size[place]
        length = size + (mark > 0)
        at = np.concatenate([[0], np.cumsum(length)])
        ids = np.empty(at[-1], "<u4")
        ids[W.ranges(at[:-1], size)] = self.pool[W.ranges(self.begin[place], size)]
        marked = np.flatnonzero(mark)
        ids[at[marked + 1] - 1] = mark[marked]
        return at[found.first], ids

    def _places(self, keys: np.ndarray, one: np.ndarray, run: np.ndarray, low: bytes, data: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where each of the distinct keys is remembered; learns those that are not."""
        if len(self.keys) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            is_run = run[one[new]]
            learn = [(keys[new][kind], one[new][kind], source) for kind, source in ((is_run, low), (~is_run, data))]
            texts = [[source[a:b].decode() for a, b in zip(start[at].tolist(), stop[at].tolist(), strict=True)] for _, at, source in learn]
            self._learn(np.concatenate([learn[0][0], learn[1][0]]), *texts)
            place = np.searchsorted(self.keys, keys)
        return place


def id_type(tokenizer: str | None, window: int, *more: int) -> str:
    """The unsigned little-endian type that holds every id, and every position within a window."""
    from tokenizers import Tokenizer

    most = max(*Tokenizer.from_file(tokenizer or default_tokenizer()).get_vocab().values(), window - 1, *more)
    if most >= 1 << 32:
        raise ValueError("ids and positions have 32 bits at most")
    return "<u2" if most < 1 << 16 else "<u4"


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 text with A-Z and U+00C0 to U+00DE in lower case, and which bytes belong to letters below U+0100."""
    low = W.LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    low[second & (data >= 0x80) & (data <= 0x9E)] += 0x20
    letter = (low >= 0x61) & (low <= 0x7A) & (data < 0x80) | second
    letter[:-1] |= second[1:]
    return low, letter


def pieces(docs: DataFrame, *, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None, with_ids: str = "", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenised documents cut into pieces of at most ``window`` ids.

    Columns: the id, start, length, ids_crc32, doc_tokens, copy (the number of equal rows
    before this one among those that a task reads at once), and with ``with_ids``, the
    name of a type (see ``id_type``), the ids.
    """
    kind = dict(docs.dtypes)[id_column]
    fields = f"{id_column} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, copy bigint" + ", ids binary" * bool(with_ids)
    end = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            texts = W.column(batch, text_column)
            ids = batch.column(batch.schema.get_field_index(id_column))
            for lo, hi in W.slices(texts, CHUNK_BYTES):
                row, start, length, crc, total, copy, raw = [], [], [], [], [], [], []
                seen: Counter = Counter()
                first, tokens = encoder.encode(texts.slice(lo, hi - lo))
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True), lo):
                    one = np.concatenate([tokens[a:b], end])
                    own = (ids[k].as_py(), len(one), zlib.crc32(one.tobytes()))
                    seen[own] += 1
                    for c in range(0, len(one), window):
                        part = one[c : c + window]
                        row.append(k)
                        start.append(c)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        total.append(len(one))
                        copy.append(seen[own] - 1)
                        if with_ids:
                            raw.append(part.astype(with_ids).tobytes())
                columns = [ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, copy))]
                names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "copy"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, text_column).mapInArrow(cut, fields)


class CapacityTree:
    """Segment tree over capacities 0..most: finds the least capacity of an open window that fits."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, which: int) -> None:
        self.open[capacity].append(which)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity of an open window that is at least ``need``."""
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:  # climb until a right sibling has an open window, then descend to its least leaf
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node *= 2
                    if not self.count[node]:
                        node += 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, capacity: int) -> int:
        node = capacity + self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; the lengths come in decreasing order."""
    tree, used = CapacityTree(window), 0
    where, offset = [], []
    for n in lengths:
        capacity = tree.tightest(n) if n < window else None
        if capacity is None:
            which, capacity = used, window
            used += 1
        else:
            which = tree.take(capacity)
        where.append(which)
        offset.append(window - capacity)
        if capacity > n:
            tree.add(capacity - n, which)
    return where, offset


def _grouped(docs: DataFrame, parts: DataFrame, id_column: str, text_column: str, group_bytes: int) -> DataFrame:
    n = groups_of(docs, F.coalesce(F.octet_length(text_column), F.lit(0)) + 64, group_bytes)
    # equal pieces (of rows that repeat) are told apart by the task that reads them and by their
    # number in it, which stay the same if the task is run again, so that no group holds all of them
    return parts.withColumn("_group", F.pmod(F.xxhash64(id_column, "start", "ids_crc32", F.spark_partition_id(), "copy"), F.lit(n))).drop("copy")


def _order(group: pd.DataFrame, id_column: str) -> pd.DataFrame:
    return group.sort_values(["length", id_column, "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)


def pack(docs: DataFrame, *, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None, group_bytes: int = GROUP_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Where each piece of each document goes: one row per piece.

    Columns: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    padded_length, which is the window, or the sequence's own length where that is a
    power of two.
    """
    parts = pieces(docs, window=window, end_id=end_id, tokenizer=tokenizer, id_column=id_column, text_column=text_column)
    kind = dict(docs.dtypes)[id_column]

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = _order(group, id_column)
        where, offset = best_fit(group["length"].tolist(), window)
        group["sequence_id"] = (group["_group"].to_numpy() << 32) + np.array(where, np.int64)
        group["offset"] = np.array(offset, np.int64)
        filled = group.groupby("sequence_id")["length"].transform("sum")
        group["padded_length"] = np.where(filled & (filled - 1) == 0, filled, window)
        return group.drop(columns="_group")

    return (
        _grouped(docs, parts, id_column, text_column, group_bytes)
        .groupBy("_group")
        .applyInPandas(place, f"{id_column} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, padded_length bigint")
    )


def packed_matrices(docs: DataFrame, *, window: int = WINDOW, end_id: int = END_ID, pad_id: int = 0, tokenizer: str | None = None, group_bytes: int = GROUP_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Packed id matrices: one row per sequence of ``window`` ids.

    Columns: sequence_id; ids (little-endian uint16, or uint32 where an id or a position
    needs it: ``id_type``; padded with ``pad_id``); positions (of the same type,
    starting again at 0 with each piece and in the padding);
    cu_seqlens (0, then the cumulative lengths of the pieces); n_tokens; pieces (the
    id, start and length of each piece, in their order).  Cutting loses nothing:
    the pieces of a document, in order of start, hold its ids.
    """
    stored = id_type(tokenizer, window, end_id, pad_id)
    parts = pieces(docs, window=window, end_id=end_id, tokenizer=tokenizer, with_ids=stored, id_column=id_column, text_column=text_column)
    kind = dict(docs.dtypes)[id_column]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = _order(group, id_column)
        where, offset = best_fit(group["length"].tolist(), window)
        count = max(where) + 1
        ids = np.full((count, window), pad_id, stored)
        positions = np.zeros((count, window), stored)
        held: list[list[int]] = [[] for _ in range(count)]
        for k, (which, at, raw) in enumerate(zip(where, offset, group["ids"], strict=True)):
            part = np.frombuffer(raw, stored)
            ids[which, at : at + len(part)] = part
            positions[which, at : at + len(part)] = np.arange(len(part))
            held[which].append(k)
        doc, start, length = (group[c].tolist() for c in (id_column, "start", "length"))
        ends = [np.cumsum([0] + [length[k] for k in own]).tolist() for own in held]
        for which, end in enumerate(ends):
            positions[which, end[-1] :] = np.arange(window - end[-1])
        return pd.DataFrame(
            {
                "sequence_id": (int(group["_group"].iloc[0]) << 32) + np.arange(count, dtype=np.int64),
                "ids": [row.tobytes() for row in ids],
                "positions": [row.tobytes() for row in positions],
                "cu_seqlens": ends,
                "n_tokens": [end[-1] for end in ends],
                "pieces": [[{id_column: doc[k], "start": start[k], "length": length[k]} for k in own] for own in held],
                "dtype": np.dtype(stored).name,
            }
        )

    return (
        _grouped(docs, parts, id_column, text_column, group_bytes)
        .groupBy("_group")
        .applyInPandas(build, f"sequence_id bigint, ids binary, positions binary, cu_seqlens array<int>, n_tokens int, pieces array<struct<{id_column}: {kind}, start: bigint, length: bigint>>, dtype string")
    )


def write_matrices(matrices: DataFrame, path: str, mode: str = "error") -> None:
    """Write packed matrices to a shared path, as Parquet that any reader can map to rows of ids."""
    matrices.write.mode(mode).option("compression", "zstd").parquet(path)

