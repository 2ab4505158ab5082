"""Documents linked by the Jaccard similarity of word shingles (operator 5).

Parity sketches: a document's shingle set is dealt by hash to m blocks, and a
block's word of 64 parity bits is the XOR of its shingles' hashes.  A shingle that
only one of two sets has changes one block, so the number of blocks that differ (the
Hamming distance over blocks) is at most the symmetric difference.  Two sets of
about n shingles that reach the similarity differ in few shingles; with m above
that bound, at least one block is equal, and equal blocks are found by a join.  m
depends on the size, so sizes form bands, and a set that may have a smaller partner in
the band below is sketched for that band too.

Which blocks take part is decided by content alone, in a way that loses no link.  A
block of fewer than ``LEAST`` shingles says little and is left out whenever the blocks
that stay outnumber the possible differences: then a staying block is equal, and the
partner keeps it too.  A set for which they don't is dealt again, by another hash, as
often as needed; the last time all its blocks stay.

Each set has a sketch of single parity bits besides, some for each possible difference.
The Hamming distance of two sketches is at most the symmetric difference, so pairs
beyond the bound go before any text is read; the others are verified on the texts.

Sets of equal content are one class.  Sets with an equal block form a group.  As many
blocks stay as may differ, and more, so two linked sets have several in common, and each
leaves the most frequent of these out but for one (a prefix filter): texts with no more than
a phrase in common form no group.  The sets of groups, and no others, form groups anew by
single shingles, of which linked sets have most in common, so that most may be left out:
texts with several phrases in common form no group either, however many have them.  Groups of
``FEW`` sets or fewer give pairs, which the sketches sift.  No larger group is turned into
pairs.  Its pivot, the set whose shingles are shared the most, is compared with every other; what links forms components.  Where a group still holds
several components, its sets are told apart by what they change of the pivot: two sets
that are not both linked to the pivot can link only if they differ from it in the same
shingles (with x and y shingles between them and the pivot, their distance is x + y
less twice the overlap of those), and the bound on the overlap leaves a few changes of
each set, by any common order, to meet on (a prefix filter).  Changes that ``PAIRED``
sets or fewer have in common give pairs.  Sets that meet on others are taken again, with
their rarest changes first; those that even then meet on a frequent change are much
alike, form a group of the next level, and are compared with a pivot of their own.  So
n near copies cost some n comparisons a level, not pairs; only what is left after
``LEVELS`` levels, if anything, is compared pair by pair.

Defined results: a null or empty text has no shingles, is linked with nothing and is
its own component; a null id gets the component of its text's other copies, if any;
rows that repeat an id with several texts are several sets of one document, each with
the component of its own text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxatlas.llm import words as W
from voxatlas.llm.common import drop, keep, kept, maybe_among, settled
from voxatlas.llm.components import components

#: Turns of dealing a set to blocks; in the last, all blocks take part.
TURNS = 8
#: Shingles that a block needs at most, and in bands of sets smaller than ``SMALL``.
LEAST, LEAST_SMALL, SMALL = 3, 2, 31
#: Blocks for each possible difference, over the one that is needed, to choose from.
SLACK = (1.3, 1.5, 1.8, 2.2, 3.0)
#: Blocks that should stay, on average, for each possible difference.
MARGIN = 1.12
#: Parity bits of a sketch for each possible difference, at least.
BITS = 8
#: Sets at most that meet on a shingle in pairs; larger groups have a pivot.
FEW = 8
#: Sets at most that meet on a change in pairs.
PAIRED = 16
#: Levels of groups with pivots of their own; what is left is compared pair by pair.
LEVELS = 3


class Bands:
    """Size bands for links of percent * |A or B| <= 100 * |A and B|."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lower = [1]
        # below the first bound, only equal sets can reach the similarity
        first = 1
        while self.differences(first) == 0 and first < 100_000:
            first += 1
        self.lower.append(first)
        # a set of s shingles differs in s / per of them: blocks have per / slack on average
        per = (100 + percent) / (100 - percent) / (1 + 100 / percent)
        stays = lambda c, k: k * (1 - sum(math.exp(-per / k) * (per / k) ** i / math.factorial(i) for i in range(c)))
        fit = [(c, k) for c in range(LEAST, 0, -1) for k in SLACK if stays(c, k) >= MARGIN]
        self.fewest, self.slack = fit[0] if fit else (1, SLACK[-1])

    def differences(self, size: int) -> int:
        """Most shingles that only one of two linked sets has, if the smaller has ``size``."""
        larger = size * 100 // self.percent
        return (size + larger) * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> int:
        while self.lower[-1] <= size:
            self.lower.append(max(self.lower[-1] + 1, self.lower[-1] * 3 // 2))
        return int(np.searchsorted(self.lower, size, side="right")) - 1

    def roles(self, size: int) -> list[int]:
        """Bands that a set of this size is sketched for: its own, and that of its smallest partner."""
        own, least = self.of(size), self.of(-(-size * self.percent // 100))
        return [band for band in range(least, own + 1) if band > 0]

    def blocks(self, band: int) -> int:
        self.of(self.lower[band])
        return int(np.ceil(self.slack * (self.differences(self.lower[band + 1] - 1) + 1)))

    def bits(self, size: int) -> int:
        """Length of a set's sketch, a power of two."""
        return max(64, 1 << (BITS * (self.differences(size) + 1) - 1).bit_length())

    def least(self, band: int) -> int:
        return min(self.fewest, LEAST_SMALL) if self.lower[band + 1] <= SMALL else self.fewest


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, hashes): the distinct shingles of each text, in order of their hashes.

    A text of fewer words than ``size`` has its whole word sequence as one shingle.
    """
    found = W.words(texts, lower=True)
    count = np.diff(found.first)
    starts = W.inside_runs(found.first, size)
    short = np.flatnonzero((count > 0) & (count < size))
    hashes = np.concatenate([W.run_hashes(found.hash, starts, size), W.run_hashes(found.hash, found.first[short], count[short])])
    doc = np.concatenate([np.searchsorted(found.first, starts, side="right") - 1, short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return np.searchsorted(doc, np.arange(len(texts) + 1)), hashes


def sketch(hashes: np.ndarray, band: int, turn: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity words and shingle counts of the blocks."""
    dealt = W.mix(hashes ^ W.U64((band * 1000 + turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    block = ((dealt >> W.U64(32)) * W.U64(blocks) >> W.U64(32)).astype(np.int64)
    words = np.zeros(blocks, W.U64)
    order = np.argsort(block, kind="stable")
    count = np.bincount(block, minlength=blocks)
    full = np.flatnonzero(count)
    words[full] = np.bitwise_xor.reduceat(W.mix(dealt[order]), np.concatenate([[0], np.cumsum(count[full])[:-1]]))
    return words, count


def roles_of(hashes: np.ndarray, bands: Bands) -> list[dict]:
    """For each band that a set is in: the join keys of the blocks that take part.

    ``need`` of them at least are those of any linked set that has the role too; 0 where
    too few blocks stay, so that only the partner's number tells.
    """
    out = []
    size = len(hashes)
    most = bands.differences(size)
    for band in bands.roles(size):
        blocks, least = bands.blocks(band), bands.least(band)
        for turn in range(TURNS):
            words, count = sketch(hashes, band, turn, blocks)
            stay = np.flatnonzero(count >= least)
            last = turn == TURNS - 1 and len(stay) <= most
            if last:
                stay = np.arange(blocks)
            where = W.U64(band << 40 | turn << 32) + stay.astype(W.U64)
            # an equal block of the last turn may be one that the partner leaves out
            need = 1 if last else max(0, len(stay) - most)
            out.append({"role": band * TURNS + turn, "need": need, "keys": W.mix(words[stay] ^ W.mix(where)).view(np.int64).tolist()})
            if last or len(stay) > most:
                break
    return out


def parity_bits(hashes: np.ndarray, bits: int) -> bytes:
    """The sketch: each shingle changes one bit; that of half the length is the XOR of its halves."""
    at = (W.mix(hashes ^ W.U64(W.BASE_WORDS)) & W.U64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, in the length of the shorter one."""
    x, y = (np.frombuffer(v, np.uint64) for v in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, row, n_shingles, x, y, roles, bits): x and y identify the shingle set, row the text."""
    kind = dict(docs.dtypes)["doc_id"]
    roles_type = pa.list_(pa.struct([("role", pa.int32()), ("need", pa.int32()), ("keys", pa.list_(pa.int64()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            texts = W.column(batch, "text")
            for lo, hi in W.slices(texts):
                first, hashes = shingle_sets(texts.slice(lo, hi - lo), size)
                spread = W.mix(hashes ^ W.U64(W.BASE_CHECK))
                sums = [np.concatenate([np.zeros(1, W.U64), np.cumsum(v)]) for v in (hashes, spread)]
                x, y = ((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
                sets = [hashes[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                roles = [roles_of(own, bands) for own in sets]
                bits = [parity_bits(own, bands.bits(len(own))) if role else None for own, role in zip(sets, roles, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in (0, 1)), pa.array(np.diff(first)), pa.array(x), pa.array(y), pa.array(roles, roles_type), pa.array(bits, pa.binary())],
                    ["doc_id", "row", "n_shingles", "x", "y", "roles", "bits"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(scan, f"doc_id {kind}, row bigint, n_shingles bigint, x bigint, y bigint, roles array<struct<role: int, need: int, keys: array<bigint>>>, bits binary")


def _paired(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with columns of both nodes."""
    first, second = (table.select(F.col("node").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in columns)) for k in "ab")
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", *(f"{c}_{k}" for c in columns for k in "ab"))


def close_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches differ in no more bits than linked sets may differ in shingles."""
    kind = dict(pairs.dtypes)["a"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, left, right = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))
            near = [(100 + percent) * hamming(x, y) <= (100 - percent) * (m + n) for m, n, x, y in zip(one, two, left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    sized = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return _paired(pairs, nodes, "n", "bits").where(sized).mapInArrow(check, f"a {kind}, b {kind}")


def _pair_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, int, int]]:
    left, right = W.column(batch, "text_a"), W.column(batch, "text_b")
    ends = np.concatenate([[0], np.cumsum(np.diff(W.offsets(left)) + np.diff(W.offsets(right)))])
    lo = 0
    while lo < len(left):
        hi = min(len(left), max(lo + 1, int(np.searchsorted(ends, ends[lo] + W.CHUNK_BYTES, side="right")) - 1))
        yield left.slice(lo, hi - lo), right.slice(lo, hi - lo), lo, hi
        lo = hi


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int, whole: bool = False) -> DataFrame:
    """Every pair (a, b) with b's differences from a.

    ``apart`` is the number of differing shingles.  b has to meet sets that differ from a
    in as many or more on the first ``small`` of them, by any common order, and sets that
    differ in fewer on the first ``large``: the overlap of a link between sets of x and y
    differences is (x + y - D) / 2 at least, with D as most differences of their own.  A set
    that is linked with a needs to meet only those that are not.  ``changes`` has ``large``
    of the differing shingles, or with ``whole`` all.
    """
    kind = dict(pairs.dtypes)["a"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for left, right, lo, hi in _pair_slices(batch):
                n = hi - lo
                (first_a, a), (first_b, b) = shingle_sets(left, size), shingle_sets(right, size)
                pair_a, pair_b = np.repeat(np.arange(n), np.diff(first_a)), np.repeat(np.arange(n), np.diff(first_b))
                key_a, key_b = (W.mix(h + W.mix(p.astype(W.U64) + W.U64(1))) for h, p in ((a, pair_a), (b, pair_b)))
                only_a, only_b = ~np.isin(key_a, key_b), ~np.isin(key_b, key_a)
                size_a, size_b = np.diff(first_a), np.diff(first_b)
                apart = np.bincount(pair_a[only_a], minlength=n) + np.bincount(pair_b[only_b], minlength=n)
                linked = (100 + percent) * apart <= (100 - percent) * (size_a + size_b)
                most = np.array([bands.differences(k) for k in size_b.tolist()], np.int64)
                overlap = np.maximum((apart * (100 + percent) + (100 - percent) * (size_a - size_b)) // (2 * (100 + percent)) + 1, apart - most)
                few = np.where(linked, np.clip(apart - overlap + 1, 0, apart), apart)
                small, large = np.minimum(few, most // 2 + 1), np.minimum(few, most + 1)
                # in one order for all: those that a lacks first, then by hash
                pair = np.concatenate([pair_b[only_b], pair_a[only_a]])
                shingle = np.concatenate([b[only_b], a[only_a]])
                order = np.lexsort((shingle, np.repeat([0, 1], [only_b.sum(), only_a.sum()]), pair))
                shingle, at = shingle[order].view(np.int64), np.concatenate([[0], np.cumsum(apart)])
                wanted = apart if whole else large
                taken = shingle[W.ranges(at[:-1], wanted)]
                changes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)), pa.array(taken))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(size_b), *(pa.array(v) for v in (apart, small, large)), changes],
                    ["a", "b", "n", "apart", "small", "large", "changes"],
                )

    return _paired(pairs, texts, "text").mapInArrow(check, f"a {kind}, b {kind}, n bigint, apart bigint, small bigint, large bigint, changes array<bigint>")


def linked_pairs(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity: near by their sketches, then verified on the texts."""
    kind = dict(pairs.dtypes)["a"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, lo, hi in _pair_slices(batch):
                n = hi - lo
                (first_a, a), (first_b, b) = shingle_sets(left, size), shingle_sets(right, size)
                key_a, key_b = (W.mix(h + W.mix(np.repeat(np.arange(1, n + 1).astype(W.U64), np.diff(first)))) for h, first in ((a, first_a), (b, first_b)))
                both = np.bincount(np.repeat(np.arange(n), np.diff(first_a))[np.isin(key_a, key_b)], minlength=n)
                linked = 100 * both >= percent * (np.diff(first_a) + np.diff(first_b) - both)
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(lo, n) for k in (0, 1)], ["a", "b"]).filter(pa.array(linked))

    return _paired(close_pairs(pairs, nodes, percent), texts, "text").mapInArrow(verify, f"a {kind}, b {kind}")


def _stars(groups: DataFrame) -> DataFrame:
    """(key, a, b): the pivot of each group of (key, node, sets), with every other set in it.

    The pivot is the set that meets the most others, so that a set's groups mostly agree on it.
    """
    weight = groups.groupBy("node").agg(F.sum("sets").alias("weight"))
    rows = keep(groups.join(weight, "node").select("key", "node", "weight"))
    # the greatest weight, then the least node
    heaviest = rows.groupBy("key").agg(F.max("weight").alias("weight"))
    pivots = rows.join(heaviest, ["key", "weight"]).groupBy("key").agg(F.min("node").alias("a"))
    return rows.join(pivots, "key").where("node <> a").select("key", "a", F.col("node").alias("b"))


def _grouped(members: DataFrame) -> DataFrame:
    """(key, node, n, role, need, sets) of the keys that several nodes have, of which one at least needs some."""
    return members.join(members.groupBy("key").agg(F.count("*").alias("sets"), F.max("need").alias("most")).where("sets > 1 and most > 0").drop("most"), "key")


def _rarest(members: DataFrame) -> DataFrame:
    """(key, node, n, sets): groups in which all sets that may link still meet.

    A set that shares ``need`` keys of a role with any linked one shares one that is not
    among its ``need - 1`` most frequent, in an order of keys that is the same for all.
    Sets that only have a phrase or two in common meet on fewer, and no longer at all.
    """
    shared = keep(_grouped(members))
    rank = F.row_number().over(Window.partitionBy("node", "role").orderBy(F.desc("sets"), "key"))
    rare = keep(shared.withColumn("rank", rank).where("rank >= need").drop("rank", "sets"))
    return _grouped(rare).select("key", "node", "n", "sets")


def by_shingles(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, node, n, role, need): every shingle of the texts (node, text), of which linked sets share ``need`` at least."""
    kind = dict(texts.dtypes)["node"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = W.column(batch, "text")
            for lo, hi in W.slices(whole):
                first, hashes = shingle_sets(whole.slice(lo, hi - lo), size)
                keys = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), keys], ["node", "n", "keys"])

    need = F.expr(f"(n * {percent} + 99) div 100").alias("need")
    sets = texts.select("node", "text").mapInArrow(scan, f"node {kind}, n bigint, keys array<bigint>")
    return sets.select("node", "n", F.lit(0).alias("role"), need, F.explode("keys").alias("key"))


def _in_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): the sets of each group that are near enough in size to link; for groups of few sets."""
    a, b = (groups.select("key", F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    return a.join(b, "key").where("a < b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).select("a", "b").distinct()


def _labelled(rows: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the component of each of the named nodes; one without a link is its own."""
    for c in columns:
        rows = rows.join(labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")), c, "left").withColumn(f"component_{c}", F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return rows


def _met(changes: DataFrame) -> DataFrame:
    """The rows of changes (a, shingle, b, component, k, ...) that sets of several components have.

    ``pairs`` tells whether the rows may be paired: one side, those that meet larger sets
    or those that meet smaller ones, has ``PAIRED`` rows at most.
    """
    shared = changes.groupBy("a", "shingle").agg(F.count("*").alias("sets"), F.count_if(F.col("k") < F.col("small")).alias("twos"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = shared.where((F.col("low") != F.col("high")) & (F.col("twos") > 0))
    return changes.join(shared.select("a", "shingle", "sets", (F.col("twos") <= PAIRED).alias("pairs")), ["a", "shingle"])


def _meeting(met: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of different components that a change in common allows to be linked."""
    sides = [met.where("pairs").select("a", "shingle", *(F.col(c).alias(f"{c}{i}") for c in ("b", "component", "n", "apart", "k", "small"))) for i in (1, 2)]
    near = "component1 <> component2 and apart1 >= apart2 and k2 < small2"
    near += f" and least(n1, n2) * 100 >= greatest(n1, n2) * {percent}"
    most = f"(n1 + n2) * {100 - percent} div {100 + percent}"
    near += f" and 2 * k1 <= apart1 - apart2 + {most} and 2 * k2 <= apart2 - apart1 + {most}"
    return sides[0].join(sides[1].where("k2 < small2"), ["a", "shingle"]).where(near).select(F.least("b1", "b2").alias("a"), F.greatest("b1", "b2").alias("b"))


def _refined(stars: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """What is left to compare in groups of several components: pairs (a, b), and groups (key, node, sets) of the next level."""
    at = keep(_labelled(stars, labels, "a", "b"))
    open_ = at.groupBy("key").agg(F.max((F.col("component_a") != F.col("component_b")).cast("int")).alias("open")).where("open = 1").select("key")
    sets = keep(at.join(open_, "key").select("a", "b", F.col("component_b").alias("component")).distinct())
    columns = ["a", "b", "component", "n", "apart", "small", "large"]
    changes = compared(sets, texts, size, percent).join(sets, ["a", "b"]).select(*columns, F.posexplode("changes").alias("k", "shingle"))
    met = keep(_met(keep(changes)))
    pairs = _meeting(met, percent)

    # the sets that meet on frequent changes, by their rarest ones
    again = keep(met.where("not pairs").select("a", "b", "component").distinct())
    whole = keep(compared(again, texts, size, percent, whole=True).join(again, ["a", "b"]).select(*columns, F.explode("changes").alias("shingle")))
    times = whole.groupBy("a", "shingle").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("times", "shingle")) - 1
    ranked = whole.join(times, ["a", "shingle"]).withColumn("k", rank).where(F.col("k") < F.col("large"))
    met = keep(_met(keep(ranked.drop("times"))))
    pairs = keep(pairs.unionAll(_meeting(met, percent)).distinct())
    return pairs, keep(met.where("not pairs").select(F.struct("a", "shingle").alias("key"), F.col("b").alias("node"), "sets"))


def linked_components(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, row, component_row) of every row of ``docs``.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of
    distinct ``size``-word shingles; a component's id is its least doc_id.  ``row`` tells
    the texts of one id apart, and ``component_row`` which text it is that the component
    is called by.
    """
    return settled(lambda: _linked(docs, size, percent))


def _linked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    with kept() as keyed:
        made = keep(sketches(docs, size, percent))
    # written, so that the joins below read plain shuffles, which are split where a class is large
    text = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))
    classes = keep(made.where("n_shingles > 0").groupBy("n_shingles", "x", "y").agg(F.min(text).alias("node")))
    blocks = made.select("x", "y", F.explode("roles").alias("r")).select("x", "y", "r.role", "r.need", F.explode("r.keys").alias("key"))
    # equal sets count as one from here on; a key that occurs once is not shared
    several = keep(blocks.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"))
    found = maybe_among(blocks, F.col("key"), several, F.col("key")).where("_maybe").drop("_maybe").join(several, "key").distinct()
    found = keep(found.join(classes.select("x", "y", "node", F.col("n_shingles").alias("n")), ["x", "y"]).where("node is not null").select("key", "node", "n", "role", "need"))
    # the keys, most of what was written, have served
    made = keep(made.drop("roles"))
    drop(docs.sparkSession, keyed)
    asked = keep(_rarest(found).select("node").distinct())
    nodes = keep(made.where("bits is not null").select(text.alias("node"), F.col("n_shingles").alias("n"), "bits").join(asked, "node").dropDuplicates(["node"]))
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("row")).alias("node"), "text")
    texts = keep(maybe_among(rows, F.col("node"), asked, F.col("node")).where("_maybe").drop("_maybe").join(asked, "node").dropDuplicates(["node"]))

    groups = keep(_rarest(keep(by_shingles(texts, size, percent))))
    few = _in_pairs(groups.where(F.col("sets") <= FEW), percent)
    stars = keep(_stars(groups.where(F.col("sets") > FEW)))
    links = keep(linked_pairs(keep(stars.select("a", "b").unionAll(few).distinct()), texts, nodes, size, percent))
    labels = components(links)
    for level in range(LEVELS):
        pairs, groups = _refined(stars, labels, texts, size, percent)
        if level < LEVELS - 1:
            stars = keep(_stars(groups))
            met = stars.select("a", "b")
        else:
            met = groups.select("key", F.col("node").alias("a")).join(groups.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b")
        apart = _labelled(met.distinct(), labels, "a", "b").where("component_a <> component_b").select("a", "b")
        more = keep(linked_pairs(pairs.unionAll(apart).distinct(), texts, nodes, size, percent))
        if not more.isEmpty():
            links = links.unionAll(more)
            labels = components(links)
        if stars.isEmpty():
            break

    out = made.where("n_shingles > 0").select("doc_id", "n_shingles", "row", "x", "y").join(classes, ["n_shingles", "x", "y"])
    out = out.join(labels, "node", "left").withColumn("_c", F.coalesce("component", "node")).select("doc_id", "n_shingles", F.col("_c.doc_id").alias("component_id"), "row", F.col("_c.row").alias("component_row"))
    return out.unionByName(made.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row", F.col("row").alias("component_row")))


def one_of_each(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that another text of their component stands for, with their columns.

    The text that stays is the one of the least doc_id, and of several texts of that id
    the one of the least hash; rows that repeat it with the id stay all.  Rows of a null
    id stay only if no row with an id is linked with them.
    """
    linked = linked_components(docs.select("doc_id", "text"), size=size, percent=percent)
    same = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("row").eqNullSafe(F.col("component_row"))
    going = linked.where(~same & F.col("component_id").isNotNull()).select("doc_id", "row").distinct()
    node = F.struct("doc_id", "row")
    # other columns may have any name
    packed = docs.select("doc_id", F.xxhash64("text").alias("row"), F.struct(*docs.columns).alias("_all"))
    marked = maybe_among(packed, node, going, node)
    asked = marked.where("_maybe").alias("d")
    gone = going.alias("g")
    left = asked.join(gone, F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.row") == F.col("g.row")), "left_anti")
    return marked.where("not _maybe").select("_all").unionAll(left.select("_all")).select(*(F.col("_all")[c].alias(c) for c in docs.columns))
