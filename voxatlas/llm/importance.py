"""Importance resampling towards a target's distribution of hashed n-grams (operator 12).

Every text becomes an array of buckets, made by higher-order functions from its words.
How often each bucket occurs in the raw table and in the target gives the bucket a gain,
the logarithm of the ratio of the two shares; the gains are one literal array, and a
document's weight is an aggregate over element_at of it.  Only the totals of each bucket
are shuffled.  Gumbel noise from the document's id, added to its weight, turns the highest
scores into a sample without replacement.

The highest scores are ranked without a task that sees them all: rows are dealt out by
ranges of (score, doc_id), numbered within their range, and the sizes of the ranges, one
number each, are added up.

Defined results: null and empty texts, and texts with fewer words than a feature has, have
no features and a weight of 0; a null doc_id counts as empty text in the noise and comes
first among equal scores; repeated rows are scored and drawn each; an empty raw table gives
no rows, an empty target has counts of 0; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxatlas.llm.common import keep, settled

#: Words of lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of the hash, longest feature in words, least words of a drawn document, share drawn (a percentage), and the noise's seed.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit(WORD), 0)


def features(ws: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` of the words ``ws``, each joined by one space."""
    if longest == 1:
        return ws

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(1)))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))
        return F.when(F.size(ws) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*(runs(n) for n in range(1, longest + 1))))


def bucketed(docs: DataFrame, others: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``others`` of each row, n_words and the array ``buckets`` of its features."""
    found = docs.select(*others, words(F.col("text")).alias("_words"))
    hashed = F.transform(features(F.col("_words"), longest), lambda f: (F.crc32(f.cast("binary")) % buckets).cast("int"))
    return found.select(*others, F.size("_words").cast("long").alias("n_words"), hashed.alias("buckets"))


def totals(made: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """How often each bucket occurs: as many numbers as there are buckets, whatever the data."""
    counts = made.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect()
    out = [0] * buckets
    for r in counts:
        out[r["bucket"]] = r["count"]
    return out


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of target share over raw share, each count being one more than it is."""
    n = len(raw)
    s_all, t_all = float(sum(raw)), float(sum(target))
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(raw, target, strict=True)]


def weighed(made: DataFrame, gain: list[int]) -> DataFrame:
    """``made`` with ``weight``, the sum of its buckets' gains, in place of the buckets."""
    literal = F.expr(f"cast(split('{','.join(map(str, gain))}', ',') as array<bigint>)")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda sum, b: sum + F.element_at(literal, b + 1))
    return made.select(*(c for c in made.columns if c != "buckets"), F.size("buckets").cast("long").alias("n_features"), total.alias("weight"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from 32 bits of a digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(uniform))).cast("long")


def ranked(scored: Callable[[], DataFrame], share: tuple[int, int], eligible: Column) -> DataFrame:
    """The rows of ``scored()`` with ``rank``: 1, 2, 3 ... by score and doc_id for floor(N * share) of the N eligible rows.

    Rows are dealt out by ranges of the order, so that no group of equal scores meets in
    one task, and written with their places, so that a task that runs again agrees.
    """
    order = [F.desc("_eligible"), F.desc("score"), F.asc_nulls_first("doc_id"), F.desc("n_features"), F.desc("weight")]
    part = F.shiftright("_place", 33).cast("int")
    laid = settled(lambda: scored().withColumn("_eligible", eligible).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    sizes = {r["part"]: r["n"] for r in laid.groupBy(part.alias("part")).agg(F.count_if("_eligible").alias("n")).collect()}
    before, most = [0], 0
    for k in range(max(sizes, default=-1)):
        before.append(before[-1] + sizes.get(k, 0))
    most = sum(sizes.values())
    first = F.expr(f"cast(split('{','.join(map(str, before))}', ',') as array<bigint>)")
    number = F.element_at(first, part + 1) + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return laid.withColumn("rank", F.when(F.col("_eligible") & (number <= share[0] * most // share[1]), number)).drop("_eligible", "_place")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``; rank is null where it is not drawn."""

    def scored() -> DataFrame:
        made = keep(bucketed(docs, ["doc_id"], longest, buckets))
        gain = gains(totals(made, buckets), totals(bucketed(target, [], longest, buckets), buckets))
        return weighed(made, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))

    return ranked(scored, (percent, 100), F.col("n_words") >= least_words)


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, with their columns."""
    ids = resample(docs.select("doc_id", "text"), target, **settings).where("rank is not null").select("doc_id").distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
