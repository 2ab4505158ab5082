"""What each of five filters removes, alone and in every order (operator 13).

A relational pipeline: the words of each text become rows, which are counted by
(document, word) and then by document, for totals and distinct words.  The other flags are
joined to that, and every part of the table has 32 conditional counts, one for each
combination of failed filters.  All orders of the filters follow from these counts, so
that 120 runs of the filters cost as much as one.

Texts are dealt out once, row by row, so that all counting of a document's words stays
where its text is; neither a hot source nor a group of copies meets in one task.  Copies
are told by 128 bits of hashes of their texts.

Defined results: null texts count as empty, and null sources as empty strings; empty texts
are copies of one another; rows that repeat an id are judged each by its own text, and of
equal texts under one id none is the other's copy, as neither id is smaller; a null doc_id
is greater than none and has no label; an id with several labels has quality or is toxic if
one of them says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxatlas.llm.common import keep, settled

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
#: Least words; least distinct words and most capitals, as percentages; characters that no text may hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"


def _plain(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part and text without nulls, and two hashes of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def word_totals(plain: DataFrame) -> DataFrame:
    """(h1, h2, first_id, n_words, n_distinct) of each different text."""
    row = ["row", "doc_id", "h1", "h2"]
    dealt = plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h1", "h2", "text").repartition("row")
    words = dealt.select(*row, F.explode_outer(F.regexp_extract_all("text", F.lit(WORD), 0)).alias("word"))
    each = words.groupBy(*row, "word").agg(F.count("word").alias("n"))
    of_row = each.groupBy(*row).agg(F.sum("n").alias("n_words"), F.count("word").alias("n_distinct"))
    return of_row.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.max("n_words").alias("n_words"), F.max("n_distinct").alias("n_distinct"))


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, fails) of every row; bit k of ``fails`` is set if filter k fails it."""
    plain = _plain(docs, part)
    capitals = F.regexp_count("text", F.lit("[A-Z]"))
    flags = plain.select("doc_id", "part", "h1", "h2", (100 * capitals.cast("long") > MOST_CAPITALS * F.length("text").cast("long")).alias("c"), F.col("text").rlike(SIGNS).alias("d"))
    # kept, so that the join reads both sides as they are dealt out and can split a large group of copies
    joined = flags.join(keep(word_totals(plain)), ["h1", "h2"], "left")
    tests = [F.col("n_words") < LEAST_WORDS, 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), F.col("c"), F.col("d"), F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))]
    return joined.select("doc_id", "part", sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0)).alias("fails"))


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, n, good, toxic): arrays of 32 counts, by the combination of failed filters."""
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failed.join(known, "doc_id", "left")
    kinds = {"n": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    counts = [F.count_if((F.col("fails") == m) & (v == 1)).alias(f"{kind}{m}") for kind, v in kinds.items() for m in range(MASKS)]
    return rows.groupBy("part").agg(*counts).select("part", *(F.array(*(f"{kind}{m}" for m in range(MASKS))).alias(kind) for kind in kinds))


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, the filter's bit, the bits before it) of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        for step, k in enumerate(order):
            out.append(("".join(FILTERS[i] for i in order), step + 1, 1 << k, sum(1 << i for i in order[:step])))
    return out


def _sum(counts: str, condition: str) -> Column:
    """The sum of those counts whose combination ``m`` meets the condition."""
    return F.expr(f"aggregate(filter({counts}, (x, m) -> {condition}), 0L, (a, x) -> a + x)")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step: counts of documents.

    kept: left after the step; removed: here; redundant: failing here, removed before;
    unique_fails: failing this filter only; good_lost, toxic_lost: removed here, by label;
    shapley: removed by this filter, added up over all orders.
    """
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("b"), F.lit(p).alias("p")) for o, s, b, p in _steps()))
    counted = settled(lambda: combinations(failures(docs, part), labels)).select("part", "n", "good", "toxic", F.explode(steps).alias("at")).select("part", "n", "good", "toxic", "at.*")
    here = "(m & p) = 0 and (m & b) <> 0"
    # of the orders, those in which the filter stands before the others that fail a document
    share = F.expr("cast(aggregate(zip_with(n, sequence(0, 31), (x, m) -> if((m & b) <> 0, x * (120 div bit_count(m)), 0L)), 0L, (a, x) -> a + x) as bigint)")
    return counted.select(
        "part",
        "filter_order",
        "step",
        _sum("n", "(m & (p | b)) = 0").alias("kept"),
        _sum("n", here).alias("removed"),
        _sum("n", "(m & p) <> 0 and (m & b) <> 0").alias("redundant"),
        _sum("n", "m = b").alias("unique_fails"),
        _sum("good", here).alias("good_lost"),
        _sum("toxic", here).alias("toxic_lost"),
        share.alias("shapley"),
    )
