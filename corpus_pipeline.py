"""A corpus, step by step: quality, lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``, with n_chars following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.llm import decontamination, jaccard, lines, packing, quality
from voxatlas.llm.common import drop, keep, kept, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Rows are judged each by its text, a null one as an empty one; repeated rows stay or go
    together; an empty table stays empty.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has; those that keep no line go.

    Null texts and texts without words stay, as do rows of a null doc_id; equal rows lose
    the same lines; an empty table stays empty.  n_chars follows the text; other columns,
    of whatever name, are as they were.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(F.col(c).alias(f"_{k}") for k, c in enumerate(others)) if others else [F.lit(None).alias("_")])
    out = lines.dedup_lines(docs.select("doc_id", "text", rest.alias("rest"))).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    given = {c: F.col(f"rest._{k}") for k, c in enumerate(others)} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in given:
        given["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(given["n_chars"])
    return out.select(*(given[c].cast(dict(docs.dtypes)[c]).alias(c) for c in docs.columns))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies.

    Texts without words are near to none and stay.  Texts of one id are judged each: what
    no other row has is never lost.  Rows that repeat the id and the text that stays, stay all;
    rows of a null id go where a row with an id is near; an empty table stays empty.
    """
    return jaccard.one_of_each(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages.

    Null texts have no words and stay, as all rows do with an empty benchmark; repeated
    rows stay or go together; an empty table stays empty.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the packed sequences.

    A null text counts as empty and has one piece, of the end's id; each of several equal
    rows has its own pieces; an empty table gives none.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: SQL can neither fit the classifier nor tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote goes once the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES:
        with kept() as made:
            docs = keep(stage(spark, docs, sf_dir))
        drop(spark, before)
        before = made
    return docs
