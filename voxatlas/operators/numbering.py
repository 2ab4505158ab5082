"""Row numbers over a whole table without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxatlas.operators.kept import kept


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with the rows' numbers from 1 in an order.

    Rows are dealt out by ranges of the order, sorted and written with their places; only
    the size of each range, one number a task, comes to the driver.  Equal rows are
    numbered in any order.
    """
    laid = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before = [0]
    for k in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(k, 0))
    first = F.expr(f"cast(split('{','.join(map(str, before))}', ',') as array<bigint>)")
    number = F.element_at(first, part + 1) + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return laid.withColumn(name, number).drop("_place")
