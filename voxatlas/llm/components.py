"""Connected components by joins: least label of the neighbours, then a jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.llm.common import keep

LINKS_PER_FILE = 1_000_000


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over ``links`` (a, b).

    Each turn takes the least label among a node and its neighbours and then the
    label of that label, so that long chains shrink by doubling.  It ends when no
    label changes.  Only nodes with a link appear.  Each turn's tables have files of
    ``LINKS_PER_FILE`` links, so that a small graph takes few tasks a turn.
    """
    both = keep(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    files = 4 + both.count() // LINKS_PER_FILE
    both = keep(both.coalesce(files))
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")).coalesce(files))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        least = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("component"))
        least = keep(least.coalesce(files))
        jump = least.select(F.col("node").alias("at"), F.col("component").alias("further"))
        labels = keep(least.join(jump, F.col("component") == F.col("at"), "left").select("node", "was", F.least("component", F.coalesce("further", "component")).alias("component")).coalesce(files))
        if labels.where("was <> component").isEmpty():
            return labels.drop("was")
        labels = labels.drop("was")
