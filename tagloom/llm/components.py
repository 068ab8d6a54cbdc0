"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored


def _rewired(links: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones, are linked to the least node around it.

    The least neighbour comes from an aggregation that combines before it shuffles; a hub's links meet that one row in a join
    that adaptive execution can split.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``a`` and ``root`` for every linked node other than the least of its component.

    ``links`` has two long columns ``a`` and ``b``, in any order and with repeats. Rounds of large and small stars, each
    written to the shared folder, until nothing changes; then every link points to a root.
    """
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark or not seen[0]:
            return now.withColumnRenamed("b", "root")
        mark = seen
        now = stored(_rewired(now), "links")
