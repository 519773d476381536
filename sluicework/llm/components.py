"""Connected components of links, by alternating large and small stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.sources.storage import Staging

def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or not larger) neighbours to the least of its neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.filter(F.col("b") < F.col("a"))
    least = side.groupBy("a").agg(F.min("b").alias("least"))
    joined = side.join(least, "a").withColumn("least", F.least("a", "least"))
    if large:
        joined = joined.filter(F.col("b") > F.col("a"))
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            joined.select("a", F.col("least").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(
    links: DataFrame, staging: Staging, most_rounds: int | None = None
) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``): the least node it reaches.

    Fewer ``most_rounds`` stop early; a label is then some node reached, not always the least.
    Each round is a written table; rounds end when a large star changes nothing, after about the
    logarithm of the largest component.  Nothing but the sums that tell so reaches the driver.
    """
    now = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    sums = {"n": "count(*)", "total": "sum(cast(xxhash64(a, b) as decimal(38,0)))"}
    table, before = staging.measured_table(now.distinct(), **sums)
    rounds = 0
    while before["n"] and rounds != most_rounds:
        rounds += 1
        table, after = staging.measured_table(_star(_star(table, True), False), **sums)
        if after == before:
            break
        before = after
    labels = table.select(F.col("a").alias("node"), F.col("b").alias("label"))
    own = table.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return labels.union(own).groupBy("node").agg(F.min("label").alias("label"))
