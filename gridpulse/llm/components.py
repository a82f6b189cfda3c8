"""Connected components of a link table, by alternating large and small stars.

Every node ends with the smallest node of its component.  A round is two
grouped minima (combined before their shuffle) and two equi-joins whose big
side may be skewed to a hub; the minima are written out before they are
joined, so that adaptive execution can split the hub's partition.  Each round
is cut off by files in the shared folder.  The number of rounds grows with
the logarithm of the component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import spool_narrow


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0))).first()
    return row[0], row[1]


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long, not null)."""
    down = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    down = spool_narrow(down, "cc-links")
    before = _state(down)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = down.union(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = spool_narrow(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), "cc-large")
        # Large star: a node's larger neighbours move to its smallest.
        large = down.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = spool_narrow(large.distinct(), "cc-star")
        least = spool_narrow(large.groupBy("a").agg(F.min("b").alias("m")), "cc-small")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = spool_narrow(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "cc-links")
        now = _state(down)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = down.select(F.col("b").alias("node")).distinct()
    return down.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
