"""Connected components of an edge table, by alternating large and small stars.

Every round sends each node's neighbours to the least of them; trees flatten to
stars in a number of rounds that grows with the logarithm of the longest path.
Rounds are written to the shared folder, so nothing is computed twice and no
executor's loss matters.  Only a count of changes comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """Rows (node, root): each node of an edge with the least node of its component; null ends and loops are ignored."""
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = mark(now)
    for _ in range(most):
        if not seen[0]:
            break
        before, now = now, stored(_small_star(_large_star(now)), "edges")
        discard(before)
        again = mark(now)
        if again == seen:
            break
        seen = again
    else:
        raise RuntimeError("the components did not settle")
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.union(pairs.select(F.col("root").alias("node"), "root").distinct())
