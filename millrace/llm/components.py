"""Connected components of a link table: distributed union-find by alternating star steps.

Every round hangs each node on the smallest node in reach and halves long chains, so paths of any
length end after about their logarithm in rounds. A round is joins and grouped minima; a node with
very many links is a skewed join key, which Spark splits, and is pre-aggregated in grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, stored


def _hung(links: DataFrame, on: str, other: str) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    nearest = links.groupBy(on).agg(F.min(other).alias("root"))
    return nearest.withColumn("root", F.least("root", on))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.filter("b > a").join(_hung(both, "a", "b"), "a")
    return joined.select(F.col("b").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    roots = _hung(down, "a", "b")
    moved = down.join(roots, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.union(roots.select("a", F.col("root").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has a link.

    NULL ends, self links and repeated links change nothing; an empty table gives an empty one.
    Every round is stored in the shared folder, which cuts the lineage.
    """
    stars = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    stars = stored(stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before, last = seen, stars
        stars = stored(_small_star(_large_star(last)))
        discard(last)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
