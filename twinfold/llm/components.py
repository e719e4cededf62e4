"""Connected components of a table of links, as rounds of joins.

Every round makes each vertex point at the smallest vertex it knows of
(large-star, then small-star).  Links stay in written tables; nothing but a
row of counts per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.skew import hot_keys, spread_join
from twinfold.session import stage

LEAST_SHARE = 100  # links of a vertex that are always left together


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links`` with ``m`` of their ``a``.

    A vertex with many links, as the centre of a star is, would hold up one task: links of such are dealt
    over several.  A vertex has many if it has more than a task's share of all.
    """
    tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(links.count() // tasks, LEAST_SHARE)
    return spread_join(links, least, ["a"], hot_keys(links, ["a"], share), left_id="b")


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = _with_least(near.where("b > a"), least)
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` has a > b."""
    least = stage(links.groupBy("a").agg(F.min("b").alias("m")))
    moved = _with_least(links, least).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``links`` (``a, b`` of one type) but the roots.

    The root is the smallest vertex of the component.  Loops and repeated links count
    once; an empty table gives an empty one.
    """
    links = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while True:
        parents = links.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        roots_moved = links.select(F.col("b").alias("a")).distinct().join(parents, "a", "left_semi")
        more = parents.where("n > 1").select("a").unionByName(roots_moved)
        if more.isEmpty():
            return links.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        links = stage(_small_star(stage(_large_star(links))))
