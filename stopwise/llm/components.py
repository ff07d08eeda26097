"""Connected components of a link table, by alternating large-star and small-star rounds.

Links stay in Spark: each round is two aggregations and joins over the links, written to the
shared scratch folder. Every round replaces links by links to smaller ids, and the number of
rounds grows with the logarithm of the number of nodes, long chains included. Stars of
any size are aggregated before the shuffle; no node's links are gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.text import written


def _least(links: DataFrame) -> DataFrame:
    """Per node ``u`` the least of itself and its neighbours ``v``."""
    return links.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("least")).select(
        "of", F.least("of", "least").alias("least")
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_least(both), F.col("u") == F.col("of")).select(
        F.col("v").alias("u"), F.col("least").alias("v")
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = _least(down)
    return (
        down.join(least, F.col("u") == F.col("of"))
        .select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
        .where("u <> v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``u, v`` -> ``node, component``: the least node reachable, for every node with a link to
    another. Links of a node to itself count for nothing; an empty table gives an empty one."""
    spark = links.sparkSession
    now = written(
        spark,
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    while not _stars_only(now):
        now = written(spark, _small_star(_large_star(now)), "links")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _stars_only(links: DataFrame) -> bool:
    """Whether every node has one link down, to a node that has none: the least of its star."""
    centres = links.select(F.col("v").alias("centre")).distinct()
    chained = links.join(centres, F.col("u") == F.col("centre"), "left_semi")
    several = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    return several.select("u").unionByName(chained.select("u")).isEmpty()
