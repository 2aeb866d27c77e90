"""Connected components of a table of links, by alternating star contraction.

A large star hangs every larger neighbour of a node on the smallest node of its
neighbourhood; a small star does so for the smaller ones. Rounds of the two end
in stars around each component's smallest node, after about log(n) rounds. Each
round is two aggregations and joins; its result is a written table, so that no
round depends on the executors of an earlier one.

Defined cases: links of a node with itself and repeated links count for nothing; links
with a null end must not be given; no links give no rows; a node with very many neighbours (a hub) is
met by a join that Spark can split, its aggregation is summed before the shuffle; columns besides a and b are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node hangs on the least of the node's neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the least of them (a > b in every link)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a")
    return hung.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b) but the roots themselves."""
    stars = scratch.write(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        new = _state(stars)
        if new[0] == 0 or new == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
        old, stars = stars, scratch.write(_small_star(_large_star(stars).distinct()).distinct())
        scratch.drop(old)


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first())
