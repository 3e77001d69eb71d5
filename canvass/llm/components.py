"""Connected components of a link table by alternating large-star and small-star
rounds: a union-find without any driver-side state. Each round is two shuffles
of the links; a node with very many links is only ever pre-aggregated to its
smallest neighbour and joined, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def _signature(links: DataFrame) -> tuple:
    # exact sums: equal signatures in two rounds mean that no link moved
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    # u > v in every link
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` of any ordered type -> ``(node, root)`` for every node that
    has a link to another one; ``root`` is the smallest node of its component.
    Links that are null or from a node to itself say nothing. No links: empty."""
    cur = shared_table(links.where("a is not null and b is not null and a != b")
                       .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _signature(cur)
    if before[0]:
        for _ in range(max_rounds):
            cur = shared_table(_small_star(_large_star(cur)))
            now = _signature(cur)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
