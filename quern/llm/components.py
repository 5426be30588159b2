"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; both sides of the join come straight from written tables, so that Spark
can split a vertex with very many links. Links never leave the cluster's storage; the driver only asks whether
vertices are left that do not point at the smallest of their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step on links (u, v) with u > v: every vertex hands its neighbours (large: those above it) to the smallest."""
    both = links.select("u", "v")
    if large:
        both = both.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = written(both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("low")), "links-lowest")
    low = F.least("low", "of")
    joined = both.join(lowest, F.col("u") == F.col("of"))
    handed = joined.where("v > u" if large else "true").select(F.col("v").alias("u"), low.alias("v"))
    if not large:
        handed = handed.union(lowest.select(F.col("of").alias("u"), F.col("low").alias("v")))
    return written(handed.where("u > v").distinct(), "links")


def _stars(links: DataFrame) -> bool:
    """Whether every vertex points at one other, which points at none."""
    lower = links.groupBy("u").agg(F.count("*").alias("n"))
    if not lower.where("n > 1").isEmpty():
        return False
    return links.join(lower.select(F.col("u").alias("middle")), F.col("v") == F.col("middle"), "left_semi").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """member, component: the smallest vertex reachable from every vertex that has a link to another one.

    Null ends and links of a vertex to itself are ignored; links may repeat and have either direction.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
        .where("_a is not null and _b is not null and u > v")
        .select("u", "v")
        .distinct(),
        "links",
    )
    while not _stars(edges):
        edges = _star(_star(edges, large=True), large=False)
    # Every vertex that is not the smallest of its component now points at that one.
    return edges.select(F.col("u").alias("member"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("member"), F.col("v").alias("component")).distinct()
    )
