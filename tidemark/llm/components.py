"""Connected components of a link table, by alternating stars.

Each round links every vertex to the smallest vertex it is linked to, first among its larger
neighbours, then among its smaller ones, until nothing changes. No task holds the
neighbours of a vertex: the minimum is a pre-aggregated sum, and it goes back to the links by a
join between two tables, which adaptive execution splits where one vertex is heavy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One half of a round on links [a, b]."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "star")
    met = both.join(least, "a")
    if larger:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """[id, component] of the vertices of links [a, b] that aren't the smallest of their component.

    Both columns are of one orderable type; links may repeat, point either way or to themselves.
    """
    held = materialise(links.select("a", "b").where("a != b").distinct(), "links")
    before = _state(held)
    while before[0]:
        held = materialise(_star(_star(held, larger=True), larger=False), "links")
        now = _state(held)
        if now == before:
            break
        before = now
    return held.select(F.col("a").alias("id"), F.col("b").alias("component"))
