"""Thin set and order helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def sort_user_item(df: DataFrame) -> DataFrame:
    return df.orderBy("user", "item")


def sort_itemsets(df: DataFrame) -> DataFrame:
    """Items sorted in each set, sets by size and then by items."""
    return df.withColumn("items", F.array_sort("items")).orderBy("size", "items")


def peek(df: DataFrame, n: int = 1) -> DataFrame:
    return df.limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def anti_by_key(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `left` whose key is absent from `right`."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def candidate_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def candidate_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def min_support(counts: DataFrame, support: int, column: str = "support") -> DataFrame:
    return counts.where(F.col(column) >= support)


def local_threshold(support: int, chunks: int) -> int:
    """Support a set must reach in some chunk to be able to reach `support` overall."""
    return max(1, support // chunks)
