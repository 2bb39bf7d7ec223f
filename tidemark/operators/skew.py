"""Helpers that keep a heavy key, or a total order, off a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

# A key below this many rows is an ordinary key.
HOT_ROWS = 1_000_000
# At most this many keys can each hold more than a hundredth of the rows.
HOT_KEYS = 100
SALTS = 64


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS, top: int = HOT_KEYS) -> list:
    """The heaviest keys, heaviest first: at most `top` values reach the driver."""
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    heavy = counts.where(F.col("_rows") >= min_rows).orderBy(F.desc("_rows"), key).limit(top)
    return [row[0] for row in heavy.select(key).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot: list | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join on `key` whose hot keys spread over `salts` tasks.

    `right` is meant to be unique on `key`: its hot rows, at most HOT_KEYS of them,
    are repeated once per salt. `how` is "inner" or "left". The salt comes from the other
    columns of a row, so copies equal in all columns should be collapsed or numbered first.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join takes inner or left")
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    others = [c for c in left.columns if c != key]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    lhs = left.withColumn("_salt", F.when(F.col(key).isin(hot), spread).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    rhs = right.withColumn(
        "_salt", F.explode(F.when(F.col(key).isin(hot), every).otherwise(F.array(F.lit(0))))
    )
    return lhs.join(rhs, [key, "_salt"], how).drop("_salt")


def number_rows(df: DataFrame, *order: str, name: str = "n", within: tuple[str, ...] = ()) -> DataFrame:
    """1, 2, 3, ... in the order of the given columns, without one task seeing all rows.

    Rows are range-partitioned and sorted; the position inside a partition is added to
    the number of rows in the partitions before it. The order columns should be unique
    together, so that ties don't gather in one partition.
    """
    keys = [*within, *order]
    ranged = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id()),
        "numbered",
    )
    ranged = ranged.withColumn("_part", F.shiftright("_id", 33))
    parts = ranged.groupBy(*within, "_part").agg(
        F.count("*").alias("_rows"), F.min("_id").alias("_first")
    )
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *within, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # One row per partition (and group), so the planner sees a small table.
    numbered = ranged.join(parts, [*within, "_part"])
    return numbered.select(
        *df.columns, (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias(name)
    )
