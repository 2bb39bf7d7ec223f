"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly.

Rows with equal texts form a group and stay together. Large groups are placed one by one,
all small ones through a fixed number of hash cells, so that the driver packs a bounded number
of items whatever the corpus size. Items go, largest first, to the shard whose residual
capacity has the highest dot product with the item's vector, among the shards it still fits.
A group too large for one item is split by row into pieces, else one group with a
third of the rows would leave the shards uneven.

Defined results: a null text counts as no bytes and groups with empty texts. Rows with
the same id are placed by their text. An empty table gives an empty result. Extra columns of
the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import number_rows
from tidemark.session import materialise

# Bytes that a row takes besides its text.
ROW_BYTES = 8
# Items per shard: a larger group is split, smaller ones share the cells.
PIECES = 64
CELLS = 256

_PLACED = T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType())])


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each row of `vectors` (items x dimensions)."""
    total = vectors.sum(axis=0)
    share = vectors / np.where(total > 0, total, 1) * shards
    residual = np.ones((shards, vectors.shape[1]))
    placed = np.zeros(len(share), dtype=np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        fits = (residual >= share[i] - 1e-9).all(axis=1)
        score = residual @ share[i]
        # Where nothing fits, the shard that would be the least overfull takes the item.
        best = np.argmax(np.where(fits, score, -np.inf)) if fits.any() else np.argmax((residual - share[i]).min(axis=1))
        placed[i] = best
        residual[best] -= share[i]
    return placed


def assign_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """[id, size, text_crc32, tokens, shard, slot] of every row; slots are gapless in a shard.

    At most shards * (3 * PIECES + CELLS) group sizes reach the driver and as many placements
    are broadcast: more than 3 * PIECES * shards groups can't each hold a PIECES-th of a
    shard's bytes, tokens or rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
            F.sha2(text, 256).alias("group"),
        ),
        "shard-rows",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = rows.groupBy("group").agg(*sums)
    total = groups.agg(*[F.sum(c).alias(c) for c in ("size", "tokens", "rows")]).first()
    limits = {c: max((total[c] or 0) / (shards * PIECES), 1) for c in ("size", "tokens", "rows")}
    load = F.greatest(*[F.ceil(F.col(c) / limits[c]) for c in limits])
    large = groups.withColumn("pieces", load).where(" or ".join(f"{c} > {limits[c]}" for c in limits))
    large = spark.createDataFrame(
        [(r["group"], int(r["pieces"])) for r in large.select("group", "pieces").collect()],
        "group string, pieces long",
    )
    cell = F.concat(F.lit("cell-"), F.pmod(F.xxhash64("group"), F.lit(shards * CELLS)))
    piece = F.concat("group", F.lit("-"), F.pmod(F.xxhash64("id"), F.col("pieces")))
    items = rows.join(F.broadcast(large), "group", "left").withColumn(
        "item", F.when(F.col("pieces").isNull(), cell).otherwise(piece)
    )
    sizes = items.groupBy("item").agg(*sums).collect()
    sizes.sort(key=lambda r: r["item"])
    vectors = np.array([[r["size"], r["tokens"], r["rows"]] for r in sizes], dtype=float).reshape(-1, 3)
    places = [(r["item"], int(s)) for r, s in zip(sizes, pack(vectors, shards), strict=True)]
    placed = items.join(F.broadcast(spark.createDataFrame(places, _PLACED)), "item")
    kept = placed.select("id", "size", "text_crc32", "tokens", "shard")
    return number_rows(kept, "id", "text_crc32", name="slot", within=("shard",)).withColumn("slot", F.col("slot") - 1)
