"""k-means on points, cluster errors, frequent terms and reports.

Points are [id, vec] with an array<double> or an ML vector. Centres are a model of k
rows: they travel to the tasks with the function, and `MAX_MODEL_VALUES` bounds them.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import sparse_kmeans
from tidemark.session import materialise, spread

# The functions that run in Python workers travel whole: these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Centres times dimensions: 512 MB of doubles.
MAX_MODEL_VALUES = 1 << 26
# Positions of a centre that travel together while sums are merged.
BLOCK = 1024
# Fixed value: terms listed for each cluster.
TOP_TERMS = 10


# --- points and centres --------------------------------------------------------------


def _coordinates(points: DataFrame, vec: str) -> tuple[Column, Column]:
    """(positions, values) of the points; positions are null for a dense array."""
    if isinstance(points.schema[vec].dataType, VectorUDT):
        raw = F.unwrap_udt(vec)
        dense = F.sequence(F.lit(0), F.size(raw["values"]) - 1)
        return F.when(raw["type"] == 1, dense).otherwise(raw["indices"]), raw["values"]
    return F.lit(None).cast("array<int>"), F.col(vec).cast("array<double>")


def _matrix(centres: DataFrame) -> np.ndarray:
    """The centres in cluster order; their number and size are checked before they are read."""
    dense = F.col("vec")
    if isinstance(centres.schema["vec"].dataType, VectorUDT):
        dense = vector_to_array("vec")
    rows = centres.select("cluster", dense.alias("vec"))
    values = rows.agg(F.sum(F.size("vec"))).first()[0] or 0
    if values > MAX_MODEL_VALUES:
        raise ValueError(f"{values} centre values exceed the model limit of {MAX_MODEL_VALUES}")
    collected = rows.orderBy("cluster").collect()
    if [r.cluster for r in collected] != list(range(len(collected))):
        raise ValueError("clusters must be numbered 0, 1, 2, ...")
    return np.array([r.vec for r in collected], dtype=float)


def centres_frame(spark: SparkSession, matrix: np.ndarray) -> DataFrame:
    """[cluster, vec]"""
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "cluster int, vec array<double>")


def smallest_id_centres(points: DataFrame, k: int) -> DataFrame:
    """[cluster, vec]: the k points with the smallest ids."""
    first = points.orderBy("id").limit(k)
    return first.select((F.row_number().over(Window.orderBy("id")) - 1).alias("cluster"), "vec")


def sampled_centres(points: DataFrame, k: int, seed: int, vec: str = "vec") -> DataFrame:
    """[cluster, vec]: k points drawn by a seeded hash of their ids."""
    draw = F.xxhash64(F.lit(seed), F.col("id"))
    first = points.withColumn("_draw", draw).orderBy("_draw", "id").limit(k)
    order = F.row_number().over(Window.orderBy("_draw", "id"))
    return first.select((order - 1).alias("cluster"), F.col(vec).alias("vec"))


def _distances(positions: pa.Array, values: pa.Array, matrix: np.ndarray) -> np.ndarray:
    """Squared distance of each point of a batch to each centre."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if positions.null_count == len(positions):
        x = flat.reshape(-1, matrix.shape[1])
        return np.stack([((x - c) ** 2).sum(axis=1) for c in matrix], axis=1)
    at = positions.flatten().to_numpy(zero_copy_only=False)
    counts = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(values)), counts)
    sums = []
    for c in matrix:
        here = c[at]
        change = np.bincount(row, (flat - here) ** 2 - here**2, minlength=len(values))
        sums.append(np.maximum(change + (c**2).sum(), 0.0))
    return np.stack(sums, axis=1)


def assign_nearest(points: DataFrame, centres: DataFrame | np.ndarray, vec: str = "vec") -> DataFrame:
    """The points with `cluster` and `d2`: the nearest centre, the lowest cluster on ties."""
    matrix = _matrix(centres) if isinstance(centres, DataFrame) else centres

    @F.arrow_udf("cluster int, d2 double")
    def nearest(positions: pa.Array, values: pa.Array) -> pa.Array:
        d2 = _distances(positions, values, matrix)
        best = d2.argmin(axis=1)
        own = d2[np.arange(len(best)), best]
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(own)], ["cluster", "d2"])

    found = points.withColumn("_nearest", nearest(*_coordinates(points, vec)))
    return found.select(*points.columns, "_nearest.cluster", "_nearest.d2")


# --- own k-means ---------------------------------------------------------------------


def _partial_sums(matrix: np.ndarray):
    """Per task and cluster: the member count and the coordinate sums, in blocks of positions."""
    k, width = matrix.shape
    blocks = -(-width // BLOCK)

    def sums(batches):
        total, members = np.zeros(k * width), np.zeros(k, dtype=np.int64)
        for batch in batches:
            positions, values = batch.column(0), batch.column(1)
            best = _distances(positions, values, matrix).argmin(axis=1)
            members += np.bincount(best, minlength=k)
            flat = values.flatten().to_numpy(zero_copy_only=False)
            counts = np.diff(values.offsets.to_numpy())
            if positions.null_count == len(positions):
                at = np.tile(np.arange(width), len(values))
            else:
                at = positions.flatten().to_numpy(zero_copy_only=False)
            # One slot per cluster and position; untouched slots cost nothing to send.
            slot, inverse = np.unique(np.repeat(best, counts) * width + at, return_inverse=True)
            total[slot] += np.bincount(inverse, flat, minlength=len(slot))
        padded = np.zeros((k, blocks * BLOCK))
        padded[:, :width] = total.reshape(k, width)
        padded = padded.reshape(k, blocks, BLOCK)
        used = padded.any(axis=2)
        used[:, 0] |= members > 0
        cluster, block = np.nonzero(used)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cluster, pa.int32()),
                pa.array(block, pa.int32()),
                pa.array(np.where(block == 0, members[cluster], 0), pa.int64()),
                pa.array(list(padded[cluster, block]), pa.list_(pa.float64())),
            ],
            ["cluster", "block", "members", "sums"],
        )

    return sums


def lloyd_kmeans(
    points: DataFrame, init: DataFrame, iters: int = 20, vec: str = "vec"
) -> tuple[DataFrame, DataFrame]:
    """(points with cluster and d2, centres [cluster, vec]) after `iters` rounds.

    Each round is one pass: every task sums its points by nearest centre, Spark adds up
    these sums, and only the k new centres come back. An empty cluster keeps its centre.
    """
    spark = points.sparkSession
    matrix = _matrix(init)
    k, width = matrix.shape
    positions, values = _coordinates(points, vec)
    coordinates = spread(points.select(positions.alias("positions"), values.alias("vals")))
    partial_schema = "cluster int, block int, members bigint, sums array<double>"
    try:
        for _ in range(iters):
            partial = coordinates.mapInArrow(_partial_sums(matrix), partial_schema)
            merged = partial.groupBy("cluster", "block").agg(
                F.sum("members").alias("members"), Summarizer.sum(array_to_vector("sums")).alias("sums")
            )
            # At most k rows per block: the next model.
            model = merged.select("cluster", "block", "members", vector_to_array("sums").alias("sums")).toArrow()
            cluster, block, members = (model.column(i).to_numpy() for i in range(3))
            counts, totals = np.zeros(k), np.zeros((k, -(-width // BLOCK), BLOCK))
            np.add.at(counts, cluster, members)
            if len(cluster):
                totals[cluster, block] = np.stack(model.column(3).to_numpy())
            means = totals.reshape(k, -1)[:, :width] / np.maximum(counts, 1)[:, None]
            fresh = np.where(counts[:, None] > 0, means, matrix)
            if np.array_equal(fresh, matrix):
                break
            matrix = fresh
    finally:
        coordinates.unpersist()
    return assign_nearest(points, matrix, vec), centres_frame(spark, matrix)


# --- clusters of documents ------------------------------------------------------------


def sparse_features(features: DataFrame, vec: str = "features") -> DataFrame:
    """[doc_id, grp, ids, xs] of `sparse_kmeans` from sparse ML vectors, written once."""
    raw = F.unwrap_udt(vec)
    ids = raw["indices"].cast("array<bigint>")
    return sparse_kmeans.written(features.select("doc_id", F.lit(0).alias("grp"), ids.alias("ids"), raw["values"].alias("xs")))


def drawn_start(docs: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """[doc_id, cluster]: k documents drawn by a seeded hash of their ids."""
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"))
    first = docs.select("doc_id", draw.alias("_draw")).orderBy("_draw", "doc_id").limit(k)
    order = F.row_number().over(Window.orderBy("_draw", "doc_id"))
    return first.select("doc_id", (order - 1).cast("int").alias("cluster"))


def kmeans(docs: DataFrame, k: int, iters: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """([doc_id, cluster, d2], centres [cluster, id, x]) of sparse documents, from random centres."""
    return sparse_kmeans.kmeans(docs, k, iters, drawn_start(docs, k, seed))


def bisecting_kmeans(docs: DataFrame, k: int, iters: int = 20) -> tuple[DataFrame, DataFrame]:
    """([doc_id, cluster, d2], centres [cluster, id, x]) of sparse documents, by repeated two-way splits."""
    return sparse_kmeans.bisecting(docs, k, iters)


def recomputed(docs: DataFrame, assigned: DataFrame, centres: DataFrame) -> DataFrame:
    """[doc_id, cluster, d2, own, least]: the recorded distance, that to the recorded centre and to the nearest one,
    both worked out again from the documents and the table of centres by joins."""
    terms = sparse_kmeans.long_form(docs)
    dots = terms.join(centres.select("cluster", "id", F.col("x").alias("c")), "id").groupBy("doc_id", "cluster")
    dots = dots.agg(F.sum(F.col("x") * F.col("c")).alias("dot"))
    norms = terms.groupBy("doc_id").agg(F.sum(F.col("x") * F.col("x")).alias("p2"))
    squares = centres.groupBy("cluster").agg(F.sum(F.col("x") * F.col("x")).alias("c2"))
    every = assigned.select(F.col("cluster").alias("c")).distinct().join(squares.withColumnRenamed("cluster", "c"), "c", "left")
    # One entry per cluster that has documents.
    listed = every.agg(F.collect_list(F.struct(F.col("c").alias("cluster"), F.coalesce("c2", F.lit(0.0)).alias("c2")))).scalar()
    pairs = assigned.select("doc_id", F.col("cluster").alias("at"), "d2", F.inline(listed))
    pairs = pairs.join(norms, "doc_id", "left").join(dots, ["doc_id", "cluster"], "left")
    gap = F.coalesce("p2", F.lit(0.0)) + F.col("c2") - 2 * F.coalesce("dot", F.lit(0.0))
    return pairs.groupBy("doc_id", F.col("at").alias("cluster"), "d2").agg(
        F.max(F.when(F.col("cluster") == F.col("at"), gap)).alias("own"), F.min(gap).alias("least")
    )


# --- reports -------------------------------------------------------------------------


def cluster_sse(assigned: DataFrame) -> DataFrame:
    """[cluster, size, sse] and, with cluster -1, the totals (the WSSE)."""
    by = assigned.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("d2").alias("sse"))
    total = by.rollup("cluster").agg(
        F.sum("size").alias("size"), F.sum("sse").alias("sse"), F.grouping("cluster").alias("_total")
    )
    label = F.when(F.col("_total") == 1, F.lit(-1)).otherwise(F.col("cluster"))
    return total.select(label.cast("int").alias("cluster"), "size", "sse")


def named_terms(top: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The top terms of `top_terms` by number, with their words from [term_id, term]; at most k rows a cluster."""
    words = vocabulary.select(F.col("term_id").alias("term"), F.col("term").alias("_word"))
    return words.join(F.broadcast(top), "term").drop("term").withColumnRenamed("_word", "term").select("cluster", "rank", "term", "n")


def cluster_terms(assigned: DataFrame, terms: DataFrame) -> DataFrame:
    """[cluster, doc_id, term, tf]: the term counts of each cluster's documents."""
    return terms.join(assigned.select("doc_id", "cluster"), "doc_id").select("cluster", "doc_id", "term", "tf")


def top_terms(terms: DataFrame, k: int = TOP_TERMS, mode: str = "summed") -> DataFrame:
    """[cluster, rank, term, n]: the k most frequent terms of each cluster.

    "summed" adds a term up over the documents. "literal" ranks the single
    document counts, so a term can come up more than once.
    """
    if mode == "summed":
        counts = terms.groupBy("cluster", "term").agg(F.sum("tf").alias("n"))
        order = [F.desc("n"), F.asc("term")]
    else:
        counts = terms.select("cluster", "term", F.col("tf").alias("n"), "doc_id")
        order = [F.desc("n"), F.asc("term"), F.asc("doc_id")]
    # The limit reaches the tasks before the shuffle: each sends k rows per cluster.
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(*order))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k).select("cluster", "rank", "term", "n")


def cluster_report(
    assigned: DataFrame,
    terms: DataFrame,
    algorithm: str,
    k: int = TOP_TERMS,
    mode: str = "summed",
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """[algorithm, wsse, clusters]: id, size, error and top terms of every cluster.

    `terms` is [cluster, doc_id, term, tf], or [cluster, term, tf] for summed counts; terms that are numbers
    in the order of their words get these from `vocabulary`.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    best = top_terms(terms, k, mode)
    best = best if vocabulary is None else named_terms(best, vocabulary)
    best = best.groupBy("cluster").agg(listed["term"].alias("terms"))
    by = assigned.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("d2").alias("error"))
    entry = F.struct(
        (F.col("cluster") + 1).alias("id"),
        "size",
        "error",
        F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
    )
    # k rows, one for each cluster.
    return by.join(best, "cluster", "left").agg(
        F.lit(algorithm).alias("algorithm"),
        F.sum("error").alias("wsse"),
        F.array_sort(F.collect_list(entry)).alias("clusters"),
    )


def words_by_cluster(assigned: DataFrame) -> DataFrame:
    """[cluster, term, tf] from assigned documents that still carry their words: no join,
    and the counts are added up before anything moves."""
    exploded = assigned.select("cluster", F.explode("words").alias("term"))
    return exploded.groupBy("cluster", "term").agg(F.count("*").alias("tf"))
