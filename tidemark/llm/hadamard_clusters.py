"""Centroid clustering of whole-number vectors with a progressive search among Walsh-Hadamard coefficients.

Vectors of `dims` components (a power of two) become whole numbers and are transformed once by the
exact integer Walsh-Hadamard transform, coefficients in order of their sign changes, coarse to fine;
that table is written and every round reads it. Squared distances of coefficients are `dims` times
those of the vectors. The search adds up the differences of a vector and all
centroids over the coarsest coefficients, finishes the most promising centroid, and then goes
on level by level with the centroids whose sum so far isn't above that centroid's distance: what is
dropped is strictly worse, and the others are compared over all coefficients.

A round is one pass: each task gives the sums of its vectors' coefficients per cluster, Spark adds
them up, and the driver gets clusters x dims sums, which the inverse transform turns into
the exact sums of the vectors. A cluster with most of the rows is therefore no heavier than others.

Defined results: a vector is kept if it has exactly `dims` components, none of them null or non-finite;
other rows aren't in the result. Components are held at +-`LARGEST`, beyond which a distance
wouldn't fit a long; up to there all figures are exact. Rows with a null id are clustered but never start a
centroid, and when nothing starts one, cluster and distance are null. Repeated ids are
vectors of their own and may start several centroids, in the order of their vectors. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

LARGEST = 1 << 27
# Coefficients up to here have distances that fit 64 bits; larger ones are calculated in Python's whole numbers.
NARROW = 1 << 27
# Ends of the levels, as shares of all coefficients.
LEVELS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)
# Vectors that are compared at once.
SLAB = 4096


def sequency(dims: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by number of sign changes."""
    if dims < 1 or dims & (dims - 1):
        raise ValueError("the number of components must be a power of two")
    signs = np.ones((1, 1), dtype=np.int64)
    while len(signs) < dims:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def butterflies(rows: np.ndarray) -> np.ndarray:
    """The transform of each row in natural order; twice gives the row times its length."""
    dims, out, half = rows.shape[1], rows, 1
    while half < dims:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), dims)
        half *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    return butterflies(rows)[:, sequency(rows.shape[1])]


def inverse(coefficients: np.ndarray) -> np.ndarray:
    dims = coefficients.shape[1]
    natural = np.empty_like(coefficients)
    natural[:, sequency(dims)] = coefficients
    return butterflies(natural) // dims


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64)


def _fitting(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if max(np.abs(rows).max(initial=0), np.abs(centres).max(initial=0)) > NARROW:
        return rows.astype(object), centres.astype(object)
    return rows.astype(np.int64), centres.astype(np.int64)


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row of coefficients (ties: the smaller number), and the squared distance of the vectors."""
    parts = [_nearest(rows[a : a + SLAB], centres) for a in range(0, len(rows), SLAB)]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(c for c, _ in parts)]), np.concatenate([none, *(d for _, d in parts)])


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, centres = _fitting(rows, centres)
    dims = rows.shape[1]
    ends = sorted({max(1, round(dims * share)) for share in LEVELS})
    sums = np.zeros((len(rows), len(centres)), dtype=rows.dtype)
    for j in range(ends[0]):
        sums += (rows[:, j, None] - centres[None, :, j]) ** 2
    # The distance of one centroid is a limit for all.
    first = centres[sums.argmin(axis=1)]
    limit = ((rows - first) ** 2).sum(axis=1)
    own, at = np.nonzero(sums <= limit[:, None])
    sums = sums[own, at]
    for a, b in zip(ends, ends[1:], strict=False):
        sums = sums + ((rows[own, a:b] - centres[at, a:b]) ** 2).sum(axis=1)
        left = np.asarray(sums <= limit[own], dtype=bool)
        own, at, sums = own[left], at[left], sums[left]
    # Pairs are in order of vector and centroid, and each vector has one.
    least = np.minimum.reduceat(sums, np.searchsorted(own, np.arange(len(rows))))
    best = np.nonzero(np.asarray(sums == least[own], dtype=bool))[0]
    best = best[np.unique(own[best], return_index=True)[1]]
    return at[best].astype(np.int64), (least // dims).astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def prepare(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 256) -> DataFrame:
    """[id, coefficients] of the kept vectors, written once."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    sequency(dims)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = transform(whole_numbers(_matrix(batch.column("v"), dims), scale))
            offsets = pa.array(np.arange(0, coded.size + 1, dims), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(coded.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "coefficients"])

    kind = kept.schema["id"].dataType.simpleString()
    return materialise(kept.mapInArrow(apply, f"id {kind}, coefficients array<long>"), "coefficients")


def _first_centres(coded: DataFrame, k: int, prefix: str) -> np.ndarray:
    """Coefficients of the k vectors with the smallest hash of prefix and id."""
    hashed = coded.where("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256))
    chosen = hashed.orderBy("h", "id", "coefficients").select("coefficients").limit(k).collect()
    return np.array([r["coefficients"] for r in chosen], dtype=np.int64)


def cluster_sums(coded: DataFrame, centres: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Size and exact sums of coefficients of every cluster that isn't empty: clusters x dims numbers."""
    k, dims = centres.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            own, _ = nearest(rows, centres)
            np.add.at(sums, own, rows)
            sizes += np.bincount(own, minlength=k)
        full = np.nonzero(sizes)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(sizes[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], names=["cluster", "size", "sums"]
        )

    parts = coded.select("coefficients").mapInArrow(add, "cluster long, size long, sums array<long>")
    # Position 0 holds the sizes.
    flat = parts.select("cluster", F.posexplode(F.concat(F.array("size"), "sums")).alias("place", "part"))
    total = flat.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found: dict[int, list[int]] = {}
    for r in total.collect():
        found.setdefault(r["cluster"], [0] * (dims + 1))[r["place"]] = int(r["total"])
    return {c: (numbers[0], numbers[1:]) for c, numbers in found.items()}


def fit(coded: DataFrame, k: int = 40, rounds: int = 5, prefix: str = "2:") -> np.ndarray:
    """Centroids as whole numbers (at most k x dims), after the given rounds."""
    first = _first_centres(coded, k, prefix)
    if not len(first):
        return first.reshape(0, 1)
    centroids = inverse(first)
    for _ in range(rounds):
        for cluster, (size, sums) in cluster_sums(coded, transform(centroids)).items():
            exact = inverse(np.array([sums], dtype=object))[0]
            centroids[cluster] = np.array([s // size for s in exact], dtype=np.int64)
    return centroids


def assign(coded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """[id, cluster, distance] of every kept vector."""
    kind = coded.schema["id"].dataType.simpleString()
    if not len(centroids):
        return coded.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    centres = transform(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance = nearest(_matrix(batch.column("coefficients"), centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(own.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
            )

    return coded.mapInArrow(place, f"id {kind}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    prefix: str = "2:",
) -> DataFrame:
    """[id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256] of every kept vector."""
    coded = prepare(vectors, id_col, vector_col, dims, scale)
    centroids = fit(coded, k, rounds, prefix)
    placed = materialise(assign(coded, centroids), "clusters")
    wide = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    sums = {r["cluster"]: int(r["inertia"]) for r in wide if r["cluster"] is not None}
    total, largest = sum(sums.values()), (1 << 63) - 1
    rows = [
        (c, min(inertia, largest), min(total, largest), centroids[c].tolist(), digest(centroids[c])) for c, inertia in sums.items()
    ]
    fields = "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    # One row per cluster.
    known = placed.sparkSession.createDataFrame(rows, fields)
    return placed.join(F.broadcast(known), "cluster", "left").select("id", "cluster", "distance", *known.columns[1:])
