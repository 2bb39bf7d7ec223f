"""Near-duplicate vectors: codes of randomised rotations, estimates with bounds, exact cosines.

A vector's code holds the signs of its components after a random rotation, with the inner
product of the vector and its own code as correction factor. Code, factor and the other
vector give an unbiased estimate of the cosine and a bound on its error; pairs whose
estimate and bound stay below the threshold are dropped, all others get the exact cosine in
double precision, which alone decides. Estimates are made inside buckets: bits of further
rotations are the keys of so many tables that a pair at the threshold shares a bucket in one
of them with probability 1 - `MISS`, more similar pairs with a higher one; the bits of a key
grow with the logarithm of the number of vectors. A pair that meets in several tables counts
in the first.

Equal vectors are collapsed to one class with a weight first, so that copies are never expanded.
Buckets above `BLOCK` classes are cut into blocks, and each pair of blocks is a cell of its
own: no task holds a bucket, and a cell gives sums and a spanning forest, not its pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, and so do rows with a null id. Only vectors of one length are compared. Rows with
equal ids are separate vectors and one vertex of the components. An empty table gives
an empty result. Extra columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import materialise

# Probability that a pair exactly at the threshold shares no bucket.
MISS = 1e-5
# Classes that a bucket is meant to hold, and those from which it is cut.
BUCKET = 256
BLOCK = 1024
# Bound of the estimate in standard deviations of its error.
SIGMAS = 6.0
SEED = 6


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dims, seed]).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def plan_tables(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a key, number of tables."""
    bits = min(24, max(4, round(math.log2(max(n, 1) / BUCKET)) if n else 4))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - meet))


def bucket_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Keys (rows x tables): signs of components of as many rotations as are needed."""
    dims = unit.shape[1]
    needed = bits * tables
    signs = np.concatenate(
        [unit @ rotation(dims, 1 + i).T > 0 for i in range(-(-needed // dims))], axis=1
    )[:, :needed].reshape(len(unit), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def estimate(codes: np.ndarray, factors: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of all coded with all rotated vectors, and the bound of each coded vector's error."""
    dims = codes.shape[1]
    cosines = (codes @ rotated.T) / (math.sqrt(dims) * factors[:, None])
    spread = np.sqrt(np.maximum(0, 1 - factors**2) / (factors**2 * max(1, dims - 1)))
    return cosines, SIGMAS * spread + 1e-5


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes as +-1, correction factors, rotated vectors."""
    rotated = (unit @ rotation(unit.shape[1], 0).T).astype(np.float32)
    codes = np.where(rotated > 0, np.float32(1), np.float32(-1))
    return codes, np.abs(rotated).sum(axis=1) / math.sqrt(unit.shape[1]), rotated


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors in double precision at length 1, without overflow for large components."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def linked_pairs(unit: np.ndarray, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs p < q with a cosine of at least `threshold`; of different sides where these are given."""
    codes, factors, rotated = encode(unit)
    cosines, bound = estimate(codes, factors, rotated)
    p, q = np.nonzero(np.triu(cosines + bound[:, None] >= threshold, 1))
    if side is not None:
        apart = side[p] != side[q]
        p, q = p[apart], q[apart]
    # Exact cosines, in slices of bounded size.
    exact = np.concatenate(
        [np.einsum("ij,ij->i", unit[p[a : a + 65536]], unit[q[a : a + 65536]]) for a in range(0, len(p), 65536)]
        or [np.zeros(0)]
    )
    return p[exact >= threshold], q[exact >= threshold]


def _forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n."""
    labels = np.arange(n)
    while True:
        before = labels.copy()
        np.minimum.at(labels, p, labels[q])
        np.minimum.at(labels, q, labels[p])
        labels = labels[labels]
        if (labels == before).all():
            return labels


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """[id, n_links, component] of every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    sound = (
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    # The array itself is the key of a class: equal vectors, whatever their ids.
    classes = rows.where(sound).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = materialise(classes.withColumn("uid", F.monotonically_increasing_id()), "vector-classes")
    bits, tables = plan_tables(classes.count(), threshold)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(pa.list_(pa.float64()))
            lengths = np.diff(lists.offsets.to_numpy())
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lengths)
            keys = np.zeros((len(lengths), tables), dtype=np.int32)
            for dims in np.unique(lengths):
                own = np.nonzero(lengths == dims)[0]
                at = ends[own][:, None] - dims + np.arange(dims)
                keys[own] = bucket_keys(_units(flat[at]), bits, tables)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, "keys"])

    kind = dict(rows.dtypes)["v"]
    fields = f"v {kind}, rep long, weight long, uid long"
    coded = classes.select("v", "rep", "weight", "uid").mapInArrow(keyed, f"{fields}, keys array<int>")
    coded = materialise(coded, "vector-codes")
    places = coded.select("*", F.posexplode("keys").alias("t", "key")).withColumn("dims", F.size("v"))
    where = ["t", "key", "dims"]
    sizes = coded.select(F.size("v").alias("dims"), F.posexplode("keys").alias("t", "key")).groupBy(*where)
    sizes = sizes.agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    # A written table on this side lets a bucket with many rows be split by the join.
    sizes = materialise(sizes.drop("n"), "vector-buckets")
    own = F.pmod(F.xxhash64("uid"), F.col("blocks"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cells = places.join(sizes, where).withColumn("own", own).withColumn("other", others)
    cells = cells.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    # The largest cells hold two blocks, whatever the size of their bucket.
    cells = cells.select(*where, "low", "high", "own", "uid", "rep", "weight", "v", "keys")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rep")
        n, t = len(table), table.column("t")[0].as_py()
        vector = table.column("v").combine_chunks().flatten().to_numpy().reshape(n, -1)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(n, -1)
        rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        whole = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        p, q = linked_pairs(_units(vector), None if whole else table.column("own").to_numpy(), threshold)
        fresh = ~(keys[p, :t] == keys[q, :t]).any(axis=1) if t else np.ones(len(p), dtype=bool)
        p, q = p[fresh], q[fresh]
        links = np.bincount(p, weight[q], n) + np.bincount(q, weight[p], n)
        found = links > 0
        return pa.table(
            {
                "uid": table.column("uid").to_numpy()[found],
                "rep": rep[found],
                "root": rep[_forest(n, p, q)][found],
                "n_links": links[found].astype(np.int64),
            }
        )

    met = cells.groupBy(*where, "low", "high").applyInArrow(compare, "uid long, rep long, root long, n_links long")
    met = materialise(met, "vector-links")
    counts = met.groupBy("uid").agg(F.sum("n_links").alias("other_links"))
    # Members of one class are linked through its smallest id, classes through theirs.
    joined = classes.select("v", "rep", "weight", "uid").join(counts, "uid", "left")
    joined = joined.withColumn("n_links", F.coalesce("other_links", F.lit(0).cast("long")) + F.col("weight") - 1)
    graph = met.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    graph = graph.unionByName(
        rows.where(sound).join(classes.where("weight > 1").select("v", "rep"), "v").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    tree = components(graph)
    per_class = materialise(joined.select("v", "n_links"), "vector-classes-linked")
    out = rows.where(sound).join(per_class, "v").select("id", "n_links")
    out = out.unionByName(rows.where(~F.coalesce(sound, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links")))
    return out.join(tree, "id", "left").select("id", "n_links", F.coalesce("component", "id").alias("component"))
