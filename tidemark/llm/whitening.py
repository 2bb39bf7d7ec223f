"""Whitening of embeddings: exact covariance, eigenvectors refined in mixed precision.

Components become whole numbers x = floor(scale * c) + shift. Two passes count them: the first gives the
number of vectors n and the sums S, the second the products of the centred vectors. Both are sums
of whole numbers (the centre is S/n rounded, whose rest is taken out afterwards by the exact
sums), so the covariance is exact and doesn't depend on how rows lie in partitions. Tasks
multiply whole numbers in double precision in slabs so small that every product sum is
exact; Spark adds the tasks' matrices.

The driver turns dims x dims numbers into eigenvectors: those of the matrix in single precision
are the start, and the iterations of Ogita and Aishima correct them with matrix products in
extended precision. Where eigenvalues are too close for a correction by their
difference, the matrix restricted to their vectors, less their mean, is solved on its own and turns these
vectors, after which the iterations can tell them apart. A last pass over all rows measures the
covariance of what was whitened.

Defined results: a row whose vector is null or holds null or non-finite entries isn't in the result. All vectors
count that have the commonest length of the others (ties: the longer one); rows of other lengths aren't in the
result, and neither are empty vectors. Components are held at +-`LARGEST` steps.
A component without variance (at most `FLAT` of the largest one's) has `whitened` null and `explained` 0, and
is left out of `identity_error`. Null and repeated ids are kept; equal eigenvalues are numbered in any order. An empty
table gives an empty result; other columns are not read. `deviation` is exact while it has 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

LARGEST = 1 << 27
# Vectors longer than this are refused: the driver holds dims x dims numbers.
MAX_DIMS = 2048
# Rows that a task multiplies at once.
SLAB = 4096
FLAT = 1e-15
ITERATIONS = 12
_WIDE = np.longdouble
_DIGITS = pa.decimal128(38, 0)


@dataclass
class Whitening:
    n: int
    centre: np.ndarray  # S/n rounded, whole numbers
    rest: np.ndarray  # S - n * centre, whole numbers
    weights: np.ndarray  # dims x components: eigenvectors over the roots of their eigenvalues
    explained: np.ndarray
    alive: np.ndarray  # components with variance


# Eigenvectors


def _groups(values: np.ndarray, gap: np.ndarray) -> list[np.ndarray]:
    """Runs of two or more neighbours in order of value that are no further apart than `gap`."""
    order = np.argsort(values)
    cuts = np.nonzero(np.diff(values[order]) > gap)[0] + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One correction: vectors, eigenvalues, and the size of the correction."""
    rest = np.eye(len(matrix), dtype=_WIDE) - vectors.T @ vectors
    turned = vectors.T @ (matrix @ vectors)
    values = np.diag(turned) / (1 - np.diag(rest))
    norm = lambda m: np.sqrt((m * m).sum())
    gap = 2 * (norm(turned - np.diag(values)) + norm(matrix) * norm(rest))
    apart = values[None, :] - values[:, None]
    near = np.abs(apart) <= gap
    for run in _groups(values, gap):
        near[np.ix_(run, run)] = True
    apart[near] = 1
    step = np.where(near, rest / 2, (turned + values[None, :] * rest) / apart)
    vectors = vectors + vectors @ step
    for run in _groups(values, gap):
        # The small problem of close eigenvalues, on its own scale.
        own = vectors[:, run]
        small = own.T @ (matrix @ own - values[run].mean() * own)
        size = np.abs(small).max()
        if size > 0:
            vectors[:, run] = own @ np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(_WIDE)
    return vectors, values, norm(step)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in extended precision."""
    matrix = matrix.astype(_WIDE)
    size = np.abs(matrix).max(initial=0)
    if not size:
        return np.zeros(len(matrix), dtype=_WIDE), np.eye(len(matrix), dtype=_WIDE)
    scaled = matrix / size
    vectors = np.linalg.eigh(scaled.astype(np.float32))[1].astype(_WIDE)
    least = np.finfo(_WIDE).max
    for _ in range(ITERATIONS):
        vectors, _, step = refine(scaled, vectors)
        # Corrections shrink until only rounding is left.
        if step >= least / 2 and step < 1e-14:
            break
        least = min(least, step)
    # Corrections by small differences of eigenvalues leave more rounding than those by one half.
    for _ in range(2):
        vectors = vectors + vectors @ (np.eye(len(matrix), dtype=_WIDE) - vectors.T @ vectors) / 2
    values = (vectors * (scaled @ vectors)).sum(axis=0) * size
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Exact sums


def _whole(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64) + shift


def products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns, as Python's whole numbers; at most SLAB rows."""
    if np.abs(rows).max(initial=0) < 1 << 20:
        whole = rows.astype(np.float64)
        return (whole.T @ whole).astype(np.int64).astype(object)
    # Halves whose products stay exact.
    high = (rows >> 15).astype(np.float64)
    low = (rows & 0x7FFF).astype(np.float64)
    exact = lambda m: m.astype(np.int64).astype(object)
    crossed = exact(high.T @ low)
    return exact(high.T @ high) * (1 << 30) + (crossed + crossed.T) * (1 << 15) + exact(low.T @ low)


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(len(batch), dims)


def _long_list(rows: list[list]) -> pa.Array:
    return pa.array([[Decimal(int(x)) for x in row] for row in rows], pa.list_(_DIGITS))


def _sums_by_length(kept: DataFrame, scale: int, shift: int) -> DataFrame:
    """[dims, place, total]: sums per length and component; place 0 counts the vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            for dims in np.unique(lengths).tolist():
                x = _whole(_vectors(batch.filter(pa.array(lengths == dims)), dims), scale, shift)
                own = sums.setdefault(dims, np.zeros(dims + 1, dtype=np.int64))
                own += np.concatenate([[len(x)], x.sum(axis=0)])
        lists = pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), lists], names=["dims", "sums"])

    parts = kept.select("v").mapInArrow(add, "dims long, sums array<long>")
    flat = parts.select("dims", F.posexplode("sums").alias("place", "part"))
    return flat.groupBy("dims", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))


def _centred_products(kept: DataFrame, centre: np.ndarray, scale: int, shift: int) -> np.ndarray:
    dims = len(centre)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), dtype=object)
        seen = False
        for batch in batches:
            seen = seen or len(batch) > 0
            centred = _whole(_vectors(batch, dims), scale, shift) - centre
            for a in range(0, len(centred), SLAB):
                total = total + products(centred[a : a + SLAB])
        # The matrix is symmetric: from its diagonal on.
        rows = [total[i, i:].tolist() for i in range(dims)] if seen else []
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), _long_list(rows)], names=["i", "sums"])

    parts = kept.select("v").mapInArrow(multiply, "i int, sums array<decimal(38,0)>")
    flat = parts.select("i", F.posexplode("sums").alias("place", "part"))
    read = flat.groupBy("i", "place").agg(F.sum("part").cast("decimal(38,0)").alias("total")).collect()
    out = np.zeros((dims, dims), dtype=object)
    for r in read:
        i, j = r["i"], r["i"] + r["place"]
        out[i, j] = out[j, i] = int(r["total"])
    return out


def covariance(n: int, rest: np.ndarray, centred: np.ndarray) -> np.ndarray:
    """From exact sums, rounded once."""
    above = n * centred - np.outer(rest, rest)
    return np.array([[_WIDE(str(int(v))) for v in row] for row in above], dtype=_WIDE) / _WIDE(n) / _WIDE(n)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return kept.where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def fit(kept: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> Whitening | None:
    """The transform of [id, v], or None without vectors."""
    sums = materialise(_sums_by_length(kept, scale, shift), "vector-sums")
    common = sums.where("place = 0").orderBy(F.desc("total"), F.desc("dims")).limit(1).collect()
    if not common:
        return None
    dims, n = common[0]["dims"], int(common[0]["total"])
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} components; {MAX_DIMS} at most")
    read = sums.where((F.col("dims") == dims) & (F.col("place") > 0)).orderBy("place").collect()
    total = np.array([int(r["total"]) for r in read], dtype=object)
    centre = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    rest = total - n * centre.astype(object)
    exact = covariance(n, rest, _centred_products(kept.where(F.size("v") == dims), centre, scale, shift))
    values, vectors = eigen(exact)
    trace, some = np.trace(exact), min(components, dims)
    alive = (values > FLAT * max(values[0], 0))[:some]
    weights = np.zeros((dims, some))
    weights[:, alive] = vectors[:, :some][:, alive] / np.sqrt(values[:some][alive])
    explained = np.where(alive, values[:some] / (trace if trace > 0 else 1), 0)
    return Whitening(n, centre, rest, weights, explained.astype(np.float64), alive)


def _projected(model: Whitening, v: np.ndarray, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers less the rounded centre, and their projections."""
    centred = _whole(v, scale, shift) - model.centre
    mean = (model.rest / model.n).astype(np.float64)
    return centred, (centred - mean) @ model.weights


def identity_error(kept: DataFrame, model: Whitening, scale: int, shift: int) -> float:
    """Largest difference of the whitened rows' covariance from the identity, measured over all rows."""
    dims, alive = len(model.centre), np.nonzero(model.alive)[0]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(alive) + 1, len(alive)))
        for batch in batches:
            z = _projected(model, _vectors(batch, dims), scale, shift)[1][:, alive]
            total += np.concatenate([z.T @ z, z.sum(axis=0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    flat = kept.select("v").mapInArrow(measure, "sums array<double>").select(F.posexplode("sums").alias("place", "part"))
    sums = np.zeros((len(alive) + 1) * len(alive))
    for r in flat.groupBy("place").agg(F.sum("part").alias("total")).collect():
        sums[r["place"]] = r["total"]
    sums = sums.reshape(len(alive) + 1, len(alive)) / model.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(len(alive))).max(initial=0.0))


def deviations(model: Whitening, centred: np.ndarray) -> pa.Array:
    """Sums over the components of (n * x - S)^2, exact."""
    most, dims = int(np.abs(centred).max(initial=0)), centred.shape[1]
    if (model.n * (most + 1)) ** 2 * dims < 1 << 62:
        out = (model.n * centred - model.rest.astype(np.int64)) ** 2
        return pa.array(out.sum(axis=1)).cast(_DIGITS)
    wide = centred if most**2 * dims < 1 << 62 else centred.astype(object)
    squares = (wide * wide).sum(axis=1)
    crossed = (centred.astype(object) * model.rest).sum(axis=1)
    last = int((model.rest**2).sum())
    n = model.n
    return pa.array([Decimal(n * n * int(s) - 2 * n * int(c) + last) for s, c in zip(squares, crossed, strict=True)], _DIGITS)


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 8,
    scale: int = 1024,
    shift: int = 100_000,
) -> DataFrame:
    """[id, component, n, deviation, whitened, explained, identity_error] of every row and component."""
    kept = usable(vectors, id_col, vector_col)
    kind = kept.schema["id"].dataType.simpleString()
    fields = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(kept, components, scale, shift)
    if model is None:
        return vectors.sparkSession.createDataFrame([], fields)
    dims, some = model.weights.shape
    own = kept.where(F.size("v") == dims)
    error = identity_error(own, model, scale, shift)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Slabs, because every row becomes `some` rows.
            for a in range(0, len(batch), SLAB):
                part = batch.slice(a, SLAB)
                rows = len(part)
                centred, z = _projected(model, _vectors(part, dims), scale, shift)
                at = pa.array(np.repeat(np.arange(rows), some))
                flat = lambda x: np.tile(x, rows)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(at),
                        pa.array(flat(np.arange(1, some + 1)).astype(np.int32)),
                        pa.array(np.full(rows * some, model.n, dtype=np.int64)),
                        deviations(model, centred).take(at),
                        pa.array(z.ravel(), mask=flat(~model.alive)),
                        pa.array(flat(model.explained)),
                        pa.array(np.full(rows * some, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return own.mapInArrow(apply, fields)
