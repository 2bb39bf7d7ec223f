"""The progressive search against all distances, whole rounds against plain loops, defined results."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import hadamard_clusters as hc
from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


def test_transform_is_exact_and_in_order_of_sign_changes():
    rng = np.random.default_rng(1)
    for dims in (1, 2, 8, 64):
        rows = rng.integers(-hc.LARGEST, hc.LARGEST, (20, dims))
        coded = hc.transform(rows)
        assert (hc.inverse(coded) == rows).all()
        basis = hc.transform(np.eye(dims, dtype=np.int64))
        assert [int((np.diff(basis[:, j]) != 0).sum()) for j in range(dims)] == list(range(dims))
        wide = coded.astype(object)
        assert ((wide**2).sum(axis=1) == dims * (rows.astype(object) ** 2).sum(axis=1)).all()
    with pytest.raises(ValueError):
        hc.sequency(48)


def _all_distances(rows, centres):
    out = []
    for row in rows.tolist():
        distances = [sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in centres.tolist()]
        out.append((distances.index(min(distances)), min(distances)))
    return out


@pytest.mark.parametrize("largest", [2, 300, hc.LARGEST])
def test_search_finds_what_all_distances_give(largest, monkeypatch):
    """Few values make many ties; the largest ones don't fit 64 bits once transformed."""
    monkeypatch.setattr(hc, "SLAB", 50)
    rng = np.random.default_rng(largest)
    rows = rng.integers(-largest, largest, (170, 64), endpoint=True)
    centres = rng.integers(-largest, largest, (23, 64), endpoint=True)
    centres[7] = centres[3]
    rows[:10] = centres[7]
    rows[20] = (centres[1] + centres[2]) // 2
    rows[30], centres[0] = -largest, largest
    own, distance = hc.nearest(hc.transform(rows), hc.transform(centres))
    assert list(zip(own.tolist(), distance.tolist(), strict=True)) == _all_distances(rows, centres)


def _plain(rows, k=40, rounds=5):
    """[(id, cluster, distance, digest)] and inertia by loops over all centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None]
    coded = {i: tuple(hc.transform(np.array([v]))[0].tolist()) for _, i, v in named}
    centres = [v for _, _, v in sorted(named, key=lambda r: (r[0], r[1], coded[r[1]]))[:k]]

    def place():
        return _all_distances(np.array([v for _, v in kept]), np.array(centres))

    for _ in range(rounds):
        members = {}
        for (_, v), (c, _) in zip(kept, place(), strict=True):
            members.setdefault(c, []).append(v)
        for c, own in members.items():
            centres[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return [
        (i, c, d, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, place(), strict=True)
    ]


def test_whole_query_against_plain_loops(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = sorted(_plain([tuple(r) for r in rows]))
    got = queries.op12_hadamard_search(spark, SF).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == want
    inertia = sum(d for _, _, d, _ in want)
    for r in got:
        assert r.inertia == inertia
        assert r.cluster_inertia == sum(d for _, c, d, _ in want if c == r.cluster)


def _write(spark, path, rows):
    fields = "vec_id long, embedding array<float>, label int, cluster string, distance int, coefficients int"
    spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], fields).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_hard_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(60, 64)))]
    rows += [(60 + i, rows[3][1]) for i in range(30)]
    odd = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [math.nan] + [1.0] * 63)]
    odd += [(205, [math.inf] + [1.0] * 63), (206, [None] + [1.0] * 63)]
    unnamed = (None, rows[5][1])
    got = queries.op12_hadamard_search(spark, _write(spark, tmp_path / "a", [*rows, *odd, unnamed])).collect()
    want = _plain([*rows, unnamed])
    key = lambda r: (r[0] is None, r[0])
    assert sorted(((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got), key=key) == sorted(want, key=key)
    # Fewer vectors than centroids, repeated ids, components of zero and far beyond the largest.
    few = [(1, [0.0] * 64), (1, [0.0] * 64), (2, [3e38] * 64), (3, [-3e38] * 64)]
    got = queries.op12_hadamard_search(spark, _write(spark, tmp_path / "b", few)).collect()
    assert len(got) == 4 and all(r.distance == 0 for r in got) and len({r.cluster for r in got if r.vec_id == 1}) == 1
    lone = queries.op12_hadamard_search(spark, _write(spark, tmp_path / "c", [unnamed])).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in lone] == [(None, None, None)]
    assert queries.op12_hadamard_search(spark, _write(spark, tmp_path / "d", [])).collect() == []
    assert queries.op12_hadamard_search(spark, _write(spark, tmp_path / "e", odd)).collect() == []


def test_most_centroids_are_dropped_early(monkeypatch):
    """Close groups: after the first level few pairs are left."""
    rng = np.random.default_rng(8)
    centres = rng.integers(-300, 300, (40, 64))
    rows = centres[rng.integers(0, 40, 1000)] + rng.integers(-5, 5, (1000, 64))
    kept = []
    nonzero = np.nonzero
    monkeypatch.setattr(hc.np, "nonzero", lambda x: kept.append(int(np.asarray(x).sum())) or nonzero(x))
    own, _ = hc.nearest(hc.transform(rows), hc.transform(centres))
    assert kept[0] < 2000
