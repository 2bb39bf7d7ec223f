"""Near-duplicate vectors against all pairs, estimates against their bounds."""

import numpy as np

from tidemark.llm import queries, vector_neardup
from tidemark.llm.components import components


def _direct(vectors):
    """(links, smallest row reachable) of each row, None for what can't be compared."""
    n = len(vectors)
    sound = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors
    ]
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(a):
            if sound[a] and sound[b] and len(vectors[a]) == len(vectors[b]):
                x, y = (np.float32(vectors[i]).astype(float) for i in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links[a].append(b)
                    links[b].append(a)
    least = list(range(n))
    for _ in range(n):
        least = [min([least[a], *(least[b] for b in links[a])]) for a in range(n)]
    return [len(x) for x in links], least


def test_query_against_all_pairs(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = []
    for size in (40, 9, 3):
        centre = rng.normal(size=16)
        vectors += [(centre + rng.normal(size=16) * 0.2).tolist() for _ in range(size)]
    vectors += [rng.normal(size=16).tolist() for _ in range(60)]
    vectors += [vectors[0]] * 7 + [(np.array(vectors[1]) * 3.0e30).tolist(), (-np.array(vectors[0])).tolist()]
    vectors += [None, [], [0.0] * 16, [1.0, None] * 8, [1.0, float("nan")] * 8, [1.0, float("inf")] * 8]
    vectors += [[1.0, 2.0, 3.0], [1.0, 2.0, 3.01], [5.0], [7.0], [-1.0]]
    ids = list(range(10, 10 + len(vectors)))
    rows = [(i, v, "x", 1) for i, v in zip(ids, vectors, strict=True)] + [(None, vectors[0], "x", 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, uid int").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    got = {r.vec_id: r for r in queries.op6_rotation_codes(spark, str(tmp_path)).collect()}
    links, least = _direct(vectors)
    for i, n, c in zip(ids, links, least, strict=True):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, ids[c], i == ids[c])
    assert (got[None].n_links, got[None].component_id) == (0, None)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(vector_neardup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=8)
    vectors = [(centre + rng.normal(size=8) * 0.12).tolist() for _ in range(120)]
    df = spark.createDataFrame([*enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {r.id: (r.n_links, r.component) for r in vector_neardup.near_duplicates(df).collect()}
    links, least = _direct(vectors)
    assert got == {i: (links[i], least[i]) for i in range(len(vectors))}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op6_rotation_codes(spark, str(tmp_path)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(400, 64))
    near = 0.9 * base + 0.4 * rng.normal(size=(400, 64))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (base, near))
    codes, factors, _ = vector_neardup.encode(x)
    cosines, bound = vector_neardup.estimate(codes, factors, vector_neardup.encode(y)[2])
    error = cosines - x @ y.T
    assert abs(error.mean()) < 0.002 and (np.abs(error) <= bound[:, None]).all()


def test_tables_meet_the_promised_miss():
    for n in (10, 10_000, 10_000_000):
        bits, tables = vector_neardup.plan_tables(n, 0.95)
        meet = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - meet) ** tables <= vector_neardup.MISS


def test_components_of_hard_graphs(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = chain + star + ring + [(300, 300), (2, 1), (2, 1)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 1 for i in range(2, 41)} | {i: 100 for i in range(101, 160)} | {200 + i: 200 for i in range(1, 9)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
