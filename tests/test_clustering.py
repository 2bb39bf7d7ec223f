import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from tidemark.operators import clustering as ops
from tidemark.operators import sparse_kmeans as sparse
from tidemark.operators import text
from tidemark.sources.sinks import write_cluster_report


def dense_points(spark, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>")


def sparse_points(spark, matrix):
    rows = [(i, Vectors.sparse(len(row), [(j, float(x)) for j, x in enumerate(row) if x])) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, ["id", "vec"])


def brute_lloyd(x, centres, rounds):
    centres = centres.copy()
    for _ in range(rounds):
        best = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        for c in range(len(centres)):
            if (best == c).any():
                centres[c] = x[best == c].mean(0)
    d2 = ((x[:, None] - centres[None]) ** 2).sum(-1)
    return d2.argmin(1), d2.min(1), centres


@pytest.mark.parametrize("make", [dense_points, sparse_points])
@pytest.mark.parametrize("width", [6, 2500])
def test_lloyd_against_numpy(spark, make, width):
    rng = np.random.default_rng(width)
    x = np.where(rng.random((80, width)) < 0.3, rng.normal(size=(80, width)), 0.0)
    points = make(spark, x)
    assigned, centres = ops.lloyd_kmeans(points, ops.smallest_id_centres(points, 4), 5)
    best, d2, expected = brute_lloyd(x, x[:4], 5)
    rows = assigned.orderBy("id").collect()
    assert [r.cluster for r in rows] == list(best)
    assert [r.d2 for r in rows] == pytest.approx(list(d2))
    got = np.array([r.vec for r in centres.orderBy("cluster").collect()])
    assert np.allclose(got, expected)


def test_wsse_never_grows(spark):
    x = np.random.default_rng(2).normal(size=(60, 3))
    points = dense_points(spark, x)
    init = ops.sampled_centres(points, 5, 9)
    totals = [ops.lloyd_kmeans(points, init, n)[0].agg(F.sum("d2")).first()[0] for n in (0, 1, 3, 8)]
    assert all(b <= a + 1e-9 for a, b in zip(totals, totals[1:]))


def test_ties_and_empty_clusters(spark):
    points = dense_points(spark, [[0.0], [1.0], [2.0]])
    init = spark.createDataFrame([(0, [0.0]), (1, [2.0]), (2, [99.0])], "cluster int, vec array<double>")
    assert [r.cluster for r in ops.assign_nearest(points, init).orderBy("id").collect()] == [0, 0, 1]
    _, centres = ops.lloyd_kmeans(points, init, 3)
    assert [r.vec for r in centres.orderBy("cluster").collect()] == [[0.5], [2.0], [99.0]]


def test_documents_without_words(spark):
    rows = [(0, SparseVector(3, {})), (1, Vectors.dense([1.0, 0.0, 2.0]))]
    points = spark.createDataFrame(rows, ["id", "vec"])
    init = spark.createDataFrame([(0, [0.0, 0.0, 0.0]), (1, [1.0, 0.0, 1.0])], "cluster int, vec array<double>")
    found = ops.assign_nearest(points, init).orderBy("id").collect()
    assert [(r.cluster, r.d2) for r in found] == [(0, 0.0), (1, 1.0)]


def test_model_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(ops, "MAX_MODEL_VALUES", 3)
    points = dense_points(spark, [[0.0, 1.0], [1.0, 1.0]])
    with pytest.raises(ValueError):
        ops.assign_nearest(points, ops.smallest_id_centres(points, 2))


def documents(spark, texts):
    rows = [(i, [w for w in t.split(" ") if w]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, words array<string>")


def test_term_weights(spark):
    docs = documents(spark, ["a a b", "a  c", "", "b b b"])
    counts = {(r.doc_id, r.term): r.tf for r in text.term_counts(docs).collect()}
    assert counts == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1, (1, "c"): 1, (3, "b"): 3}
    found = {r.term: (r.df, r.idf) for r in text.idf(text.term_counts(docs), 4).collect()}
    assert found["a"] == (2, pytest.approx(np.log(5 / 3))) and found["c"][1] == pytest.approx(np.log(5 / 2))
    assert text.tfidf_long(docs).count() == 5
    hashed = text.tfidf(docs, 1 << 20).select(F.unwrap_udt("features").alias("f")).collect()
    exact = {round(r.tfidf, 9) for r in text.tfidf_long(docs).collect()}
    assert {round(v, 9) for r in hashed for v in r.f["values"]} == exact
    bag = {(r.doc_id, r.term): (r.position, r.tf) for r in text.bag_of_words(docs).collect()}
    assert bag == {(0, "a"): (0, 2), (0, "b"): (1, 1), (1, "a"): (0, 1), (1, "c"): (2, 1), (3, "b"): (1, 3)}
    plan = text.term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def count_matrix(seed=12, rows=60, width=25):
    matrix = np.random.default_rng(seed).poisson(0.7, size=(rows, width)).astype(float)
    matrix[7] = 0
    return matrix


def sparse_rows(spark, matrix):
    rows = [(i, 10 * j, x) for i, row in enumerate(matrix.tolist()) for j, x in enumerate(row) if x]
    ids = spark.range(len(matrix)).withColumnRenamed("id", "doc_id")
    return sparse.documents_rows(ids, spark.createDataFrame(rows, "doc_id bigint, term_id bigint, x double"))


def distances(matrix, centres):
    return ((matrix[:, None] - centres[None]) ** 2).sum(axis=2).round(6)


def dense_rounds(matrix, centres, rounds):
    for _ in range(rounds):
        best = distances(matrix, centres).argmin(axis=1)
        centres = np.array([matrix[best == c].mean(axis=0) if (best == c).any() else centres[c] for c in range(len(centres))])
    return centres


def as_matrix(centres, k, width=25):
    dense = np.zeros((k, width))
    for r in centres.collect():
        dense[r.cluster, r.id // 10] = r.x
    return dense


@pytest.mark.parametrize("held", [1 << 24, 0])
def test_sparse_k_means_against_a_dense_one(spark, monkeypatch, held):
    """With the centres in the tasks, and by joins."""
    monkeypatch.setattr(sparse, "MAX_VALUES", held)
    matrix = count_matrix()
    assigned, centres = sparse.kmeans(sparse_rows(spark, matrix), 4, 3)
    dense = dense_rounds(matrix, matrix[:4].copy(), 3)
    d2 = distances(matrix, dense)
    got = {r.doc_id: (r.cluster, r.d2) for r in assigned.collect()}
    assert {i: c for i, (c, _) in got.items()} == dict(enumerate(d2.argmin(axis=1).tolist()))
    assert all(abs(got[i][1] - d2[i].min()) < 2e-6 for i in got)
    assert np.allclose(as_matrix(centres, 4), dense)


@pytest.mark.parametrize("held", [1 << 24, 0])
@pytest.mark.parametrize("k", [1, 2, 3, 6])
def test_splits_against_a_dense_tree(spark, monkeypatch, held, k):
    monkeypatch.setattr(sparse, "MAX_VALUES", held)
    matrix = count_matrix(k)
    label, d2, centres = np.zeros(60, dtype=int), None, [dense_rounds(matrix, matrix[:1], 1)[0]]
    d2 = distances(matrix, np.array(centres))[:, 0]
    while len(centres) < k:
        sizes = {g: int((label == g).sum()) for g in range(len(centres))}
        chosen = sorted((g for g in sizes if sizes[g] >= 2), key=lambda g: (-sizes[g], g))[: k - len(centres)]
        for g in chosen:
            own = np.nonzero(label == g)[0]
            pair = dense_rounds(matrix[own], matrix[own[:2]], 2)
            both = distances(matrix[own], pair)
            label[own[both.argmin(axis=1) == 1]] = len(centres)
            d2[own] = both.min(axis=1)
            centres[g] = pair[0]
            centres.append(pair[1])
    assigned, found = sparse.bisecting(sparse_rows(spark, matrix), k, 2)
    got = {r.doc_id: (r.cluster, r.d2) for r in assigned.collect()}
    assert {i: c for i, (c, _) in got.items()} == dict(enumerate(label.tolist()))
    assert all(abs(got[i][1] - d2[i]) < 2e-6 for i in got)
    assert np.allclose(as_matrix(found, k), np.array(centres))


@pytest.mark.parametrize("values", [7, 1 << 18])
@pytest.mark.parametrize("step", [1, 1 << 40])
def test_a_task_sends_its_sums_once_and_packed(monkeypatch, values, step):
    """Documents of two groups in four batches, each with two centres; ids looked up in a table, and searched."""
    monkeypatch.setattr(sparse, "SLICE", values)
    matrix = np.random.default_rng(5).poisson(0.2, size=(40, 2500)).astype(float)
    known, grp = np.arange(2500) * step, np.arange(40) % 3
    model = sparse.Centres(known, np.ascontiguousarray(matrix[:4].T), np.array([0, 0, 1, 1]))
    lists = [(known[row > 0].tolist(), row[row > 0].tolist()) for row in matrix]
    whole = pa.RecordBatch.from_arrays(
        [pa.array(grp), pa.array([i for i, _ in lists], pa.list_(pa.int64())), pa.array([x for _, x in lists], pa.list_(pa.float64()))],
        names=["grp", "ids", "xs"],
    )
    sent = [r for b in sparse._sums(model)(whole.slice(i, 10) for i in range(0, 40, 10)) for r in b.to_pylist()]
    assert sorted(r["block"] for r in sent) == [-1, 0, 1, 2]
    d2 = distances(matrix, matrix[:4])
    d2[grp[:, None] != model.groups[None]] = np.inf
    best = np.where(grp < 2, d2.argmin(axis=1), -1)
    total, members = np.zeros(3 * sparse.BLOCK * 4), np.zeros(4)
    for r in sent:
        at = r["block"] * sparse.BLOCK * 4
        sparse._unpack(r["places"], r["sums"], members if at < 0 else total[at : at + sparse.BLOCK * 4])
    assert members.tolist() == [int((best == c).sum()) for c in range(4)]
    assert np.allclose(total.reshape(-1, 4)[:2500].T, [matrix[best == c].sum(axis=0) for c in range(4)])


@pytest.mark.parametrize("cluster", [sparse.kmeans, sparse.bisecting])
def test_terms_beyond_the_held_ones_give_the_same(spark, monkeypatch, cluster):
    """Ids twice and null, terms of few documents, and only rows of terms that aren't held are exchanged."""
    rng = np.random.default_rng(8)
    matrix = rng.poisson(np.linspace(0.02, 1.2, 25), size=(60, 25)).astype(float)
    rows = [(i, j, x) for i, row in enumerate(matrix.tolist()) for j, x in enumerate(row) if x]
    ids = spark.createDataFrame([(i,) for i in [*range(60), 7, 7, 20, None, None]], "doc_id bigint")
    docs = sparse.documents_rows(ids, spark.createDataFrame(rows, "doc_id bigint, term_id bigint, x double"))
    results = []
    for values in (1 << 24, 40):
        monkeypatch.setattr(sparse, "MAX_VALUES", values)
        placed, centres = cluster(docs, 4, 3)
        found = sorted(((r.doc_id is None, r.doc_id or 0, r.cluster), r.d2) for r in placed.collect())
        results.append((found, as_matrix(centres.withColumn("id", F.col("id") * 10), 4)))
    for found, centres in results[1:]:
        assert [r for r, _ in found] == [r for r, _ in results[0][0]]
        assert [d2 for _, d2 in found] == pytest.approx([d2 for _, d2 in results[0][0]], abs=2e-6)
        assert np.allclose(centres, results[0][1])
    monkeypatch.setattr(sparse, "MAX_VALUES", 40)
    terms = sparse.known_terms(docs, 4)
    often = np.array([(matrix[:, j] > 0).sum() for j in range(25)])
    assert 0 < len(terms.held) <= 10 and often[terms.held].min() > np.delete(often, terms.held).max()
    rest = {(r.doc_id, r.id): r.x for r in terms.rest.collect()}
    assert rest == {(i, j): x for i, j, x in rows if j not in terms.held}
    start = sparse.smallest_ids(docs, 4).select("doc_id", (F.col("r") - 1).cast("int").alias("cluster"))
    plan = sparse.place(docs, sparse.lloyd(docs, start, [0] * 4, 1, terms))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        labelled = sparse._split(docs.withColumn("d2", F.lit(0.0)), docs, terms)[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert labelled.count("Exchange") == 1 and "Bucketed: true" in labelled


def test_rounds_read_packed_documents_of_groups_that_move(spark, monkeypatch):
    """Twelve equal documents settle at once, the others go on; values are read as bytes, with empty documents and ids twice."""
    matrix = count_matrix(3)
    matrix[:12] = matrix[0]
    matrix[30] = 0
    docs = sparse_rows(spark, matrix).withColumn("grp", F.when(F.col("doc_id") < 12, 0).otherwise(1))
    docs = docs.unionByName(docs.where("doc_id = 40"))
    terms = sparse.known_terms(docs, 4)
    packed = sparse.packed(docs, terms)
    back = {r.doc_id: (r.p2, np.frombuffer(r.places, np.int32).tolist(), np.frombuffer(r.xs).tolist()) for r in packed.collect()}
    for i, (p2, places, xs) in back.items():
        own = dict(zip((terms.held[places] // 10).tolist(), xs, strict=True))
        assert own == {j: x for j, x in enumerate(matrix[i]) if x} and p2 == pytest.approx((matrix[i] ** 2).sum())
    seen, one = [], sparse._held_round
    monkeypatch.setattr(sparse, "_held_round", lambda d, m: seen.append((d.columns, {r.grp for r in d.collect()})) or one(d, m))
    start = spark.createDataFrame([(0, 0), (1, 1), (12, 2), (13, 3)], "doc_id bigint, cluster int")
    found = sparse.lloyd(packed, start, [0, 0, 1, 1], 8, terms)
    assert all("ids" not in columns for columns, _ in seen) and [g for _, g in seen][:2] == [{0, 1}, {1}]
    rows = np.array([*range(60), 40])
    mine, other = matrix[rows[rows < 12]], matrix[rows[rows >= 12]]
    want = np.concatenate([dense_rounds(mine, mine[:2].copy(), 8), dense_rounds(other, other[:2].copy(), 8)])
    assert np.allclose(as_matrix(sparse.table(found, packed), 4), want)


def test_splits_of_equal_and_of_few_documents(spark):
    same = sparse_rows(spark, np.ones((5, 25)))
    assert {r.cluster for r in sparse.bisecting(same, 3, 2)[0].collect()} == {0}
    two = sparse_rows(spark, np.eye(2, 25))
    assert sorted(r.cluster for r in sparse.bisecting(two, 8, 3)[0].collect()) == [0, 1]
    none = sparse.documents_rows(spark.range(0).withColumnRenamed("id", "doc_id"), spark.createDataFrame([], "doc_id bigint, term_id bigint, x double"))
    assert sparse.bisecting(none, 3, 2)[0].count() == 0 == sparse.kmeans(none, 3, 2)[0].count()


def test_a_wrong_fit_shows_in_the_check(spark):
    docs = sparse_rows(spark, count_matrix())
    assigned, centres = sparse.kmeans(docs, 4, 3)
    wrong = F.abs(F.col("own") - F.col("d2")) > 1e-4
    farther = F.col("own") - F.col("least") > 1e-4
    counts = lambda a, c: tuple(ops.recomputed(docs, a, c).agg(F.count_if(wrong), F.count_if(farther), F.count("*")).first())
    assert counts(assigned, centres) == (0, 0, 60)
    assert counts(assigned, centres.withColumn("x", F.col("x") * 1.1))[0] > 50
    moved = assigned.withColumn("cluster", (F.col("cluster") + 1) % 4)
    assert counts(moved, centres)[1] > 50


@pytest.mark.parametrize("words", [1, 3, 1 << 20])
def test_term_counts_in_slices(spark, monkeypatch, words):
    monkeypatch.setattr(text, "SLICE_WORDS", words)
    rows = [["a", "a", "", "b"], None, [], ["é", None, "é", "a"], [""], ["a"] * 7]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(rows, pa.list_(pa.string()))], names=["doc_id", "words"])
    found = sorted(tuple(r.values()) for out in text._count_words([batch]) for r in out.to_pylist())
    want = Counter((i, w) for i, ws in enumerate(rows) for w in ws or [] if w)
    assert found == sorted((i, w, n) for (i, w), n in want.items())


def test_top_terms_and_their_literal_form(spark):
    rows = [(0, 1, "x", 3), (0, 2, "x", 2), (0, 1, "y", 4), (0, 2, "z", 1), (1, 3, "b", 1), (1, 3, "a", 1)]
    terms = spark.createDataFrame(rows, "cluster int, doc_id bigint, term string, tf bigint")
    summed = [tuple(r) for r in ops.top_terms(terms, 2).orderBy("cluster", "rank").collect()]
    assert summed == [(0, 1, "x", 5), (0, 2, "y", 4), (1, 1, "a", 1), (1, 2, "b", 1)]
    literal = [r.term for r in ops.top_terms(terms, 3, "literal").where("cluster = 0").orderBy("rank").collect()]
    assert literal == ["y", "x", "x"]


@pytest.mark.parametrize("cluster", [ops.kmeans, ops.bisecting_kmeans])
def test_report(spark, tmp_path, cluster):
    texts = ["apple pear apple", "apple pear", "dog cat", "cat dog dog", "", "sun"]
    docs = text.tfidf(documents(spark, texts), 1 << 10)
    assigned, _ = cluster(ops.sparse_features(docs), 3)
    assigned = docs.select("doc_id", "words").join(assigned.select("doc_id", "cluster", "d2"), "doc_id").cache()
    report = ops.cluster_report(assigned, ops.words_by_cluster(assigned), "K-Means")
    write_cluster_report(report, str(tmp_path / "out"))
    line = next((tmp_path / "out").glob("part-*.json")).read_text()
    found = json.loads(line)
    assert sum(c["size"] for c in found["clusters"]) == len(texts)
    assert sum(c["error"] for c in found["clusters"]) == pytest.approx(found["wsse"])
    words = Counter(t for c in found["clusters"] for t in c["terms"])
    assert set(words) == {"apple", "pear", "dog", "cat", "sun"}
    joined = ops.cluster_terms(assigned, text.term_counts(docs))
    again = ops.cluster_report(assigned, joined, "K-Means").first()
    assert [c.terms for c in again.clusters] == [c["terms"] for c in found["clusters"]]
    totals = {r.cluster: (r["size"], r.sse) for r in ops.cluster_sse(assigned).collect()}
    assert totals[-1] == (len(texts), pytest.approx(found["wsse"]))
