"""The byte network: pooling against a plain loop, held-out accuracy, defined results."""

import zlib

import numpy as np

from tidemark.llm import queries, quality_cnn

SF = "/root/testdata/sf0.01"


def _random_net(seed=1):
    rng = np.random.default_rng(seed)
    return quality_cnn.Network(
        rng.normal(size=(256, quality_cnn.DIMS)).astype(np.float32),
        rng.normal(size=(2, quality_cnn.WIDTH, quality_cnn.FILTERS)).astype(np.float32),
        rng.normal(size=quality_cnn.FILTERS).astype(np.float32),
        rng.normal(size=quality_cnn.FILTERS).astype(np.float32),
        0.1,
    )


def _plain(text, net):
    """Every chunk on its own, byte by byte."""
    block = quality_cnn.BLOCK
    n = max(1, -(-(len(text) - block) // block))
    data = np.zeros((n + 1) * block, dtype=int)
    data[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    best = np.zeros(quality_cnn.FILTERS)
    for k in range(n):
        total = net.offset.astype(float)
        for half in (0, 1):
            at = (k + half) * block
            equal = [
                sum(data[i] == data[i - lag] != 0 for i in range(at, at + block) if i >= lag) / block
                for lag in range(1, quality_cnn.LAGS + 1)
            ]
            total += np.concatenate([net.embedding[data[at : at + block]].ravel(), equal, [max(equal)]]) @ net.filters[half]
        best = np.maximum(best, total)
    return best


def test_pooling_covers_every_byte(monkeypatch):
    net = _random_net()
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 101, size=n, dtype=np.uint8)) for n in (0, 1, 8, 9, 16, 17, 24, 25, 300, 1000, 0)]
    want = np.stack([_plain(t, net) for t in texts])
    assert np.allclose(quality_cnn.pool(texts, net), want, atol=1e-3)
    monkeypatch.setattr(quality_cnn, "SLAB", 7)
    assert np.allclose(quality_cnn.pool(texts, net), want, atol=1e-3)


def test_gradients_match_differences():
    net = _random_net(3)
    net.weights *= 0.05
    texts, labels = [b"ab ab ab ab ab ab ab", b"something else here!"], np.array([0, 1], np.float32)
    gradients = quality_cnn._gradients(texts, labels, net)

    def loss():
        p = net.probability(quality_cnn.pool(texts, net).astype(float))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for part, gradient, at in ((net.weights, gradients[3], (2,)), (net.offset, gradients[2], (4,)), (net.filters, gradients[1], (1, 3, 5))):
        step = 1e-3
        part[at] += step
        up = loss()
        part[at] -= 2 * step
        down = loss()
        part[at] += step
        assert abs((up - down) / (2 * step) - gradient[at]) < 2e-3


def test_held_out_accuracy(spark):
    got = queries.op4_byte_cnn(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def _write(spark, path, rows, labels):
    schema = "doc_id long, text string, quality int, label string, score int"
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_hard_rows(spark, tmp_path):
    rows = [(i, ("good prose here " if i % 2 else "bad## bad## ") * 5) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 300_000), (3, rows[3][1]), (None, "good prose here")]
    labels = [(i, i % 2, None, "t") for i in range(60)] + [(3, 1, 0, "t"), (None, 1, 1, "t"), (70, None, 1, "t")]
    got = queries.op4_byte_cnn(spark, _write(spark, tmp_path / "a", rows, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert abs(score[100] - score[101]) < 1e-5 and score[1] > 0.5 > score[2]
    one = queries.op4_byte_cnn(spark, _write(spark, tmp_path / "b", rows[:4], [(1, 1, 0, "t")])).collect()
    assert {r.score for r in one} == {1.0}
    none = queries.op4_byte_cnn(spark, _write(spark, tmp_path / "c", [], [])).count()
    assert none == 0
