"""Latent retrieval: verbatim and reworded items are found, clean documents aren't."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import latent_decontam, queries

SF = "/root/testdata/sf0.01"


def test_verbatim_items_of_the_tables(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op10_latent_retrieval(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text and i.text in (d.text or "")}
    assert want and want <= got
    # What more is found holds the item's words in order.
    text = {d.doc_id: d.text for d in docs}
    item = {i.item_id: i.text for i in items}
    for d, i in got - want:
        a, b = (latent_decontam.words_of(pa.array([t], pa.large_string()))[0].tolist() for t in (item[i], text[d]))
        assert latent_decontam.common_subsequence(a, b) >= 0.5 * len(a)


def _write(spark, path, docs, items):
    spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, id int").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return str(path)


def test_copies_paraphrases_and_clean_rows(spark, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bcdfgl" for b in ("an", "or", "ei") for c in ("ta", "lin", "mor", "sey", "dun")]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(200)) for _ in range(n))
    items = [(i, prose(rng.randint(15, 50))) for i in range(30)] + [(40, prose(400)), (41, None), (42, "")]
    docs, want = [], set()
    for i, text in items[:31]:
        own = text.split()
        docs.append((100 + i, f"{prose(200)} {text} {prose(100)}"))
        docs.append((200 + i, f"{prose(90)}, {text.upper().replace(' ', '! ')}"))
        kept = [w if k % 6 else rng.choice(words) for k, w in enumerate(own)]
        docs.append((300 + i, f"{prose(37)} {' '.join(kept)} {prose(64)}"))
        want |= {(k + i, i) for k in (100, 200, 300)}
        docs.append((400 + i, prose(300)))
    docs += [(500, None), (501, ""), (502, "!!! ..."), (503, prose(30_000) + " " + items[3][1]), (100, docs[0][1]), (None, docs[0][1])]
    want |= {(503, 3), (None, 0)}
    got = queries.op10_latent_retrieval(spark, _write(spark, tmp_path, docs, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert sum(r.doc_id == 100 for r in got) == 2


def test_empty_tables(spark, tmp_path):
    docs = [(1, "some words of a text")]
    assert queries.op10_latent_retrieval(spark, _write(spark, tmp_path / "a", docs, [])).count() == 0
    assert queries.op10_latent_retrieval(spark, _write(spark, tmp_path / "b", [], [(1, "a b c d")])).count() == 0


def test_space_matches_a_direct_decomposition(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 60, size=20).tolist()) for i in range(40)]
    idf = rng.uniform(0.5, 3, size=latent_decontam.FEATURES).astype(np.float32)
    passages = spark.createDataFrame(rows, "item long, words array<long>")
    features, basis = latent_decontam.latent_space(passages, idf, rank=10)
    matrix = np.zeros((40, len(features)))
    for i, words in rows:
        f, x = latent_decontam._weighted(words, idf)
        matrix[i, np.searchsorted(features, f)] = x
    _, s, _ = np.linalg.svd(matrix, full_matrices=False)
    held = np.linalg.svd(matrix @ basis, compute_uv=False)
    assert np.allclose(basis.T @ basis, np.eye(10), atol=1e-8)
    assert (held >= 0.97 * s[:10]).all()


def test_common_subsequence_against_the_table():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            row = _next(row, x, b)
        assert latent_decontam.common_subsequence(a, b) == row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


def _prose(rng, n, kinds=4000):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), kinds)}x{rng.randrange(4)}" for _ in range(n))


def test_exact_copies_of_thousands_of_items(spark, tmp_path):
    rng = random.Random(4)
    items = [(i, _prose(rng, 30)) for i in range(2100)]
    docs = [(i, f"{_prose(rng, rng.randrange(40))} {text} {_prose(rng, rng.randrange(40))}") for i, text in items[::6]]
    got = queries.op10_latent_retrieval(spark, _write(spark, tmp_path, docs, items)).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    want = {(d, i) for d, text in docs for i, own in items if f" {own} " in f" {text} "}
    assert len(want) >= 350 and want <= found


def test_blocks_of_a_large_benchmark(spark, monkeypatch):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    monkeypatch.setattr(latent_decontam, "RANK", 20)
    monkeypatch.setattr(latent_decontam, "PARTS", 2)
    items = [(i, prose(25)) for i in range(50)] + [(200, prose(1000))]
    docs = [(i, f"{prose(50)} {text}") for i, text in items] + [(300, prose(100))]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    indexes = list(latent_decontam.build_index(docs, items))
    assert len(indexes) > 1 and all(len(x.items) <= 20 for block in indexes for x in block)
    got = sorted((r.id, r.item_id) for r in latent_decontam.find_leaks(docs, items).collect())
    assert got == [(i, i) for i in (*range(50), 200)]
    assert [r.doc_id for r in latent_decontam.drop_leaks(docs, items).collect()] == [300]


def test_partial_copies_of_a_long_item(spark, tmp_path):
    rng = random.Random(8)
    item = _prose(rng, 400).split()
    docs = [(a, f"{_prose(rng, 70)} {' '.join(item[a : a + 100])} {_prose(rng, 70)}") for a in range(0, 301, 25)]
    docs += [(1000, _prose(rng, 400))]
    got = queries.op10_latent_retrieval(spark, _write(spark, tmp_path, docs, [(7, " ".join(item))])).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(a, 7) for a in range(0, 301, 25)]
    assert all(r.lcs == 1 for r in got)


def test_short_items_among_rarer_words_and_loose_copies_of_long_ones(spark, tmp_path):
    rng = random.Random(10)
    rare = lambda n: " ".join(f"r{rng.randrange(10**9)}" for _ in range(n))
    word = lambda: f"k{rng.randrange(300)}"
    items = [(n, " ".join(word() for _ in range(n))) for n in (4, 5, 6, 7, 8, 10, 12, 14)]
    docs, want = [], set()
    for n, text in items:
        for before in range(32, 48):
            docs.append((100 * n + before, f"{rare(before)} {text} {rare(50)}"))
            want.add((100 * n + before, n))
    for n in (55, 60, 64):
        own = [word() for _ in range(n)]
        # The answer is whole, of the other words every second one is another.
        items.append((n, f"{' '.join(own[:-5])}? {' '.join(own[-5:])}"))
        kept = [w if k % 2 == 0 or k >= n - 5 else rare(1) for k, w in enumerate(own)]
        for before in range(32, 48):
            docs.append((100 * n + before, f"{rare(before)} {' '.join(kept)} {rare(50)}"))
            want.add((100 * n + before, n))
    docs += [(10_000 + i, " ".join(word() for _ in range(60))) for i in range(300)]
    got = {(r.doc_id, r.item_id) for r in queries.op10_latent_retrieval(spark, _write(spark, tmp_path, docs, items)).collect()}
    assert want <= got
