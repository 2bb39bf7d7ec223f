"""The Jaccard join against all pairs, and the guarantee of its signatures."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import partenum, queries


def _sets(texts):
    out = []
    for text in texts:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        grams = [b" ".join(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [b" ".join(words)]
        out.append(set(grams) if words else set())
    return out


def _components(ids, sets):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        least[find(a)] = min(least.get(find(a), i), i)
    return [least[find(a)] for a in range(len(ids))]


def _texts(rng):
    words = [f"w{i}" for i in range(400)]
    common = " ".join(rng.choice(words) for _ in range(30))
    texts = [None, "", " \t\n", "one two", "ONE\x0btwo", "one  two", "a b c d", "A B C D E", "a b c d e", "é É x y z", "É É x y z"]
    for n in (6, 12, 30, 60, 61, 150, 400):
        base = [rng.choice(words) for _ in range(n)]
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 2, 3, 4, 6, 9):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = rng.choice(words)
            texts.append(" ".join(copy) + rng.choice(["", " tail", " more of it here"]))
    # A chain: neighbours are similar, its ends aren't.
    chain = [rng.choice(words) for _ in range(200)]
    for i in range(12):
        texts.append(" ".join(chain))
        chain[10 + 15 * i] = "changed"
    texts += [common + " " + " ".join(rng.choice(words) for _ in range(20)) for _ in range(25)]
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    return texts


def test_query_against_all_pairs(spark, tmp_path):
    rng = random.Random(11)
    texts = _texts(rng)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)]
    repeated = [(ids[20], texts[20], 1, "x"), (None, texts[20], 1, "x"), (None, None, None, None)]
    path = str(tmp_path)
    spark.createDataFrame(rows + repeated, "doc_id long, text string, n int, component string").write.parquet(
        f"{path}/documents.parquet"
    )
    got = queries.op3_partenum(spark, path).collect()
    assert len(got) == len(rows) + 3
    sets = _sets(texts)
    want = {i: (len(s), c) for i, s, c in zip(ids, sets, _components(ids, sets), strict=True)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(0, None), (len(sets[20]), None)]


def test_tables_without_links(spark, tmp_path):
    for name, rows in (("a", []), ("b", [(1, None), (2, "")]), ("c", [(1, "a b c d e f"), (2, "u v w x y z")])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = queries.op3_partenum(spark, f"{tmp_path}/{name}").collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i, _ in rows]


def _shared(x, y, edges):
    """In some band the sets share more signatures than each may leave out."""
    a, b = (next(i for i, (_, high) in enumerate(edges) if len(s) <= high) for s in (x, y))
    both = np.intersect1d(partenum.signatures(x, edges), partenum.signatures(y, edges))
    for band in {a, a + 1} & {b, b + 1}:
        own = both[(both >> np.uint64(32)) % np.uint64(2) == band % 2]
        if len(own) > partenum.extra(edges[band][1], 80):
            return True
    return False


def test_similar_sets_share_signatures():
    """Removing and adding as many features as the threshold allows leaves enough shared signatures."""
    rng = np.random.default_rng(4)
    edges = partenum.bands(4000)
    for _ in range(3000):
        n = int(rng.integers(1, 300))
        features = rng.integers(0, 2**64, size=n, dtype=np.uint64)
        kept = int(rng.integers(max(1, -(-4 * n // 5)), n + 1))
        most = max(0, int(kept / 0.8) - n)
        extra = rng.integers(0, 2**64, size=int(rng.integers(0, most + 1)), dtype=np.uint64)
        x, y = np.unique(features), np.unique(np.concatenate([features[:kept], extra]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            assert _shared(x, y, edges), (n, kept)


def test_adversarial_differences_share_a_signature():
    """Differences placed to hit as many of the kept partitions as they can still miss one."""
    rng = np.random.default_rng(8)
    edges = partenum.bands(2000)
    for n in (9, 50, 200, 500):
        features = np.unique(rng.integers(0, 2**64, size=n, dtype=np.uint64))
        spread = np.sort(features)
        for removed in range(0, n // 5 + 1, max(1, n // 40)):
            # One removal at a time, evenly over the range, touches the most partitions.
            gone = np.linspace(0, n - 1, removed).astype(int)
            y = np.delete(spread, gone)
            if 100 * len(y) >= 80 * n:
                assert _shared(spread, y, edges)


@pytest.mark.parametrize("block, most", [(partenum.BLOCK, 3), (30_000, 12)])
def test_a_group_just_below_the_threshold_is_sent_once(spark, monkeypatch, block, most):
    """800 texts that share signatures with each other and hardly link; in one block, and in several."""
    monkeypatch.setattr(partenum, "BLOCK", block)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(800):
        words = list(base)
        for at in rng.sample(range(150), 4):
            words[at] = f"x{i}-{at}"
        texts.append(" ".join(words))
    filled = []
    plain = partenum._cells
    monkeypatch.setattr(partenum, "_cells", lambda *a: filled.append(plain(*a)) or filled[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component for r in partenum.join_sets(docs).collect()}
    assert got == dict(enumerate(_components(list(range(800)), _sets(texts))))
    rows = filled[0].count()
    assert rows <= most * 800
    cells = filled[0].groupBy("cell").count().collect()
    assert max(r["count"] for r in cells) * 150 <= 3 * block


def test_a_large_pack_is_not_sent_to_each_of_many_small_ones(spark, monkeypatch):
    """400 sets of one family, which shares a signature of its own with each of 300 families of two sets."""
    monkeypatch.setattr(partenum, "BLOCK", 30_000)
    hub, small = list(range(400)), [(1000 + 2 * i, 1001 + 2 * i) for i in range(300)]
    sigs = [(i, key) for i, pair in enumerate(small) for key in (*pair, hub[i], hub[i + 100])]
    frames = {
        "open_sigs": spark.createDataFrame([(s, k, k) for s, k in sigs], "sig long, key long, component long"),
        "nearest": spark.createDataFrame([(k, hub[0]) for k in hub] + [(b, a) for a, b in small], "key long, rep long"),
        "classes": spark.createDataFrame([(k, 100) for k in [*hub, *sum(small, ())]], "key long, n long"),
    }
    filled = partenum._cells(**frames).collect()
    assert len(filled) <= 8 * 1000
    cells, keys = {}, {}
    for r in filled:
        cells.setdefault(r.key, set()).add(r.cell)
        keys[r.cell] = keys.get(r.cell, 0) + 100
    # Blocks are dealt by hash, so one may hold somewhat more than its share.
    assert max(keys.values()) <= 3 * 30_000
    for i, (a, b) in enumerate(small):
        for x in (a, b, hub[i], hub[i + 100]):
            assert cells[x] & cells[a] and cells[x] & cells[hub[i]]


@pytest.mark.parametrize("bits", [1 << 25, 64])
def test_the_filter_lets_every_wanted_id_through(spark, monkeypatch, bits):
    monkeypatch.setattr(partenum, "FILTER_BITS", bits)
    rows = spark.range(2000).withColumnRenamed("id", "x").selectExpr("if(x = 7, null, x) as id", "'t' as text")
    wanted = spark.range(0, 2000, 20).selectExpr("id", "id as key")
    kept = [r.id for r in partenum._maybe_wanted(rows, wanted).collect()]
    assert set(range(0, 2000, 20)) <= set(kept) and None not in kept
    assert len(kept) < (400 if bits > 64 else 2001)


def test_keep_one_with_a_map_column(spark):
    rows = [(1, "a b c d e f", {"k": 2}), (1, "a b c d e f", {"k": 1}), (2, "a b c d e f", None), (None, "a b c d e f", {"z": 0})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string,int>")
    kept = sorted(((r.doc_id, r.more) for r in partenum.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, {"k": 1}), (None, {"z": 0})], key=str)
