import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import itemsets as ops
from tidemark.operators import prefix_tree
from tidemark.operators.relational import candidate_intersect, candidate_union, sort_itemsets
from tidemark.sources.sinks import format_itemsets


def frame(spark, baskets):
    rows = [(k, item) for k, items in baskets.items() for item in items]
    return spark.createDataFrame(rows, "key string, item string")


def brute(baskets, support):
    counts = {}
    for items in baskets.values():
        found = sorted(set(items))
        for size in range(1, len(found) + 1):
            for c in combinations(found, size):
                counts[c] = counts.get(c, 0) + 1
    return {c: n for c, n in counts.items() if n >= support}


def as_dict(df):
    rows = df.collect()
    found = {tuple(r["items"]): r.support for r in rows}
    assert len(found) == len(rows) and all(r["size"] == len(r["items"]) for r in rows)
    return found


def random_baskets(seed, n=80, items=9):
    """Baskets of a few items and some with all of them; duplicate rows included."""
    rng = random.Random(seed)
    names = [f"i{j}" for j in range(items)]
    baskets = {f"k{b}": rng.choices(names, k=rng.randint(1, 5)) for b in range(n)}
    for b in range(3):
        baskets[f"wide{b}"] = names * 2
    return baskets


@pytest.mark.parametrize("support,chunks,wide", [(4, 3, 1), (6, 8, 3), (3, 5, 64)])
def test_son_against_brute_force(spark, support, chunks, wide):
    """Small limits push the large baskets into the separate count."""
    baskets = random_baskets(support)
    found = as_dict(ops.son_frequent_itemsets(frame(spark, baskets), support, chunks, wide=wide))
    assert found == brute(baskets, support)


def test_one_basket_with_a_third_of_all_rows(spark):
    """Its pairs are never listed: 300 items would make 44850 of them."""
    names = [f"i{j:03d}" for j in range(300)]
    baskets = {"hot": names}
    baskets |= {f"k{j}": [names[j % 300], names[(j + 1) % 300]] for j in range(600)}
    rows = frame(spark, baskets)
    found = as_dict(ops.son_frequent_itemsets(rows, 3, 4, wide=8))
    pairs = {c: n for c, n in found.items() if len(c) == 2}
    assert len(pairs) == 300 and set(pairs.values()) == {3}
    assert all(len(c) < 3 for c in found)


def test_fpgrowth_and_son_agree(spark):
    rows = frame(spark, random_baskets(11))
    for support in (3, 30):
        expected = as_dict(ops.son_frequent_itemsets(rows, support, 4))
        assert as_dict(ops.fpgrowth_itemsets(rows, support)) == expected


def test_no_frequent_items(spark):
    rows = frame(spark, {"a": ["x", "y"], "b": ["y"]})
    assert as_dict(ops.son_frequent_itemsets(rows, 5)) == {}
    assert as_dict(ops.fpgrowth_itemsets(rows, 5)) == {}
    empty = spark.createDataFrame([], "key string, item string")
    assert as_dict(ops.son_frequent_itemsets(empty, 1)) == {}
    assert as_dict(ops.fpgrowth_itemsets(empty, 1)) == {}


@pytest.mark.parametrize("nodes, slab", [(1_000_000, 1 << 20), (8, 5)])
def test_support_of_mixed_candidates(spark, monkeypatch, nodes, slab):
    """In one tree and in several."""
    monkeypatch.setattr(ops, "MAX_NODES", nodes)
    monkeypatch.setattr(prefix_tree, "SLAB", slab)
    baskets = random_baskets(5)
    sets = [("i1",), ("i1", "i2"), ("i3", "i4", "i5"), ("i0", "i1", "i2", "i3"), ("i1", "absent")]
    candidates = spark.createDataFrame([(list(s),) for s in sets], "items array<string>")
    hits = ops.baskets_containing(frame(spark, baskets), candidates).collect()
    got = {(tuple(r["items"]), r.key) for r in hits}
    expected = {(s, k) for s in sets for k, items in baskets.items() if set(s) <= set(items)}
    assert got == expected and len(hits) == len(expected)
    exact = as_dict(ops.global_support(frame(spark, baskets), candidates, 4))
    counts = {s: sum(set(s) <= set(items) for items in baskets.values()) for s in sets}
    assert exact == {s: n for s, n in counts.items() if n >= 4}


@pytest.mark.parametrize("slab", [1, 7, 1 << 20])
def test_walk_against_brute_force(monkeypatch, slab):
    """Nodes with few and with many children, baskets of all sizes, an item in all of them."""
    monkeypatch.setattr(prefix_tree, "SLAB", slab)
    rng = random.Random(slab)
    sets = sorted({tuple(sorted(rng.sample(range(40), rng.randint(1, 5)))) for _ in range(400)} | {(0, i) for i in range(1, 40)})
    baskets = [sorted({0, *rng.sample(range(40), rng.randint(0, 30))}) for _ in range(60)] + [[], list(range(40))]
    flat = np.array([i for s in sets for i in s])
    tree = prefix_tree.build(flat, np.array([len(s) for s in sets]), np.arange(len(sets)), 40)
    offsets = np.cumsum([0, *map(len, baskets)])
    found = [(b, n) for bs, ns in prefix_tree.walk(tree, offsets, np.array(sum(baskets, []))) for b, n in zip(bs.tolist(), ns.tolist(), strict=True)]
    want = [(b, n) for b, items in enumerate(baskets) for n, s in enumerate(sets) if set(s) <= set(items)]
    assert sorted(found) == want
    empty = prefix_tree.build(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), 1)
    assert list(prefix_tree.walk(empty, np.array([0, 1]), np.array([0]))) == []


def test_one_item_in_all_baskets(spark):
    """Every candidate and every basket holds it; nothing is joined on it."""
    baskets = {f"k{j}": ["all", f"i{j % 50}", f"i{j % 7}"] for j in range(500)}
    sets = [("all",), *(("all", f"i{j}") for j in range(50)), ("all", "i1", "i8"), ("i3", "all"), ("all", "none")]
    candidates = spark.createDataFrame([(list(s),) for s in sets], "items array<string>")
    counts = {tuple(sorted(s)): sum(set(s) <= set(items) for items in baskets.values()) for s in sets}
    found = ops.candidate_counts(frame(spark, baskets), candidates)
    assert {tuple(r["items"]): r.n for r in found.collect()} == {s: n for s, n in counts.items() if n}
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("number#" in line and "item" not in line for line in joins)
    halves = ops.candidate_counts(frame(spark, baskets), candidates, F.substring("key", 2, 9).cast("int") % 2).collect()
    assert {r.part for r in halves} == {0, 1}
    assert sum(r.n for r in halves if r["items"] == ["all"]) == 500
    none = spark.createDataFrame([([],)], "items array<string>")
    assert ops.candidate_counts(frame(spark, baskets), none).count() == 0


def test_local_candidates_never_lose_a_frequent_set(spark):
    baskets = random_baskets(8)
    rows = frame(spark, baskets)
    frequent = brute(baskets, 6)
    items = {tuple(r["items"]) for r in ops.local_frequent_items(rows, 6, 4).collect()}
    assert {c for c in frequent if len(c) == 1} <= items
    pairs = spark.createDataFrame([(list(c),) for c in combinations([f"i{j}" for j in range(9)], 2)], "items array<string>")
    local = {tuple(r["items"]) for r in ops.local_frequent_sets(rows, pairs, 6, 4).collect()}
    assert {c for c in frequent if len(c) == 2} <= local


def test_candidates(spark):
    sets = [("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d"), ("a", "e")]
    frequent = spark.createDataFrame([(list(s),) for s in sets], "items array<string>")
    assert sorted(tuple(r["items"]) for r in ops.apriori_candidates(frequent).collect()) == [("a", "b", "c"), ("b", "c", "d")]
    with pytest.raises(ValueError):
        ops.apriori_candidates(spark.createDataFrame([(["a"],)], "items array<string>"))


def test_containment_in_a_large_basket(spark):
    large = [f"i{j}" for j in range(20_000)]
    rows = frame(spark, {"a": ["z", "x", "x"], "hot": large, "b": ["i0", "i1"], "c": ["i0", "z"]})
    found = {r.key: r["items"] for r in ops.build_baskets(rows).where("key <> 'hot'").collect()}
    assert found == {"a": ["x", "z"], "b": ["i0", "i1"], "c": ["i0", "z"]}
    assert {r.key for r in ops.baskets_with(rows, "i0", "i19999").collect()} == {"hot"}
    assert {r.key for r in ops.baskets_with(rows, "i0", "i0").collect()} == {"hot", "b", "c"}


def test_lines(spark):
    rows = [(["b"], 1), (["a"], 1), (["c"], 1), (["d", "a"], 2)]
    df = spark.createDataFrame(rows, "items array<string>, size int")
    found = [tuple(r) for r in format_itemsets(df).orderBy("size", "n").collect()]
    assert found == [(1, 1, "(a)"), (1, 2, "(b)"), (1, 3, "(c)"), (2, 1, "(a, d)")]
    assert [r["items"] for r in sort_itemsets(df).collect()] == [["a"], ["b"], ["c"], ["a", "d"]]


def test_set_operations(spark):
    a = spark.createDataFrame([(["x"],), (["x"],), (["y"],)], "items array<string>")
    b = spark.createDataFrame([(["y"],), (["z"],)], "items array<string>")
    assert candidate_union(a, b).count() == 3
    assert [r["items"] for r in candidate_intersect(a, b).collect()] == [["y"]]
