import math
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tidemark.operators import rater_pairs
from tidemark.operators import recommend as ops
from tidemark.plans import recommend as plans
from tidemark.sources import adapters

SCHEMA = "user string, item string, rating double"


def clamp(x):
    return max(0.0, min(5.0, x))


def brute_pairs(ratings):
    """{(u, v): [(r_u, r_v), ...]} over all ordered pairs."""
    by_item = defaultdict(dict)
    for (u, i), r in ratings.items():
        by_item[i][u] = r
    pairs = defaultdict(list)
    for raters in by_item.values():
        for u in raters:
            for v in raters:
                if u != v:
                    pairs[u, v].append((raters[u], raters[v]))
    return pairs, by_item


def pearson(common):
    n = len(common)
    mu, mv = sum(a for a, _ in common) / n, sum(b for _, b in common) / n
    su, sv = sum((a - mu) ** 2 for a, _ in common), sum((b - mv) ** 2 for _, b in common)
    if su < 1e-9 or sv < 1e-9:
        return 0.0
    return sum((a - mu) * (b - mv) for a, b in common) / math.sqrt(su * sv)


def brute_cf(train, test, mode):
    known = {k: r for k, r in train.items() if k not in test}
    ratings = train if mode == "literal" else known
    pairs, by_item = brute_pairs(ratings)
    mine = defaultdict(list)
    for (u, _), r in known.items():
        mine[u].append(r)
    means = {u: sum(rs) / len(rs) for u, rs in mine.items()}
    default = sum(known.values()) / len(known)
    out = {}
    for u, i in test:
        num = den = 0.0
        met = False
        for v, r in by_item.get(i, {}).items():
            common = pairs.get((u, v))
            if v == u or not common:
                continue
            met = True
            w = pearson(common) if mode == "pearson" else float(len(common) >= 2)
            mean_v = clamp(sum(b for _, b in common) / len(common))
            num, den = num + w * (r - mean_v), den + abs(w)
        if mode == "literal":
            if met:
                out[u, i] = clamp(num / den if den > 1e-9 else 0.0)
            elif u in means:
                out[u, i] = clamp(means[u])
        elif den > 1e-9 and u in means:
            out[u, i] = clamp(means[u] + num / den)
        else:
            out[u, i] = clamp(means.get(u, default))
    return out


def fixture(seed, users=30, items=25, density=0.25):
    """Ratings with two items that nearly everybody rated, and cold users and items in the test."""
    rng = random.Random(seed)
    train = {}
    for u in range(users):
        for i in range(items):
            if rng.random() < (0.9 if i < 2 else density):
                train[f"u{u}", f"i{i}"] = float(rng.randint(1, 5))
    test = dict(rng.sample(sorted(train.items()), 40))
    return train, test


def frame(spark, ratings):
    return spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], SCHEMA)


@pytest.mark.parametrize("mode", ["pearson", "literal"])
@pytest.mark.parametrize("heavy", [10_000, 12, 3])
@pytest.mark.parametrize("inside", [True, False])
def test_user_cf_against_brute_force(spark, mode, heavy, inside):
    """With and without heavy items; test pairs inside the training file and outside of it."""
    train, test = fixture(heavy + inside)
    if not inside:
        train = {k: r for k, r in train.items() if k not in test}
        test = {**test, ("cold", "i0"): 3.0, ("u1", "none"): 2.0, ("cold", "none"): 4.0}
    found = ops.user_cf(frame(spark, train), frame(spark, test), mode, heavy).collect()
    got = {(r.user, r.item): r.prediction for r in found}
    expected = brute_cf(train, test, mode)
    assert len(found) == len(got) and got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-9), key


@pytest.mark.parametrize("heavy", [None, 12, 1])
def test_pair_stats_with_heavy_items(spark, heavy):
    train, _ = fixture(7)
    ratings = frame(spark, train)
    items = None if heavy is None else ops.heavy_items(ratings, heavy)
    found = {(r.u, r.v): (r.n, r.sum_u, r.sum_v, r.sum_uv) for r in ops.pair_stats(ratings, heavy=items).collect()}
    pairs, _ = brute_pairs(train)
    expected = {
        (u, v): (len(c), sum(a for a, _ in c), sum(b for _, b in c), sum(a * b for a, b in c))
        for (u, v), c in pairs.items()
        if u < v and len(c) >= 2
    }
    assert found == expected


@pytest.mark.parametrize("least", [1, 2])
@pytest.mark.parametrize("mode", ["pearson", "literal"])
def test_two_items_that_all_users_share(spark, mode, least):
    """Every pair of users has to be listed; cells of two blocks keep it off one task."""
    rng = random.Random(5)
    train = {(f"u{u:03}", i): float(rng.randint(1, 5)) for u in range(150) for i in ("hot1", "hot2", f"own{u % 40}")}
    ratings = frame(spark, train)
    heavy = ops.heavy_items(ratings, 20)
    assert {r.item for r in heavy.collect()} == {"hot1", "hot2"}
    cells = ops.rater_cells(ratings, heavy, 20)
    sizes = cells.groupBy("item", "low", "high").count().collect()
    assert max(r["count"] for r in sizes) <= 4 * 20
    pairs, _ = brute_pairs(train)
    found = {(r.u, r.v): (r.n, r.sum_uv) for r in ops.pair_stats(ratings, heavy=heavy, block=20, least=least).collect()}
    assert found == {(u, v): (len(c), sum(a * b for a, b in c)) for (u, v), c in pairs.items() if u < v and len(c) >= least}
    test = {("u001", "hot1"): 3.0, ("u002", "own7"): 1.0, ("u003", "hot2"): 2.0}
    got = {(r.user, r.item): r.prediction for r in ops.user_cf(ratings, frame(spark, test), mode, 20).collect()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in brute_cf(train, test, mode).items()}


@pytest.mark.parametrize("heavy", [None, 12])
def test_tasks_grow_with_the_pairs(spark, monkeypatch, heavy):
    """No task lists or sums up more than its share of the pairs, and a pair leaves its cell only as a result."""
    monkeypatch.setattr(ops, "TASK_PAIRS", 50)
    train, _ = fixture(17)
    ratings = frame(spark, train)
    pairs, _ = brute_pairs(train)
    listed = sum(len(c) for (u, v), c in pairs.items() if u < v)
    assert ops.pair_tasks(ratings) == -(-listed // 50) > 8
    stats = ops.pair_stats(ratings, heavy=heavy and ops.heavy_items(ratings, heavy), block=12)
    assert stats.rdd.getNumPartitions() >= ops.pair_tasks(ratings)
    found = {(r.u, r.v): (r.n, r.sum_u, r.sum_v2, r.mean_v) for r in stats.collect()}
    assert found == {
        (u, v): (len(c), sum(a for a, _ in c), sum(b * b for _, b in c), pytest.approx(sum(b for _, b in c) / len(c)))
        for (u, v), c in pairs.items()
        if u < v and len(c) >= 2
    }
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    top = plan[: plan.index("RepartitionByExpression")]
    assert "Join" not in top


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("names", [False, True])
@pytest.mark.parametrize("grid", [False, True])
def test_pairs_travel_packed(monkeypatch, grid, names, small):
    """A listed pair takes a few bytes, not a row; slices, parts and packets of any size give the same sums."""
    if small:
        for limit, size in (("SLICE", 40), ("PAIRS", 1000), ("PART", 5000)):
            monkeypatch.setattr(rater_pairs, limit, size)
    rng = random.Random(4)
    user = (lambda u: f"u{u:05}") if names else (lambda u: 7 * u)
    rows = sorted((f"i{i}", user(u), rng.choice([1.0, 2.5, None])) for i in range(60) for u in rng.sample(range(400), 40))
    rows += [("i9z", user(3), 1.0), ("i9z", user(3), 2.0), ("i9z", user(5), 4.0)]
    rows.sort(key=lambda r: r[:2])
    columns = dict(zip(("item", "user", "rating"), map(pa.array, zip(*rows)), strict=True))
    columns["block"] = pa.array([hash(u) % 3 for _, u, _ in rows], pa.int32())
    table = pa.table(columns)
    listing = rater_pairs.Listing(3, grid)
    packets = pa.Table.from_batches([b for b in rater_pairs.listed(listing)(table.to_batches(max_chunksize=100)) if len(b)])
    by_item = defaultdict(list)
    for item, u, r in rows:
        by_item[item].append((u, r))
    want = defaultdict(list)
    for raters in by_item.values():
        for u, a in raters:
            for v, b in raters:
                if u < v:
                    want[u, v].append((a, b))
    assert sum(packets["entries"].to_pylist()) == sum(map(len, want.values()))
    if not small and not names:
        assert sum(map(len, packets["data"].to_pylist())) < (6 if grid else 3) * sum(map(len, want.values()))
    kinds = [("n", pa.int64()), *((c, pa.float64()) for c in ops.PAIR_SUMS[1:])]
    schema = pa.schema([("u", table["user"].type), ("v", table["user"].type), *kinds])
    packets = packets.sort_by([("a", "ascending"), ("b", "ascending")])
    assert (len(set(packets["b"].to_pylist())) > 1) == grid

    def total(values):
        known = [x for x in values if x is not None]
        return sum(known) if known else None

    for least in (1, 2):
        found = [r for b in rater_pairs.summed(schema, least)(packets.to_batches(max_chunksize=4)) for r in b.to_pylist()]
        expected = {
            k: (len(c), total(a for a, _ in c), total(b for _, b in c), total(a * b if None not in (a, b) else None for a, b in c))
            for k, c in want.items()
            if len(c) >= least
        }
        assert len(found) == len(expected)
        assert {(r["u"], r["v"]): (r["n"], r["sum_u"], r["sum_v"], r["sum_uv"]) for r in found} == expected


def test_a_pair_of_raters_meets_once_per_item(spark):
    train, _ = fixture(11)
    ratings = frame(spark, train)
    listed = ops.corated_pairs(ratings, heavy=ops.heavy_items(ratings, 5), block=5).select("u", "v", "item").collect()
    plain = ops.corated_pairs(ratings).select("u", "v", "item").collect()
    assert sorted(map(tuple, listed)) == sorted(map(tuple, plain))


@pytest.mark.parametrize("chunk", [4096, 3])
def test_neighbour_lookup_starts_from_the_weights(spark, monkeypatch, chunk):
    """A tested item that all users rated makes no more rows than there are weights and chunks."""
    monkeypatch.setattr(ops, "CHUNK", chunk)
    ratings = {(f"u{u}", i): float(u % 5 + 1) for u in range(200) for i in ("hot", *(f"i{u // 50}-{k}" for k in range(8)))}
    test = {(f"u{u}", i): 1.0 for u in range(0, 200, 2) for i in ("hot", f"i{u // 50}-0", "none")}
    weights = [(f"u{u}", f"u{v}", 0.5, 2.0) for u in range(0, 200, 20) for v in range(u, u + 6)]
    w = spark.createDataFrame(weights, "user string, v string, w double, mean_v double")
    tests, rated = frame(spark, test), frame(spark, ratings)
    found = ops.neighbour_ratings(tests, rated, w)
    want = sorted(
        (u, i, v, ratings[v, i]) for u, v, _, _ in weights for x, i in test if x == u and u != v and (v, i) in ratings
    )
    assert sorted(map(tuple, found.select("user", "item", "v", "r_v").collect())) == want
    wanted, lists = ops.candidate_neighbours(tests, rated, 1 if chunk > 10 else 3)
    met = w.join(wanted, "user").join(lists, ["v", "chunk"])
    assert met.count() <= len(weights) * (1 if chunk > 10 else 3)
    # Nothing joins tested items with raters.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and re.search(r"\(item#\d+ = item#\d+\)", line)]
    assert joins and all("LeftSemi" in line for line in joins)


def test_a_heavy_item_lists_no_pairs(spark):
    """One item rated by everybody: the self-join must not multiply its raters."""
    rows = [(f"u{i}", "hot", 3.0) for i in range(400)] + [(f"u{i}", f"own{i}", 4.0) for i in range(400)]
    rows += [("u0", "x", 5.0), ("u1", "x", 1.0)]
    ratings = spark.createDataFrame(rows, SCHEMA)
    heavy = ops.heavy_items(ratings, 100)
    tops = ratings.join(heavy, "item").select("user", "item")
    listed = ratings.join(tops, ["user", "item"], "left_anti")
    assert ops.corated_pairs(listed).count() == 1
    found = ops.pair_stats(ratings, heavy=heavy).collect()
    assert [(r.u, r.v, r.n, r.sum_u, r.sum_v) for r in found] == [("u0", "u1", 2, 8.0, 4.0)]


def test_weights(spark):
    rows = [("a", "1", 1.0), ("b", "1", 5.0), ("a", "2", 2.0), ("b", "2", 4.0), ("a", "3", 3.0), ("b", "3", 3.0)]
    rows += [("c", "1", 2.0), ("c", "2", 2.0), ("d", "1", 4.0)]
    stats = ops.pair_stats(spark.createDataFrame(rows, SCHEMA))
    true = {(r.u, r.v): r.w for r in ops.pearson_weight(stats).collect()}
    literal = {(r.u, r.v): r.w for r in ops.pearson_weight(stats, "literal").collect()}
    assert true == {("a", "b"): pytest.approx(-1.0), ("a", "c"): 0.0, ("b", "c"): 0.0}
    assert literal == {("a", "b"): 1.0, ("a", "c"): 1.0, ("b", "c"): 1.0}


def test_fallback_and_set_helpers(spark):
    train = spark.createDataFrame([("a", "x", 2.0), ("a", "x", 4.0), ("a", "y", 5.0), ("b", "x", 1.0)], SCHEMA)
    clean = ops.dedupe_ratings(train)
    assert sorted(tuple(r) for r in clean.collect()) == [("a", "x", 4.0), ("a", "y", 5.0), ("b", "x", 1.0)]
    pairs = spark.createDataFrame([("a", "z"), ("new", "z")], "user string, item string")
    means = ops.user_mean(clean)
    filled = {r.user: r.prediction for r in ops.fallback(pairs, means, ops.global_mean(clean)).collect()}
    assert filled == {"a": 4.5, "new": pytest.approx(10 / 3)}
    assert [r.user for r in ops.fallback(pairs, means).collect()] == ["a"]
    hot = {r.user: r.prediction for r in ops.fallback(pairs, means, ops.global_mean(clean), hot=["a"]).collect()}
    assert hot == filled
    assert ops.subtract_pairs(clean, pairs.unionByName(clean.select("user", "item"))).count() == 0
    assert {r.item: r.mean for r in ops.item_mean(clean).collect()} == {"x": 2.5, "y": 5.0}


def test_partners_of_a_user_have_smaller_and_larger_ids(spark, tmp_path):
    """A pair of raters is a link of both, and the user with the largest id has its row."""
    rng = random.Random(2)
    lines = [(i % 40, rng.randrange(1, 12), float(rng.randrange(1, 50))) for i in range(160)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(40).selectExpr("id AS o_orderkey", "id % 13 + 1 AS o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    known, _ = plans._known(spark, str(tmp_path))
    pairs, _ = brute_pairs({(r.user, r.item): r.rating for r in known.collect()})
    want = defaultdict(lambda: (0, 0, 0.0, 0.0))
    for (u, _), c in pairs.items():
        partners, n, uv, v2 = want[u]
        want[u] = (partners + 1, n + len(c), uv + sum(a * b for a, b in c), v2 + sum(b * b for _, b in c))
    found = plans.corated_partners(spark, str(tmp_path)).collect()
    assert len(found) == len(want) and {r.u: (r.partners, r.n, r.sum_uv, r.sum_v2) for r in found} == want


def test_als_covers_every_pair(spark):
    train, test = fixture(3)
    test = {**test, ("cold", "i0"): 3.0, ("u1", "none"): 2.0}
    found = ops.recommend_with_fallback(frame(spark, train), frame(spark, test), iters=5).collect()
    assert len(found) == len(test) == len({(r.user, r.item) for r in found})
    assert all(0 <= r.prediction <= 5 for r in found)
    source = {(r.user, r.item): r.source for r in found}
    assert source["cold", "i0"] == source["u1", "none"] == "mean"
    assert "model" in source.values()


def test_als_checks_look_at_the_error(spark, monkeypatch):
    """Predictions far from the ratings must show."""
    train, test = (frame(spark, r) for r in fixture(3))
    monkeypatch.setattr(plans.adapters, "train_test", lambda spark, sf_dir: (train, test))
    right = test.withColumn("prediction", F.col("rating") / 2).drop("rating")
    for found, below in ((right, True), (right.withColumn("prediction", F.lit(50.0)), False)):
        monkeypatch.setattr(ops, "recommend_with_fallback", lambda train, test: found)
        row = plans.als_checks(spark, "").first()
        assert (row.pairs, row.repeated, row.rated, row.rmse_below_2) == (40, 0, 40, below)


def test_residuals_show_a_wrong_fit(spark):
    train, _ = fixture(3)
    ratings = frame(spark, train)
    residuals = ops.als_residuals(ratings, iters=3).collect()
    assert len(residuals) == len({u for u, _ in train}) and all(r.residual < 1e-4 for r in residuals)
    assert sum(r.n for r in residuals) == len(train)
    model, encoded, _ = ops._als(ratings, ratings.limit(0), 2, 3, 0.25, 42, None)
    shifted = model.userFactors.withColumn("features", F.transform("features", lambda x: x * 1.05))
    wrong = ops.normal_residuals(shifted, model.itemFactors, encoded, 2, 0.25).collect()
    assert all(r.residual > 1e-3 for r in wrong)
    other = ops.normal_residuals(model.userFactors, model.itemFactors, encoded, 2, 0.5).collect()
    assert sum(r.residual > 1e-3 for r in other) > len(other) / 2


def test_evaluation(spark):
    train, test = fixture(5)
    predictions = ops.user_cf(frame(spark, train), frame(spark, test))
    evaluated = ops.join_actual(frame(spark, test), predictions).cache()
    histogram = {r.bucket: r.n for r in ops.error_histogram(evaluated).collect()}
    assert sorted(histogram) == [0, 1, 2, 3, 4] and sum(histogram.values()) == len(test)
    ml = RegressionEvaluator(labelCol="rating", predictionCol="prediction").evaluate(evaluated)
    assert ops.rmse(evaluated).first().rmse == pytest.approx(ml)
    row = ops.evaluation(evaluated).first()
    assert [row[f"b{b}"] for b in range(5)] == [histogram[b] for b in range(5)]


def test_ids_are_dense(spark):
    df = spark.createDataFrame([(x,) for x in "banana"], "letter string")
    ids = ops.id_encode(df, "letter", "id").orderBy("letter").collect()
    assert [(r.letter, r.id) for r in ids] == [("a", 0), ("b", 1), ("n", 2)]


@pytest.mark.parametrize("heavy", [10_000, 10, 1])
def test_neighbours_of_open_pairs(spark, heavy):
    train, test = fixture(13, density=0.05)
    train = {k: r for k, r in train.items() if k not in test}
    test = {**test, **{(f"u{u}", f"i{i}"): 1.0 for u in range(30) for i in range(2, 25)}}
    pairs, by_item = brute_pairs(train)
    expected = {(u, i) for u, i in test if any(v != u and (u, v) in pairs for v in by_item.get(i, {}))}
    found = ops.has_neighbour(frame(spark, test), frame(spark, train), heavy).collect()
    assert len(found) == len(expected) and {(r.user, r.item) for r in found} == expected


def test_tasks_of_ratings_grow_with_the_lines(spark, tmp_path, monkeypatch):
    """And what follows by user and item keeps them; each pair has its highest rating."""
    lines = [(i % 40, i % 7, float(i % 9)) for i in range(200)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.range(40).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    want = {}
    for order, item, quantity in lines:
        want[order % 5, item] = max(want.get((order % 5, item), 0), quantity % 5 + 1)
    monkeypatch.setattr(adapters, "TASK_RATINGS", 10)
    found = adapters.ratings(spark, str(tmp_path)).drop("is_test")
    assert {(r.user, r.item): r.rating for r in found.collect()} == want
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        known = ops.subtract_pairs(ops.dedupe_ratings(found), found.where("item = 1"))
        assert found.rdd.getNumPartitions() == known.rdd.getNumPartitions() == 20
        assert known.count() == len([1 for _, item in want if item != 1])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
