"""Registered queries over ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import recommend as ops
from tidemark.operators.relational import peek
from tidemark.plans.oracle_views import RATINGS
from tidemark.session import materialise, scratch_dir
from tidemark.sources import adapters
from tidemark.sources.readers import drop_header, read_ratings
from tidemark.sources.sinks import write_predictions

# Forces the handling of heavy items on tables that have none.
FEW_RATERS = 36


def _known(spark, sf_dir):
    """(training ratings without the test pairs, test ratings)"""
    every = adapters.ratings(spark, sf_dir)
    test = every.where("is_test").drop("is_test")
    return ops.subtract_pairs(every.drop("is_test"), test), test


def _rounded(predictions):
    return predictions.withColumn("prediction", F.round("prediction", 6))


def ratings_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "ratings")
    adapters.ratings(spark, sf_dir).select("user", "item", "rating").write.option("header", True).csv(path)
    return read_ratings(spark, path)


def ratings_lines(spark, sf_dir):
    """The lines of the rating file without its header line."""
    path = scratch_dir(spark, "lines")
    whole = F.col("rating").cast("bigint").alias("rating")
    adapters.ratings(spark, sf_dir).select("user", "item", whole).write.option("header", True).csv(path)
    return drop_header(spark.read.text(path))


def ratings_peek(spark, sf_dir):
    """The first ratings, to look at the input."""
    return peek(adapters.ratings(spark, sf_dir).select("user", "item", "rating").orderBy("user", "item"), 5)


def ratings_dedup(spark, sf_dir):
    lines = adapters.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        (F.col("l_quantity").cast("bigint") % 5 + 1).cast("double").alias("rating"),
    )
    return ops.dedupe_ratings(rows)


def train_minus_test(spark, sf_dir):
    return _known(spark, sf_dir)[0]


def user_mean(spark, sf_dir):
    return ops.user_mean(_known(spark, sf_dir)[0]).withColumn("mean", F.round("mean", 6))


def item_mean(spark, sf_dir):
    return ops.item_mean(_known(spark, sf_dir)[0]).withColumn("mean", F.round("mean", 6))


def _stats(spark, sf_dir, heavy_raters=ops.HEAVY_RATERS):
    known = materialise(_known(spark, sf_dir)[0], "known")
    return ops.pair_stats(known, heavy=ops.heavy_items(known, heavy_raters), block=heavy_raters)


def _pair_columns(stats):
    return stats.select(
        "u", "v", *ops.PAIR_SUMS, F.round("mean_u", 6).alias("mean_u"), F.round("mean_v", 6).alias("mean_v")
    )


def corated_pairs(spark, sf_dir):
    return _pair_columns(_stats(spark, sf_dir))


def corated_pairs_heavy(spark, sf_dir):
    """The same pairs with the most common items kept out of the listing."""
    return _pair_columns(_stats(spark, sf_dir, FEW_RATERS))


def corated_partners(spark, sf_dir):
    """Per user, the users who rated one of its items at least, and the sums over all these pairs."""
    known = materialise(_known(spark, sf_dir)[0], "known")
    stats = ops.pair_stats(known, heavy=ops.heavy_items(known, FEW_RATERS), block=FEW_RATERS, least=1, both=True)
    return stats.groupBy("u").agg(
        F.count("*").alias("partners"), F.sum("n").alias("n"), F.sum("sum_uv").alias("sum_uv"), F.sum("sum_v2").alias("sum_v2")
    )


def pearson_weight(spark, sf_dir):
    return ops.pearson_weight(_stats(spark, sf_dir)).select("u", "v", F.round("w", 6).alias("w"))


def user_cf_predict(spark, sf_dir):
    return _rounded(ops.user_cf(*adapters.train_test(spark, sf_dir)))


def user_cf_heavy(spark, sf_dir):
    """The same predictions through the handling of heavy items."""
    return _rounded(ops.user_cf(*adapters.train_test(spark, sf_dir), heavy_raters=FEW_RATERS))


def user_cf_literal(spark, sf_dir):
    return _rounded(ops.user_cf(*adapters.train_test(spark, sf_dir), mode="literal"))


def fallback_predict(spark, sf_dir):
    known, test = _known(spark, sf_dir)
    return _rounded(ops.fallback(test, ops.user_mean(known), ops.global_mean(known)))


def _mean_evaluation(spark, sf_dir):
    known, test = _known(spark, sf_dir)
    predictions = ops.fallback(test, ops.user_mean(known), ops.global_mean(known))
    return ops.join_actual(test, predictions)


def mean_error_histogram(spark, sf_dir):
    return ops.error_histogram(_mean_evaluation(spark, sf_dir))


def mean_rmse(spark, sf_dir):
    return ops.rmse(_mean_evaluation(spark, sf_dir)).withColumn("rmse", F.round("rmse", 6))


def _cf_evaluation(spark, sf_dir):
    train, test = adapters.train_test(spark, sf_dir)
    # Whole multiples of a millionth, so that both engines agree on the bucket edges.
    return ops.join_actual(test, _rounded(ops.user_cf(train, test)))


def cf_error_histogram(spark, sf_dir):
    return ops.error_histogram(_cf_evaluation(spark, sf_dir))


def cf_rmse(spark, sf_dir):
    return ops.rmse(_cf_evaluation(spark, sf_dir)).withColumn("rmse", F.round("rmse", 5))


def prediction_lines(spark, sf_dir):
    known, test = _known(spark, sf_dir)
    predictions = ops.fallback(test, ops.user_mean(known), ops.global_mean(known))
    whole = predictions.withColumn("prediction", F.round(F.col("prediction") * 1000).cast("bigint"))
    path = scratch_dir(spark, "predictions")
    write_predictions(whole, path)
    return spark.read.text(path)


def id_encode(spark, sf_dir):
    return ops.id_encode(adapters.ratings(spark, sf_dir), "user", "user_id")


def als_predict(spark, sf_dir):
    return ops.recommend_with_fallback(*adapters.train_test(spark, sf_dir))


def als_metrics(spark, sf_dir):
    train, test = adapters.train_test(spark, sf_dir)
    predictions = materialise(ops.recommend_with_fallback(train, test), "predictions")
    return ops.evaluation(ops.join_actual(test, predictions))


def als_checks(spark, sf_dir):
    """What holds for any factors: each test pair once and in range, and an error within its bounds."""
    train, test = adapters.train_test(spark, sf_dir)
    predictions = materialise(ops.recommend_with_fallback(train, test), "predictions")
    measured = ops.evaluation(ops.join_actual(test, predictions)).select("n", "rmse")
    checks = predictions.agg(
        F.count("*").alias("pairs"),
        (F.count("*") - F.countDistinct("user", "item")).alias("repeated"),
        F.count_if(~F.col("prediction").between(0, 5) | F.col("prediction").isNull()).alias("out_of_range"),
    )
    # One row each.
    return checks.withColumn("one", F.lit(1)).join(measured.withColumn("one", F.lit(1)), "one").select(
        "pairs", "repeated", "out_of_range", F.col("n").alias("rated"), F.col("rmse").between(0, 2).alias("rmse_below_2")
    )


def als_residuals(spark, sf_dir):
    """Users and ratings of the fit, and users whose factors don't solve their normal equations."""
    known = materialise(_known(spark, sf_dir)[0], "known")
    found = ops.als_residuals(known)
    return found.agg(
        F.count("*").alias("users"), F.sum("n").alias("ratings"),
        F.count_if(F.coalesce(F.col("residual") > 1e-3, F.lit(True))).alias("unsolved"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        ratings_csv_roundtrip, ratings_lines, ratings_peek, ratings_dedup, train_minus_test, user_mean, item_mean, corated_pairs,
        corated_pairs_heavy, corated_partners, pearson_weight, user_cf_predict, user_cf_heavy, user_cf_literal,
        fallback_predict, mean_error_histogram, mean_rmse, cf_error_histogram, cf_rmse,
        prediction_lines, id_encode, als_predict, als_metrics, als_checks, als_residuals,
    )
}

_STATS = f"""WITH {RATINGS},
stats AS (
  SELECT a."user" AS u, b."user" AS v, count(*) AS n, sum(a.rating) AS sum_u, sum(b.rating) AS sum_v,
         sum(a.rating * b.rating) AS sum_uv, sum(a.rating * a.rating) AS sum_u2,
         sum(b.rating * b.rating) AS sum_v2, avg(a.rating) AS mean_u, avg(b.rating) AS mean_v
  FROM train a JOIN train b ON a.item = b.item AND a."user" <> b."user"
  GROUP BY 1, 2 HAVING count(*) >= 2
)"""
_WEIGHTS = f"""{_STATS},
weights AS (
  SELECT u, v, mean_v,
         CASE WHEN n * sum_u2 - sum_u * sum_u > 0 AND n * sum_v2 - sum_v * sum_v > 0
              THEN (n * sum_uv - sum_u * sum_v)
                   / sqrt((n * sum_u2 - sum_u * sum_u) * (n * sum_v2 - sum_v * sum_v))
              ELSE 0.0 END AS w
  FROM stats
)"""
_CF = f"""{_WEIGHTS},
means AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY "user"),
scored AS (
  SELECT t."user", t.item, sum(w.w * (r.rating - w.mean_v)) AS num, sum(abs(w.w)) AS den
  FROM test t JOIN train r ON r.item = t.item AND r."user" <> t."user"
       JOIN weights w ON w.u = t."user" AND w.v = r."user"
  GROUP BY 1, 2
),
sources AS (
  SELECT t."user", t.item, t.rating, m.mean, s.num, s.den,
         CASE WHEN s.den > 0 AND m.mean IS NOT NULL THEN 'neighbours'
              WHEN m.mean IS NOT NULL THEN 'user mean' ELSE 'global mean' END AS source
  FROM test t LEFT JOIN scored s ON s."user" = t."user" AND s.item = t.item
       LEFT JOIN means m ON m."user" = t."user"
),
predicted AS (
  SELECT "user", item, rating, source,
         round(greatest(0.0, least(5.0, CASE WHEN source = 'neighbours' THEN mean + num / den
           ELSE coalesce(mean, (SELECT avg(rating) FROM train)) END)), 6) AS prediction
  FROM sources
)"""
_PREDICTED = f'{_CF} SELECT "user", item, prediction, source FROM predicted'
_PAIRS = f"""{_STATS}
SELECT u, v, n, sum_u, sum_v, sum_uv, sum_u2, sum_v2, round(mean_u, 6) AS mean_u, round(mean_v, 6) AS mean_v
FROM stats WHERE u < v"""
_MEANS = f"""WITH {RATINGS},
means AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY "user"),
predicted AS (SELECT t."user", t.item, t.rating, coalesce(m.mean, (SELECT avg(rating) FROM train)) AS prediction
              FROM test t LEFT JOIN means m ON m."user" = t."user")"""


def _histogram(source):
    return f"""{source}
SELECT b.bucket, count(p.rating) AS n
FROM (SELECT CAST(range AS INTEGER) AS bucket FROM range(5)) b
     LEFT JOIN predicted p ON b.bucket = least(floor(abs(p.rating - p.prediction)), 4)
GROUP BY b.bucket"""


ORACLE = {
    "ratings_csv_roundtrip": f"""WITH {RATINGS}
SELECT CAST("user" AS VARCHAR) AS "user", CAST(item AS VARCHAR) AS item, rating FROM ratings""",
    "ratings_lines": f"""WITH {RATINGS}
SELECT CAST("user" AS VARCHAR) || ',' || CAST(item AS VARCHAR) || ',' || CAST(CAST(rating AS BIGINT) AS VARCHAR) AS value
FROM ratings""",
    "ratings_peek": f'WITH {RATINGS} SELECT "user", item, rating FROM ratings ORDER BY "user", item LIMIT 5',
    "ratings_dedup": f'WITH {RATINGS} SELECT "user", item, rating FROM ratings',
    "train_minus_test": f'WITH {RATINGS} SELECT "user", item, rating FROM train',
    "user_mean": f'WITH {RATINGS} SELECT "user", round(avg(rating), 6) AS mean FROM train GROUP BY "user"',
    "item_mean": f"WITH {RATINGS} SELECT item, round(avg(rating), 6) AS mean FROM train GROUP BY item",
    "corated_pairs": _PAIRS,
    "corated_pairs_heavy": _PAIRS,
    "corated_partners": f"""WITH {RATINGS}
SELECT a."user" AS u, count(DISTINCT b."user") AS partners, count(*) AS n, sum(a.rating * b.rating) AS sum_uv,
       sum(b.rating * b.rating) AS sum_v2
FROM train a JOIN train b ON a.item = b.item AND a."user" <> b."user" GROUP BY 1""",
    "pearson_weight": f"{_WEIGHTS} SELECT u, v, round(w, 6) AS w FROM weights WHERE u < v",
    "user_cf_predict": _PREDICTED,
    "user_cf_heavy": _PREDICTED,
    "user_cf_literal": f"""WITH {RATINGS},
pairs AS (SELECT a."user" AS u, b."user" AS v, count(*) AS n, avg(b.rating) AS mean_v
          FROM ratings a JOIN ratings b ON a.item = b.item AND a."user" <> b."user" GROUP BY 1, 2),
scored AS (
  SELECT t."user", t.item,
         sum(CASE WHEN p.n >= 2 THEN r.rating - p.mean_v ELSE 0 END) AS num,
         sum(CASE WHEN p.n >= 2 THEN 1 ELSE 0 END) AS den
  FROM test t JOIN ratings r ON r.item = t.item AND r."user" <> t."user"
       JOIN pairs p ON p.u = t."user" AND p.v = r."user"
  GROUP BY 1, 2),
means AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY "user")
SELECT "user", item, round(greatest(0.0, least(5.0, CASE WHEN den = 0 THEN 0.0 ELSE num / den END)), 6) + 0.0
         AS prediction, 'neighbours' AS source FROM scored
UNION ALL
SELECT t."user", t.item, round(m.mean, 6) AS prediction, 'user mean' AS source
FROM test t JOIN means m ON m."user" = t."user"
WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s."user" = t."user" AND s.item = t.item)""",
    "fallback_predict": f"{_MEANS} SELECT \"user\", item, round(prediction, 6) AS prediction FROM predicted",
    "mean_error_histogram": _histogram(_MEANS),
    "mean_rmse": f"{_MEANS} SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse FROM predicted",
    "cf_error_histogram": _histogram(_CF),
    "cf_rmse": f"{_CF} SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 5) AS rmse FROM predicted",
    "prediction_lines": f"""{_MEANS}
SELECT CAST("user" AS VARCHAR) || ',' || CAST(item AS VARCHAR) || ','
       || CAST(CAST(round(prediction * 1000) AS BIGINT) AS VARCHAR) AS value FROM predicted""",
    "als_checks": f"""WITH {RATINGS}
SELECT count(*) AS pairs, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS out_of_range, count(*) AS rated,
       true AS rmse_below_2 FROM (SELECT DISTINCT "user", item FROM test)""",
    "als_residuals": f"""WITH {RATINGS}
SELECT count(DISTINCT "user") AS users, count(*) AS ratings, CAST(0 AS BIGINT) AS unsolved FROM train""",
    "id_encode": """SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INTEGER) AS user_id
FROM (SELECT DISTINCT o_custkey AS "user" FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""",
}
