"""Rating prediction: user neighbourhoods, ALS, fallbacks and error reports.

Ratings are [user, item, rating] rows.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.scalars import clamp, error_bucket, not_self_pair
from tidemark.operators import rater_pairs
from tidemark.operators.relational import anti_by_key, union_all
from tidemark.operators.skew import HOT_KEYS, HOT_ROWS, hot_keys, number_rows, salted_join
from tidemark.session import materialise, scratch_dir

# The functions that run in Python workers travel whole: these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# An item with at least this many raters is kept out of the pair listing where possible, and listed in cells of two
# blocks of about so many raters where not.
HEAVY_RATERS = 4096
# Tested items of a user, or of a rater, that meet in one row.
CHUNK = 4096
# A user with at least this many ratings is matched by user instead of by item.
HEAVY_RATINGS = 10_000
# Pairs of raters that a task lists or sums up, and the most tasks that they are dealt to.
TASK_PAIRS = 1_000_000
MAX_TASKS = 20_000
# So many tasks' pairs are listed by one task.
TASKS_LISTED = 8

PAIR_SUMS = ("n", "sum_u", "sum_v", "sum_uv", "sum_u2", "sum_v2")


# --- inputs and averages -------------------------------------------------------------


def dedupe_ratings(ratings: DataFrame) -> DataFrame:
    """One row per (user, item), with the highest of repeated ratings."""
    return ratings.groupBy("user", "item").agg(F.max("rating").alias("rating"))


def subtract_pairs(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training ratings whose (user, item) isn't in the test set."""
    return anti_by_key(train, test, ["user", "item"])


def uncovered(test: DataFrame, predictions: DataFrame) -> DataFrame:
    """Test pairs without a prediction."""
    return anti_by_key(test, predictions, ["user", "item"])


def user_mean(ratings: DataFrame) -> DataFrame:
    """[user, mean]"""
    return ratings.groupBy("user").agg(clamp(F.avg("rating")).alias("mean"))


def item_mean(ratings: DataFrame) -> DataFrame:
    """[item, mean]"""
    return ratings.groupBy("item").agg(clamp(F.avg("rating")).alias("mean"))


def global_mean(ratings: DataFrame) -> Column:
    """The average rating as a scalar subquery."""
    return ratings.agg(F.avg("rating")).scalar()


# --- pairs of users ------------------------------------------------------------------


def item_degrees(ratings: DataFrame) -> DataFrame:
    """[item, raters]"""
    return ratings.groupBy("item").agg(F.count("*").alias("raters"))


def rater_cells(ratings: DataFrame, heavy: DataFrame, block: int) -> DataFrame:
    """The ratings with [low, high, own]: two blocks of an item's raters whose pairs meet, and the rater's own.

    A rater of a heavy item is in one cell for each of the item's blocks, so each two blocks
    meet once and a cell holds about two blocks, whatever the item.
    """
    blocks = heavy.select("item", F.ceil(F.col("raters") / block).cast("int").alias("_blocks"))
    marked = salted_join(ratings, blocks, "item", "left", _heaviest(heavy))
    marked = marked.withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("user"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    dealt = marked.withColumn("own", own).withColumn("_other", other)
    return dealt.withColumn("low", F.least("own", "_other")).withColumn("high", F.greatest("own", "_other")).drop(
        "_blocks", "_other"
    )


def corated_pairs(
    ratings: DataFrame,
    flag: str | None = None,
    heavy: DataFrame | None = None,
    block: int = HEAVY_RATERS,
    tasks: int | None = None,
) -> DataFrame:
    """[u, v, item, r_u, r_v] with u < v, from one self-join on the item.

    With `flag`, a boolean column, at least one user of the pair must carry it. `heavy` are the items of
    `heavy_items`; their raters meet in cells of two blocks. The items, or cells, are dealt to `tasks` tasks.
    """
    cells = ratings if heavy is None else rater_cells(ratings, heavy, block)
    if tasks:
        cells = cells.repartition(tasks, "item", *([] if heavy is None else ["low", "high"]))
    a, b = cells.alias("a"), cells.alias("b")
    same = (F.col("a.item") == F.col("b.item")) & (F.col("a.user") < F.col("b.user"))
    if heavy is not None:
        same = same & (F.col("a.low") == F.col("b.low")) & (F.col("a.high") == F.col("b.high"))
        # In a cell of two blocks only pairs across them, as those within one have a cell of their own.
        same = same & ((F.col("a.low") == F.col("a.high")) | (F.col("a.own") != F.col("b.own")))
    if flag:
        same = same & (F.col(f"a.{flag}") | F.col(f"b.{flag}"))
    return a.join(b, same).select(
        F.col("a.user").alias("u"),
        F.col("b.user").alias("v"),
        F.col("a.item").alias("item"),
        F.col("a.rating").alias("r_u"),
        F.col("b.rating").alias("r_v"),
    )


def heavy_items(ratings: DataFrame, heavy_raters: int = HEAVY_RATERS) -> DataFrame | None:
    """[item, raters] of the items with at least `heavy_raters` raters, None if there is none."""
    heavy = item_degrees(ratings).where(F.col("raters") >= heavy_raters)
    return materialise(heavy, "heavy") if heavy.limit(1).count() else None


def _heaviest(heavy: DataFrame) -> list:
    """The heavy items that joins must salt."""
    top = heavy.where(F.col("raters") >= HOT_ROWS).orderBy(F.desc("raters"), "item").limit(HOT_KEYS)
    return [row.item for row in top.select("item").collect()]


def pair_tasks(ratings: DataFrame) -> int:
    """Tasks for the pairs of raters of an item, of about TASK_PAIRS pairs each."""
    raters = F.col("raters")
    pairs = item_degrees(ratings.where("item IS NOT NULL")).agg(F.sum(raters * (raters - 1) / 2)).first()[0] or 0
    return int(min(MAX_TASKS, max(ratings.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_PAIRS))))


def _pair_sums(pairs: DataFrame, tasks: int | None = None) -> DataFrame:
    """The sums of each pair, in so many tasks; hardly a pair repeats before its rows are exchanged."""
    u, v = F.col("r_u"), F.col("r_v")
    dealt = pairs if tasks is None else pairs.select("u", "v", "r_u", "r_v").repartition(tasks, "u", "v")
    return dealt.groupBy("u", "v").agg(
        F.count("*").alias("n"),
        F.sum(u).alias("sum_u"),
        F.sum(v).alias("sum_v"),
        F.sum(u * v).alias("sum_uv"),
        F.sum(u * u).alias("sum_u2"),
        F.sum(v * v).alias("sum_v2"),
    )


def _listable(ratings: DataFrame) -> bool:
    """Whether packed lists give the same sums as rows: ratings are doubles or turn into them without loss."""
    user, rating = (ratings.schema[c].dataType.typeName() for c in ("user", "rating"))
    return user in ("byte", "short", "integer", "long", "string", "date") and rating in ("byte", "short", "integer", "float", "double")


def _block(user: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(blocks)).cast("int")


def corated_lists(
    ratings: DataFrame, flag: str | None, heavy: DataFrame | None, block: int, tasks: int, blocks: int, grid: bool, both: bool = False
) -> DataFrame:
    """The pairs of `corated_pairs` as packets of lists, in cells of one or, with `grid`, two blocks of users.

    With `both`, a pair is listed for each of its users. A task lists the items, or cells of raters, of several tasks' pairs,
    so that packets are large.
    """
    known = ratings.where("user IS NOT NULL AND item IS NOT NULL")
    known = known if heavy is None else rater_cells(known, heavy, block)
    order = ["item", *([] if heavy is None else ["low", "high"])]
    columns = [*order, "user", F.col("rating").cast("double").alias("rating"), *([] if heavy is None else ["own"]), *([flag] if flag else [])]
    listers = max(ratings.sparkSession.sparkContext.defaultParallelism, -(-tasks // TASKS_LISTED))
    dealt = known.select(*columns).repartition(listers, *order).sortWithinPartitions(*order, "user")
    dealt = dealt.withColumn("block", _block("user", blocks))
    listing = rater_pairs.Listing(blocks, grid, heavy is not None, flag, both)
    return dealt.mapInArrow(rater_pairs.listed(listing), rater_pairs.PACKETS)


def _heavy_lists(ratings: DataFrame, heavy: DataFrame, dropped: DataFrame, blocks: int) -> DataFrame:
    """The heavy ratings as packets for the cells of two blocks of users where they can meet: the dropped one of a user goes
    to the blocks of the item's raters, another to the blocks of the users that drop the item."""
    marks = dropped.select("user", "item", F.lit(True).alias("top"))
    tops = salted_join(ratings.select("user", "item", "rating"), heavy.select("item"), "item", hot=_heaviest(heavy))
    tops = tops.join(marks, ["user", "item"], "left").withColumn("top", F.coalesce("top", F.lit(False)))
    tops = materialise(tops.where("user IS NOT NULL").withColumn("own", _block("user", blocks)), "tops")
    # At most `blocks` numbers an item.
    meets = tops.groupBy("item").agg(F.collect_set("own").alias("rated"), F.collect_set(F.when(F.col("top"), F.col("own"))).alias("left"))
    tops = salted_join(tops, meets, "item", hot=_heaviest(heavy)).withColumn("others", F.when(F.col("top"), F.col("rated")).otherwise(F.col("left")))
    tops = tops.select("user", "item", F.col("rating").cast("double").alias("rating"), "top", "own", "others").where(F.size("others") > 0)
    return tops.repartition(blocks, "own").sortWithinPartitions("own").mapInArrow(rater_pairs.heavy_packets(blocks), rater_pairs.PACKETS)


def _summed(packets: DataFrame, schema: StructType, cells: int, least: int) -> DataFrame:
    """The sums of the pairs with at least `least` common items; a cell is summed where its packets meet."""
    met = packets.repartition(cells, "a", "b").sortWithinPartitions("a", "b")
    return met.mapInArrow(rater_pairs.summed(to_arrow_schema(schema), least), schema)


def _either_way(stats: DataFrame, both: bool) -> DataFrame:
    """The sums of each pair, with `both` as (u, v) and as (v, u)."""
    if not both:
        return stats
    back = {"u": "v", "v": "u", "sum_u": "sum_v", "sum_v": "sum_u", "sum_u2": "sum_v2", "sum_v2": "sum_u2"}
    turned = F.struct(*[F.col(back.get(c, c)).alias(c) for c in stats.columns])
    return stats.select(F.inline(F.array(F.struct(*stats.columns), turned)))


def pair_stats(
    ratings: DataFrame,
    users: DataFrame | None = None,
    heavy: DataFrame | None = None,
    block: int = HEAVY_RATERS,
    least: int = 2,
    both: bool = False,
) -> DataFrame:
    """[u, v, n, sum_u, sum_v, sum_uv, sum_u2, sum_v2, mean_u, mean_v] for every pair
    u < v that co-rated at least `least` items; with `users`, at least one of them is there, and with `both`,
    each pair is there as (u, v) and (v, u).

    `heavy` are the items of `heavy_items`. A pair with two common items still meets on the rarer one when each
    user's most common item is left out of the self-join: a user whose most common item is heavy drops
    that one item, and it is added back to the pairs found, by key. A user's further heavy
    items are listed, because pairs may have no other two items, in cells of bounded size. With `least=1`
    nothing can be left out, and the pairs of all raters of an item are the result. Pairs travel in packed lists
    (`rater_pairs`); the dropped items are added back in cells of two blocks of users.
    """
    base = ratings.select("user", "item", "rating")
    flag = None
    if users is not None:
        flag = "wanted"
        marks = users.select("user").distinct().withColumn(flag, F.lit(True))
        base = salted_join(base, marks, "user", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    # Few ratings make many pairs, so what a task lists is bounded by the pairs and not by the ratings it reads.
    tasks = pair_tasks(base)
    schema = _pair_sums(corated_pairs(base)).schema
    if heavy is not None and least >= 2:
        dropped = materialise(
            salted_join(ratings, heavy, "item", hot=_heaviest(heavy))
            .groupBy("user")
            .agg(F.max_by(F.struct("item", "rating"), F.struct("raters", "item")).alias("top"))
            .select("user", "top.*"),
            "dropped",
        )
        listed = base.join(dropped, ["user", "item"], "left_anti")
        blocks = max(1, math.isqrt(tasks - 1) + 1)
        packets = corated_lists(listed, flag, heavy, block, tasks, blocks, grid=True)
        packets = packets.unionByName(_heavy_lists(ratings, heavy, dropped, blocks))
        stats = _either_way(_summed(packets, schema, blocks * blocks, least), both)
    elif _listable(base):
        stats = _summed(corated_lists(base, flag, heavy, block, tasks, tasks, False, both), schema, tasks, least)
    else:
        stats = _either_way(_pair_sums(corated_pairs(base, flag, heavy, block, tasks), tasks), both)
    return stats.where(F.col("n") >= least).select(
        "u",
        "v",
        *PAIR_SUMS,
        clamp(F.col("sum_u") / F.col("n")).alias("mean_u"),
        clamp(F.col("sum_v") / F.col("n")).alias("mean_v"),
    )


def pearson_weight(stats: DataFrame, mode: str = "pearson") -> DataFrame:
    """The pair statistics with their weight `w`.

    "pearson" correlates the co-rated ratings, 0 without variance. "literal" compares
    the sum of each side with its mean, which is 1 for positive ratings.
    """
    if mode == "literal":
        gap = (F.col("sum_u") - F.col("mean_u")) * (F.col("sum_v") - F.col("mean_v"))
        return stats.withColumn("w", F.signum(gap))
    n, u, v = F.col("n"), F.col("sum_u"), F.col("sum_v")
    var_u, var_v = n * F.col("sum_u2") - u * u, n * F.col("sum_v2") - v * v
    # Below this share of the raw moment a difference is rounding, not variance.
    varied = (var_u > n * F.col("sum_u2") * 1e-12) & (var_v > n * F.col("sum_v2") * 1e-12)
    w = (n * F.col("sum_uv") - u * v) / F.sqrt(var_u * var_v)
    return stats.withColumn("w", F.when(varied, w).otherwise(F.lit(0.0)))


def directed_weights(weights: DataFrame) -> DataFrame:
    """[user, v, w, mean_v] in both directions, without the zero weights."""
    there = F.struct(F.col("u").alias("user"), F.col("v").alias("v"), F.col("mean_v").alias("mean_v"))
    back = F.struct(F.col("v").alias("user"), F.col("u").alias("v"), F.col("mean_u").alias("mean_v"))
    useful = weights.where(F.col("w") != 0)
    return useful.select("w", F.inline(F.array(there, back))).select("user", "v", "w", "mean_v")


# --- neighbourhood prediction --------------------------------------------------------


def _chunks(*sizes: DataFrame) -> int:
    """Parts that the items are cut into so that lists of [.., n] hold about CHUNK of them."""
    most = [s.agg(F.max("n")).first()[0] or 0 for s in sizes]
    return max(1, -(-max(most) // CHUNK))


def candidate_neighbours(test: DataFrame, ratings: DataFrame, chunks: int = 1) -> tuple[DataFrame, DataFrame]:
    """([user, chunk, wanted], [v, chunk, rated]): a user's tested items, and what a rater gave to tested items."""
    chunk = F.pmod(F.xxhash64("item"), F.lit(chunks)).cast("int").alias("chunk")
    wanted = test.select("user", "item").groupBy("user", chunk).agg(F.collect_set("item").alias("wanted"))
    given = ratings.join(test.select("item").distinct(), "item", "left_semi").select(
        F.col("user").alias("v"), chunk, F.struct("item", F.col("rating").alias("r_v")).alias("given")
    )
    return wanted, given.groupBy("v", "chunk").agg(F.collect_list("given").alias("rated"))


def attach_pair_stats(wanted: DataFrame, rated: DataFrame, weights: DataFrame) -> DataFrame:
    """[user, item, v, r_v, w, mean_v]: per weight, the tested items of the user that the neighbour rated.

    A weight meets one list of each side, and the lists are cut to their common items before
    they become rows.
    """
    met = weights.join(wanted, "user").join(rated, ["v", "chunk"]).where(not_self_pair(F.col("user"), F.col("v")))
    common = F.array_intersect(F.transform("rated", lambda g: g["item"]), F.col("wanted"))
    met = met.withColumn("common", common).where(F.size("common") > 0)
    hits = F.filter("rated", lambda g: F.array_contains("common", g["item"]))
    return met.select("user", "v", "w", "mean_v", F.inline(hits)).select("user", "item", "v", "r_v", "w", "mean_v")


def neighbour_ratings(test: DataFrame, ratings: DataFrame, weights: DataFrame) -> DataFrame:
    """[user, item, v, r_v, w, mean_v]: the weighted neighbours of every test pair.

    Starts from the weights, not from the raters of the tested items, so neither a popular item nor
    a user with many tests multiplies rows: a weight makes one row per chunk of the user's tests.
    """
    tests = test.select("user", "item").distinct()
    sizes = [df.groupBy("user").agg(F.count("*").alias("n")) for df in (tests, ratings)]
    return attach_pair_stats(*candidate_neighbours(tests, ratings, _chunks(*sizes)), weights)


def weighted_prediction(neighbours: DataFrame) -> DataFrame:
    """[user, item, num, den]: the weighted deviations from the neighbours' means."""
    deviation = F.col("w") * (F.col("r_v") - F.col("mean_v"))
    return neighbours.groupBy("user", "item").agg(
        F.sum(deviation).alias("num"), F.sum(F.abs("w")).alias("den")
    )


def has_neighbour(test: DataFrame, ratings: DataFrame, heavy_ratings: int = HEAVY_RATINGS) -> DataFrame:
    """[user, item]: test pairs whose item was rated by someone who shares an item with the user.

    Only pairs outside the ratings need a search. Their items, the targets, are numbered, and sets of targets
    go as words of 64 bits from raters to the items they rated and on to the users of these
    items; sets meet in an aggregation, so raters of one item never meet each other. A rater with very many
    ratings is matched with the users it shares an item with instead.
    """
    pairs = test.select("user", "item").distinct()
    rated = ratings.select("user", "item")
    shared = item_degrees(ratings).where(F.col("raters") >= 2).select("item")
    # The pair itself is rated: the item is the shared one.
    own = pairs.join(rated, ["user", "item"], "left_semi").join(shared, "item", "left_semi")
    # Not rated: look for an item of the user among the items rated together with it.
    open_pairs = pairs.join(rated, ["user", "item"], "left_anti")
    degree = rated.groupBy("user").agg(F.count("*").alias("_n"))
    heavy = degree.where(F.col("_n") >= heavy_ratings).select("user")
    by_heavy = None
    light = rated
    if heavy.limit(1).count():
        light = rated.join(heavy, "user", "left_anti")
        of_heavy = rated.join(heavy, "user", "left_semi").withColumnRenamed("user", "v")
        linked_to = rated.join(of_heavy, "item").select("user", "v").distinct()
        by_heavy = (
            open_pairs.join(of_heavy, "item")
            .where(F.col("user") != F.col("v"))
            .join(linked_to, ["user", "v"], "left_semi")
            .select("user", "item")
        )
    targets = number_rows(open_pairs.select("item").distinct(), "item", name="_n")
    bit = F.expr("shiftleft(1L, cast(_n % 64 as int))")
    targets = materialise(targets.select("item", F.floor(F.col("_n") / 64).alias("word"), bit.alias("bit")), "targets")
    open_words = materialise(open_pairs.join(targets, "item"), "open-pairs")
    # Words of targets by rater, by item, and, where the user asks for them, by user.
    by_rater = light.join(targets, "item").groupBy("user", "word").agg(F.bit_or("bit").alias("bits"))
    by_item = light.join(by_rater, "user").groupBy("item", "word").agg(F.bit_or("bits").alias("bits"))
    asked = open_words.groupBy("user", "word").agg(F.bit_or("bit").alias("mask"))
    met = rated.join(asked, "user").join(by_item, ["item", "word"])
    hits = F.col("bits").bitwiseAND(F.col("mask"))
    by_user = met.where(hits != 0).groupBy("user", "word").agg(F.bit_or(hits).alias("bits"))
    linked = (
        open_words.join(by_user, ["user", "word"])
        .where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        .select("user", "item")
    )
    if by_heavy is not None:
        linked = linked.unionByName(by_heavy)
    linked = linked.distinct()
    return own.unionByName(linked)


def fallback(
    pairs: DataFrame, means: DataFrame, default: Column | None = None, hot: list | None = None
) -> DataFrame:
    """[user, item, prediction]: the user's mean, else `default`; without a default,
    users that have no mean drop out."""
    joined = salted_join(pairs.select("user", "item"), means, "user", "left", hot)
    value = F.col("mean") if default is None else F.coalesce("mean", default)
    return joined.select("user", "item", clamp(value).alias("prediction")).where(
        F.col("mean").isNotNull() if default is None else F.lit(True)
    )


def user_cf(
    train: DataFrame, test: DataFrame, mode: str = "pearson", heavy_raters: int = HEAVY_RATERS
) -> DataFrame:
    """[user, item, prediction, source] from the ratings of similar users.

    "pearson": test pairs are taken out of the training set; the prediction is the
    user's mean plus the weighted deviations of the neighbours, and the user's or the
    global mean where no neighbour carries weight. Every test pair gets one prediction.

    "literal": pair statistics see the whole training file; the weighted deviations are
    the prediction, 0 when they cancel or carry no weight; pairs without any neighbour
    get the user's mean, and vanish when the user has none.
    """
    pairs = materialise(test.select("user", "item").distinct(), "pairs")
    every = dedupe_ratings(train)
    if mode == "literal":
        every = materialise(every, "every")
        known = subtract_pairs(every, pairs)
    else:
        known = materialise(subtract_pairs(every, pairs), "known")
    means = user_mean(known)
    hot_users = hot_keys(pairs, "user")
    ratings = every if mode == "literal" else known
    heavy = heavy_items(ratings, heavy_raters)
    stats = pair_stats(ratings, pairs, heavy, heavy_raters)
    weights = directed_weights(pearson_weight(stats, mode))
    scored = weighted_prediction(neighbour_ratings(pairs, ratings, weights))
    share = F.col("num") / F.col("den")
    if mode == "literal":
        met = has_neighbour(pairs, ratings).join(scored, ["user", "item"], "left")
        value = F.when((F.col("num") != 0) & (F.col("den") != 0), share).otherwise(F.lit(0.0))
        predicted = met.select(
            "user", "item", clamp(value).alias("prediction"), F.lit("neighbours").alias("source")
        )
        rest = fallback(uncovered(pairs, predicted), means, hot=hot_users)
        return union_all(predicted, rest.withColumn("source", F.lit("user mean")))
    joined = salted_join(pairs.join(scored, ["user", "item"], "left"), means, "user", "left", hot_users)
    default = global_mean(known)
    source = (
        F.when((F.col("den") > 0) & F.col("mean").isNotNull(), "neighbours")
        .when(F.col("mean").isNotNull(), "user mean")
        .otherwise("global mean")
    )
    value = F.when(source == "neighbours", F.col("mean") + share).otherwise(F.coalesce("mean", default))
    return joined.select("user", "item", clamp(value).alias("prediction"), source.alias("source"))


# --- matrix factorisation ------------------------------------------------------------


def id_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """[column, name]: the distinct values with dense int ids 0, 1, 2, ... in their order.

    The values are numbered across partitions and never gathered on the driver.
    """
    numbered = number_rows(df.select(column).distinct(), column, name="_n")
    return numbered.select(column, (F.col("_n") - 1).cast("int").alias(name))


def _als(
    train: DataFrame, test: DataFrame, rank: int, iters: int, reg: float, seed: int, blocks: int | None
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """(model, training ratings with ids, test pairs with ids)"""
    # The factors are checkpointed every few iterations in the shared folder.
    scratch_dir(train.sparkSession, "als")
    both = materialise(train.select("user", "item").unionByName(test.select("user", "item")), "ids")
    users, items = id_encode(both, "user", "user_id"), id_encode(both, "item", "item_id")
    hot_items = hot_keys(both, "item")
    hot_users = hot_keys(both, "user")

    def encode(df: DataFrame) -> DataFrame:
        return salted_join(salted_join(df, users, "user", hot=hot_users), items, "item", hot=hot_items)

    als = ALS(
        rank=rank, maxIter=iters, regParam=reg, seed=seed, coldStartStrategy="drop",
        userCol="user_id", itemCol="item_id", ratingCol="rating", checkpointInterval=5,
    )
    if blocks:
        als = als.setNumBlocks(blocks)
    ratings = materialise(encode(train.select("user", "item", "rating")), "ratings")
    return als.fit(ratings), ratings, encode(test.select("user", "item").distinct())


def als_fit_predict(
    train: DataFrame,
    test: DataFrame,
    rank: int = 2,
    iters: int = 15,
    reg: float = 0.25,
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """[user, item, prediction] for the test pairs whose user and item were trained."""
    model, _, pairs = _als(train, test, rank, iters, reg, seed, blocks)
    scored = model.transform(pairs)
    return scored.select("user", "item", F.col("prediction").cast("double").alias("prediction"))


def als_residuals(train: DataFrame, rank: int = 2, iters: int = 15, reg: float = 0.25, seed: int = 42) -> DataFrame:
    """[user_id, n, residual] of a fit, for every user of the ratings.

    The last half step of the fit solves, with the items' factors y fixed, (sum of y y' + reg n I) x = sum of r y
    for each user; the residual is the largest difference of the two sides, as a share of the right one.
    """
    model, ratings, _ = _als(train, train.limit(0), rank, iters, reg, seed, None)
    return normal_residuals(model.userFactors, model.itemFactors, ratings, rank, reg)


def normal_residuals(
    user_factors: DataFrame, item_factors: DataFrame, ratings: DataFrame, rank: int, reg: float
) -> DataFrame:
    y = [F.col("y")[i].cast("double") for i in range(rank)]
    x = [F.col("x")[i].cast("double") for i in range(rank)]
    factors = item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("y"))
    sums = ratings.join(factors, "item_id", "left").groupBy("user_id").agg(
        F.count("*").alias("n"),
        *[F.sum(y[i] * y[j]).alias(f"a{i}_{j}") for i in range(rank) for j in range(i + 1)],
        *[F.sum(F.col("rating") * y[i]).alias(f"b{i}") for i in range(rank)],
    )
    sums = sums.join(user_factors.select(F.col("id").alias("user_id"), F.col("features").alias("x")), "user_id", "left")
    gaps = []
    for i in range(rank):
        left = sum((F.col(f"a{max(i, j)}_{min(i, j)}") * x[j] for j in range(rank)), F.lit(0.0))
        gaps.append(F.abs(left + reg * F.col("n") * x[i] - F.col(f"b{i}")))
    scale = F.greatest(F.lit(1e-6), *[F.abs(f"b{i}") for i in range(rank)]) if rank > 1 else F.greatest(F.lit(1e-6), F.abs("b0"))
    largest = F.greatest(*gaps) if rank > 1 else gaps[0]
    return sums.select("user_id", "n", (largest / scale).alias("residual"))


def recommend_with_fallback(train: DataFrame, test: DataFrame, **als) -> DataFrame:
    """[user, item, prediction, source]: ALS where it can, else the user's or the global mean."""
    pairs = materialise(test.select("user", "item").distinct(), "pairs")
    known = materialise(subtract_pairs(dedupe_ratings(train), pairs), "known")
    predicted = materialise(als_fit_predict(known, pairs, **als), "predicted")
    rest = fallback(
        uncovered(pairs, predicted), user_mean(known), global_mean(known), hot=hot_keys(pairs, "user")
    )
    return union_all(
        predicted.select(
            "user", "item", clamp(F.col("prediction")).alias("prediction"), F.lit("model").alias("source")
        ),
        rest.withColumn("source", F.lit("mean")),
    )


# --- evaluation ----------------------------------------------------------------------


def join_actual(test: DataFrame, predictions: DataFrame) -> DataFrame:
    """[user, item, rating, prediction]"""
    return dedupe_ratings(test).join(predictions.select("user", "item", "prediction"), ["user", "item"])


def error_histogram(evaluated: DataFrame) -> DataFrame:
    """[bucket, n] for the five error buckets, empty ones included."""
    bucket = error_bucket(F.abs(F.col("rating") - F.col("prediction")))
    counts = evaluated.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    every = evaluated.sparkSession.range(5).select(F.col("id").cast("int").alias("bucket"))
    return every.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def rmse(evaluated: DataFrame) -> DataFrame:
    """[rmse]"""
    error = F.col("rating") - F.col("prediction")
    return evaluated.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def evaluation(evaluated: DataFrame) -> DataFrame:
    """[n, b0, b1, b2, b3, b4, rmse] in one pass."""
    error = F.col("rating") - F.col("prediction")
    bucket = error_bucket(F.abs(error))
    return evaluated.agg(
        F.count("*").alias("n"),
        *[F.count_if(bucket == b).alias(f"b{b}") for b in range(5)],
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
