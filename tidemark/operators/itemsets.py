"""Frequent itemsets over baskets given as [key, item] rows.

Baskets stay in long form where their sets are listed, so one heavy basket doesn't end up in one
row; where candidates are counted, a basket is a row of whole numbers, one for each of its items that is in a candidate.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix_tree import PrefixTree, build, walk
from tidemark.operators.relational import local_threshold, min_support, union_all
from tidemark.operators.skew import HOT_KEYS, HOT_ROWS, number_rows, salted_join
from tidemark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Baskets up to this many frequent items have their subsets listed directly.
WIDE_BASKET = 64
MAX_BROADCAST_ROWS = 1_000_000
# Nodes of a prefix tree: 16 MB.
MAX_NODES = 1_000_000


def basket_items(rows: DataFrame) -> DataFrame:
    """[key, item] without duplicates."""
    return rows.select("key", "item").distinct()


def build_baskets(rows: DataFrame) -> DataFrame:
    """[key, items]: the distinct items of each basket, sorted, for baskets that fit a row.

    Questions about baskets of any size are answered on the long form: see `baskets_with`.
    """
    return basket_items(rows).groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))


def baskets_with(rows: DataFrame, *items: str) -> DataFrame:
    """[key]: the baskets that hold all of the given items, whatever their size.

    Each basket counts the wanted items it holds, so no basket is ever one row.
    """
    wanted = sorted(set(items))
    held = basket_items(rows).where(F.col("item").isin(wanted)).groupBy("key").agg(F.count("*").alias("_n"))
    return held.where(F.col("_n") == len(wanted)).select("key")


def chunk_of(chunks: int, key: Column | None = None) -> Column:
    """The chunk of a basket: a fixed function of its key."""
    return F.pmod(F.xxhash64(F.col("key") if key is None else key), F.lit(chunks))


def local_frequent_items(
    rows: DataFrame, support: int, chunks: int, chunk: Column | None = None
) -> DataFrame:
    """[items]: single items that reach the local threshold in at least one chunk."""
    chunk = chunk_of(chunks) if chunk is None else chunk
    counts = basket_items(rows).groupBy(chunk.alias("chunk"), "item").agg(F.count("*").alias("support"))
    local = min_support(counts, local_threshold(support, chunks))
    return local.select(F.array("item").alias("items")).distinct()


@dataclass
class _Numbered:
    """Candidates and baskets with items as whole numbers."""

    sets: DataFrame  # [number, items, ids], written
    baskets: DataFrame  # [key, ids], of the items that are in candidates, written
    n_sets: int
    n_items: int
    per_tree: int


def _numbered(rows: DataFrame, candidates: DataFrame) -> _Numbered | None:
    wanted = candidates.select(F.array_sort(F.array_distinct("items")).alias("items")).where(F.size("items") > 0)
    sets = number_rows(wanted.distinct(), "items", name="number")
    sets = materialise(sets.select("items", (F.col("number") - 1).alias("number")), "candidates")
    n_sets, longest = sets.agg(F.count("*"), F.max(F.size("items"))).first()
    if not n_sets:
        return None
    long = sets.select("number", F.explode("items").alias("item"))
    ids = number_rows(long.select("item").distinct(), "item", name="id")
    ids = materialise(ids.select("item", (F.col("id") - 1).alias("id")), "items")
    sets = sets.join(
        salted_join(long, ids, "item").groupBy("number").agg(F.array_sort(F.collect_list("id")).alias("ids")), "number"
    )
    matching = salted_join(basket_items(rows), ids, "item")
    baskets = matching.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return _Numbered(
        materialise(sets, "numbered"), materialise(baskets, "matching"), n_sets, ids.count(), max(1, MAX_NODES // longest)
    )


def _trees(numbered: _Numbered) -> Iterator[PrefixTree]:
    """Prefix trees of at most MAX_NODES nodes, which is what the driver reads and the tasks get at once."""
    for first in range(0, numbered.n_sets, numbered.per_tree):
        part = numbered.sets.where(F.col("number").between(first, first + numbered.per_tree - 1)).select("number", "ids").toArrow()
        ids = part.column("ids").combine_chunks()
        sizes = np.diff(ids.offsets.to_numpy()).astype(np.int64)
        yield build(ids.flatten().to_numpy(), sizes, part.column("number").to_numpy(), numbered.n_items)


def _walk_baskets(baskets: DataFrame, tree: PrefixTree, tag: str) -> DataFrame:
    """[tag, number]: per set of the tree the baskets that hold it, by their column `tag`."""
    kind = baskets.schema[tag].dataType.simpleString()

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            first = ids.offsets[0].as_py()
            for basket, number in walk(tree, ids.offsets.to_numpy() - first, ids.flatten().to_numpy()):
                yield pa.RecordBatch.from_arrays([batch.column(tag).take(pa.array(basket)), pa.array(number)], names=[tag, "number"])

    return baskets.select(tag, "ids").mapInArrow(hits, f"{tag} {kind}, number bigint")


def _count_hits(baskets: DataFrame, tree: PrefixTree) -> DataFrame:
    """[part, number, n]: how many baskets of each part hold each set, counted per batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part = batch.column("ids"), batch.column("part").to_numpy()
            first = ids.offsets[0].as_py()
            for basket, number in walk(tree, ids.offsets.to_numpy() - first, ids.flatten().to_numpy()):
                (both, n) = np.unique(np.stack([part[basket], number]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(n)], names=["part", "number", "n"])

    return baskets.select("part", "ids").mapInArrow(count, "part bigint, number bigint, n bigint")


def baskets_containing(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """[items, key]: the baskets that hold every item of a candidate.

    The candidates are a prefix tree, or several of bounded size, that every task walks over
    its baskets: nothing is joined on items, however many baskets share one. A basket is the row
    of those of its items that are in candidates.
    """
    numbered = _numbered(rows, candidates)
    if numbered is None:
        return rows.select(F.array("item").alias("items"), "key").limit(0)
    found = union_all(*[_walk_baskets(numbered.baskets, tree, "key") for tree in _trees(numbered)])
    return found.join(numbered.sets.select("number", "items"), "number").select("items", "key")


def candidate_counts(rows: DataFrame, candidates: DataFrame, part: Column | None = None) -> DataFrame:
    """[part, items, n]: in how many baskets of each part, a function of the key, each candidate is, if in any.

    Counted as `baskets_containing`, without listing the baskets.
    """
    numbered = _numbered(rows, candidates)
    if numbered is None:
        return rows.select(F.lit(0).cast("bigint").alias("part"), F.array("item").alias("items"), F.lit(0).cast("bigint").alias("n")).limit(0)
    part = F.lit(0) if part is None else part
    baskets = numbered.baskets.withColumn("part", part.cast("bigint"))
    counts = union_all(*[_count_hits(baskets, tree) for tree in _trees(numbered)])
    counts = counts.groupBy("part", "number").agg(F.sum("n").alias("n"))
    return counts.join(numbered.sets.select("number", "items"), "number").select("part", "items", "n")


def local_frequent_sets(
    rows: DataFrame, candidates: DataFrame, support: int, chunks: int, chunk: Column | None = None
) -> DataFrame:
    """[items]: candidates that reach the local threshold in at least one chunk."""
    chunk = chunk_of(chunks) if chunk is None else chunk
    counts = candidate_counts(rows, candidates, chunk).withColumnRenamed("n", "support")
    return min_support(counts, local_threshold(support, chunks)).select("items").distinct()


def global_support(rows: DataFrame, candidates: DataFrame, support: int) -> DataFrame:
    """[items, size, support]: candidates whose exact support reaches the threshold."""
    counts = candidate_counts(rows, candidates).withColumnRenamed("n", "support")
    return min_support(counts, support).select("items", F.size("items").alias("size"), "support")


def apriori_candidates(frequent: DataFrame) -> DataFrame:
    """[items]: sets one item larger all of whose subsets are in `frequent`.

    Two sets are joined when they agree on all items but one. Items are ordered by how
    many sets hold them, rarest first, and the differing item is the most common one;
    so a common item doesn't bring all its sets together. Pairs aren't formed from
    single items here: `son_frequent_itemsets` reads them from the baskets.
    """
    if frequent.where(F.size("items") < 2).limit(1).count():
        raise ValueError("candidates of size 2 come from the baskets, not from all pairs of items")
    long = frequent.select("items", F.explode("items").alias("item"))
    degree = long.groupBy("item").agg(F.count("*").alias("_sets"))
    ordered = (
        long.join(degree, "item")
        .groupBy("items")
        .agg(F.array_sort(F.collect_list(F.struct("_sets", "item"))).alias("_order"))
        .select(
            F.expr("slice(_order, 1, size(_order) - 1)").alias("head"),
            F.element_at("_order", -1).alias("last"),
        )
    )
    a, b = ordered.alias("a"), ordered.alias("b")
    joined = a.join(b, (F.col("a.head") == F.col("b.head")) & (F.col("a.last") < F.col("b.last")))
    grown = F.concat(F.col("a.head"), F.array(F.col("a.last"), F.col("b.last")))
    grown = joined.select(F.array_sort(F.transform(grown, lambda s: s["item"])).alias("items"))
    subsets = grown.select(
        "items",
        F.explode(
            F.transform("items", lambda out: F.filter("items", lambda item: item != out))
        ).alias("_subset"),
    )
    known = frequent.select(F.col("items").alias("_subset")).distinct()
    return (
        subsets.join(known, "_subset")
        .groupBy("items")
        .agg(F.count("*").alias("_known"))
        .where(F.col("_known") == F.size("items"))
        .select("items")
    )


def _wide_limit(sizes: DataFrame, support: int, wide: int) -> tuple[int, int]:
    """(limit, number of baskets above it), with fewer baskets above than the support.

    A set that is frequent overall then occurs in some basket within the limit.
    """
    limit = wide
    steps = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / limit))).cast("int")
    # One row per doubling of the size: at most a few dozen.
    histogram = dict(sizes.groupBy(steps.alias("step")).agg(F.count("*")).collect())
    above = sum(n for step, n in histogram.items() if step > 0)
    step = 0
    while above >= support:
        step += 1
        above -= histogram.get(step, 0)
    return limit << step, above


def _extend(occurrences: DataFrame) -> DataFrame:
    """[chunk, key, head, last] of the sets one item larger, basket by basket.

    Rows are dealt out by basket, so any number of tasks share a chunk; the local counts are
    summed in each task before they meet by chunk. The lists hold at most the wide-basket
    limit of items.
    """
    ends = (
        occurrences.repartition("chunk", "key")
        .groupBy("chunk", "key", "head")
        .agg(F.array_sort(F.collect_list("last")).alias("ends"))
        .where(F.size("ends") > 1)
    )
    return (
        ends.select("chunk", "key", "head", "ends", F.posexplode("ends").alias("_at", "_first"))
        .select(
            "chunk",
            "key",
            F.concat("head", F.array("_first")).alias("head"),
            F.explode(F.expr("slice(ends, _at + 2, size(ends))")).alias("last"),
        )
    )


def _as_items(df: DataFrame) -> DataFrame:
    return df.withColumn("items", F.concat("head", F.array("last")))


def son_frequent_itemsets(
    rows: DataFrame,
    support: int,
    chunks: int = 8,
    max_size: int | None = None,
    wide: int = WIDE_BASKET,
) -> DataFrame:
    """[items, size, support]: every itemset in at least `support` baskets, level by level.

    Pass 1 counts sets inside each chunk of baskets, without moving them, and keeps
    those that reach the chunk's share of the support. Pass 2 sums the counts of just
    these candidates. Sets grow only from frequent sets, inside the baskets.

    Baskets with very many frequent items are counted apart: fewer of them than the
    support exist, so each frequent set shows in the other baskets too, and they are
    only asked which of the found candidates they hold.
    """
    pairs = materialise(basket_items(rows), "baskets")
    singles = materialise(
        min_support(pairs.groupBy("item").agg(F.count("*").alias("support")), support), "singles"
    )
    hot = singles.where(F.col("support") >= HOT_ROWS).orderBy(F.desc("support"), "item").limit(HOT_KEYS)
    kept = materialise(
        salted_join(pairs, singles.select("item"), "item", hot=[r[0] for r in hot.select("item").collect()]),
        "kept",
    )
    sizes = kept.groupBy("key").agg(F.count("*").alias("_n"))
    limit, n_wide = _wide_limit(sizes, support, wide)
    narrow, wide_rows = kept, None
    if n_wide:
        keys = sizes.where(F.col("_n") > limit).select("key")
        # The histogram has counted these keys.
        keys = F.broadcast(keys) if n_wide <= MAX_BROADCAST_ROWS else keys
        wide_rows = materialise(kept.join(keys, "key", "left_semi"), "wide")
        narrow = kept.join(keys, "key", "left_anti")

    levels = [singles.select(F.array("item").alias("items"), F.lit(1).alias("size"), "support")]
    empty_head = F.array().cast("array<string>")
    occurrences = narrow.select(
        chunk_of(chunks).alias("chunk"), "key", empty_head.alias("head"), F.col("item").alias("last")
    )
    local = local_threshold(support - n_wide, chunks)
    size = 2
    while max_size is None or size <= max_size:
        grown = _extend(occurrences)
        counts = grown.groupBy("chunk", "head", "last").agg(F.count("*").alias("n"))
        candidates = counts.where(F.col("n") >= local).select("head", "last").distinct()
        found = (
            counts.join(candidates, ["head", "last"], "left_semi")
            .groupBy("head", "last")
            .agg(F.sum("n").alias("support"))
        )
        if wide_rows is not None:
            found = materialise(_as_items(min_support(found, support - n_wide)), "candidates")
            in_wide = candidate_counts(wide_rows, found.select("items")).select("items", F.col("n").alias("_wide"))
            found = (
                found.join(in_wide, "items", "left")
                .withColumn("support", F.col("support") + F.coalesce("_wide", F.lit(0)))
                .select("head", "last", "support")
            )
        level = materialise(min_support(found, support), f"level{size}")
        if level.limit(1).count() == 0:
            break
        levels.append(_as_items(level).select("items", F.lit(size).alias("size"), "support"))
        if max_size is None or size < max_size:
            occurrences = materialise(
                grown.join(level.select("head", "last"), ["head", "last"], "left_semi"), "occurrences"
            )
        size += 1
    return union_all(*levels)


def fpgrowth_itemsets(rows: DataFrame, support: int) -> DataFrame:
    """The same itemsets from the built-in miner.

    Baskets are cut to their frequent items first, so no array exceeds their number. The
    miner keeps these items on the driver; where they are too many, `son_frequent_itemsets`
    is the method without that need.
    """
    pairs = materialise(basket_items(rows), "baskets")
    counts = pairs.groupBy("item").agg(F.count("*").alias("support"))
    singles = materialise(min_support(counts, support), "singles")
    baskets = materialise(
        salted_join(pairs, singles.select("item"), "item")
        .groupBy("key")
        .agg(F.collect_list("item").alias("items"))
        .select("items"),
        "arrays",
    )
    n = baskets.count()
    schema = "items array<string>, size int, support bigint"
    if n == 0:
        return rows.sparkSession.createDataFrame([], schema)
    # Half a basket below the support keeps the rounded-up threshold exact.
    model = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / n).fit(baskets)
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("size"),
        F.col("freq").alias("support"),
    )
