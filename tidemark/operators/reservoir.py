"""Reservoir samples of numbered messages, and what they look like over time.

Messages carry `seq`, their arrival number from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import number_rows

# Messages kept, and tags shown.
CAPACITY = 100
TOP_TAGS = 5


def arrival_number(df: DataFrame, *order: str) -> DataFrame:
    """The rows with `n`, their position in the given order, from 1."""
    return number_rows(df, *order, name="n")


def seeded_draw(seq: Column, seed: int = 42) -> Column:
    """A large pseudo-random number that is the same in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), seq), F.lit(1 << 62))


def slot_of(seq: Column, k: int = CAPACITY, draw: Column | None = None, mode: str = "uniform") -> Column:
    """The slot a message would take; at `k` or above it isn't kept.

    "uniform" keeps arrival n with probability k/n, "literal" with k/(n-1).
    """
    draw = seeded_draw(seq) if draw is None else draw
    arrivals = seq if mode == "uniform" else F.greatest(seq - 1, F.lit(1))
    return F.when(seq <= k, seq - 1).otherwise(draw % arrivals)


def accepted(
    messages: DataFrame, k: int = CAPACITY, draw: Column | None = None, mode: str = "uniform"
) -> DataFrame:
    """The messages that enter the reservoir, with their `slot`: about k(1 + ln(N/k)) rows."""
    slot = slot_of(F.col("seq"), k, draw, mode)
    return messages.withColumn("slot", slot).where(F.col("slot") < k)


def latest_per_slot(entered: DataFrame) -> DataFrame:
    """The last message of each slot. Associative, so batches can be merged with it."""
    row = F.struct(*entered.columns)
    return entered.groupBy(F.col("slot").alias("_slot")).agg(F.max_by(row, "seq").alias("row")).select("row.*")


def reservoir_sample(
    messages: DataFrame, k: int = CAPACITY, draw: Column | None = None, mode: str = "uniform"
) -> DataFrame:
    """[slot, seq, ...]: a sample of k messages as the sequential algorithm leaves it."""
    return latest_per_slot(accepted(messages, k, draw, mode))


def replaced_message(entered: DataFrame) -> DataFrame:
    """The accepted messages with `prev_seq`, the message each one replaces."""
    in_slot = Window.partitionBy("slot").orderBy("seq")
    return entered.withColumn("prev_seq", F.lag("seq").over(in_slot))


def running_length_sum(entered: DataFrame, length: str = "len") -> DataFrame:
    """[seq, total_len]: total length in the reservoir after each accepted message.

    The window runs over the accepted messages only, whose number grows with ln(N).
    """
    in_slot = Window.partitionBy("slot").orderBy("seq")
    change = F.col(length) - F.coalesce(F.lag(length).over(in_slot), F.lit(0))
    so_far = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changes = entered.select("seq", change.alias("_change"))
    return changes.select("seq", F.sum("_change").over(so_far).alias("total_len"))


def tag_counts(tags: DataFrame) -> DataFrame:
    """[tag, n] from [tag, sign]: +1 for an added and -1 for a removed occurrence."""
    return tags.groupBy("tag").agg(F.sum("sign").alias("n"))


def positive_tags(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("n") > 0)


def top_tags(counts: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """[rank, tag, n]: the k most frequent tags."""
    best = positive_tags(counts).orderBy(F.desc("n"), "tag").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "tag"))
    return best.select(rank.alias("rank"), "tag", "n")


def avg_text_length(messages: DataFrame, text: str = "body") -> DataFrame:
    """[avg_len]"""
    return messages.agg(F.avg(F.length(text)).alias("avg_len"))


def _tag_text(tag: Column, n: Column) -> Column:
    return F.concat_ws(":", tag, n.cast("string"))


def _ranked_tags(counts: DataFrame, by: list[str]) -> DataFrame:
    """[by..., top_tags]: `tag:n` of the most frequent tags, most frequent first."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "tag"))
    best = positive_tags(counts).withColumn("rank", rank).where(F.col("rank") <= TOP_TAGS)
    listed = F.array_sort(F.collect_list(F.struct("rank", _tag_text(F.col("tag"), F.col("n")).alias("text"))))
    return best.groupBy(*by).agg(listed["text"].alias("top_tags"))


def held_report(held: DataFrame) -> DataFrame:
    """[n, top_tags, avg_len] of a reservoir of [slot, seq, len, tags]; n is its newest message."""
    tags = held.select(F.lit(0).alias("s"), F.explode("tags").alias("tag"))
    shown = _ranked_tags(tags.groupBy("s", "tag").agg(F.count("*").alias("n")), ["s"])
    size = held.agg(F.max("seq").alias("n"), F.avg("len").alias("avg_len")).withColumn("s", F.lit(0))
    return size.join(shown, "s", "left").select("n", _or_empty("top_tags"), "avg_len")


def reservoir_snapshot(
    messages: DataFrame,
    k: int = CAPACITY,
    draw: Column | None = None,
    mode: str = "uniform",
    every: str = "replacement",
    length: str = "len",
) -> DataFrame:
    """[n, top_tags, avg_len] of the reservoir, from [seq, len, tags].

    every="replacement": after each replacement, n being the message that came in.
    every="batch": once, after all given messages.

    A message belongs to the snapshots from its own up to the one that evicts it, so it
    is repeated for these instead of joined with them.
    """
    entered = accepted(messages.select("seq", F.col(length).alias("len"), "tags"), k, draw, mode)
    if every == "batch":
        return held_report(latest_per_slot(entered))
    by_seq, in_slot = Window.orderBy("seq"), Window.partitionBy("slot").orderBy("seq")
    numbered = entered.withColumn(
        "s", F.sum((F.col("seq") > k).cast("int")).over(by_seq.rowsBetween(Window.unboundedPreceding, 0))
    )
    last = F.max("s").over(Window.partitionBy())
    spans = numbered.withColumn("until", F.coalesce(F.lead("s").over(in_slot) - 1, last)).withColumn(
        "since", F.greatest("s", F.lit(1))
    )
    alive = spans.where(F.col("since") <= F.col("until")).select(
        F.explode(F.sequence("since", "until")).alias("s"), "len", "tags"
    )
    counts = alive.select("s", F.explode("tags").alias("tag")).groupBy("s", "tag").agg(F.count("*").alias("n"))
    sizes = alive.groupBy("s").agg(F.avg("len").alias("avg_len"))
    arrivals = numbered.where(F.col("seq") > k).select("s", F.col("seq").alias("n"))
    shown = _ranked_tags(counts, ["s"])
    joined = arrivals.join(sizes, "s").join(shown, "s", "left")
    return joined.select("n", _or_empty("top_tags"), "avg_len")


def _or_empty(name: str) -> Column:
    return F.coalesce(name, F.array().cast("array<string>")).alias(name)
