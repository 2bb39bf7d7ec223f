"""Bloom filters over tags: replay against the exact truth, batch build and probe.

Tags are [seq, tag] rows, `seq` being the number of the message that brought them. A
tag counts as seen when an earlier message had it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import bloom_bits, bloom_sizing
from tidemark.operators.skew import hot_keys, salted_join
from tidemark.session import materialise

WORD = 32
# Filters up to this size (16 MB of words) travel to the tasks as one array.
MAX_BROADCAST_BITS = 1 << 26


def first_seen(tags: DataFrame) -> DataFrame:
    """[tag, first]"""
    return tags.groupBy("tag").agg(F.min("seq").alias("first"))


def tag_bits(firsts: DataFrame, m: int = 100, k: int = 3, family: str = "mod") -> DataFrame:
    """[tag, first, bit]"""
    bits = F.array_distinct(bloom_bits(F.col("tag"), m, k, family))
    return firsts.select("tag", "first", F.explode(bits).alias("bit"))


def first_set(bits: DataFrame) -> DataFrame:
    """[bit, first]: the message that first sets each bit; at most m rows."""
    return bits.groupBy("bit").agg(F.min("first").alias("first"))


def fresh_tags(bits: DataFrame, set_at: DataFrame) -> DataFrame:
    """[tag, first]: tags whose first message is also the first to set one of their bits."""
    return bits.join(set_at, ["bit", "first"], "left_semi").select("tag", "first").distinct()


def mark(tags: DataFrame, at: DataFrame, name: str) -> DataFrame:
    """The tags with boolean `name`, false exactly at the [tag, first] pairs of `at`.

    The join is on (tag, seq), so a tag in a third of all messages doesn't meet in one task.
    """
    hits = at.select("tag", F.col("first").alias("seq"), F.lit(False).alias(name))
    return tags.join(hits, ["tag", "seq"], "left").withColumn(name, F.coalesce(name, F.lit(True)))


def really_seen(tags: DataFrame) -> DataFrame:
    """The tags with `seen`: an earlier message had the tag, so only its first isn't."""
    return mark(tags, first_seen(tags), "seen")


def maybe_seen(tags: DataFrame, m: int = 100, k: int = 3, family: str = "mod") -> DataFrame:
    """The tags with `maybe`: earlier messages have set all the tag's bits.

    After its first message a tag's own bits are set. So the answer is "no" only there,
    and only if that message is the first to set one of the bits.
    """
    bits = tag_bits(first_seen(tags), m, k, family)
    return mark(tags, fresh_tags(bits, first_set(bits)), "maybe")


def bloom_replay(tags: DataFrame, m: int = 100, k: int = 3, family: str = "mod") -> DataFrame:
    """[seq, tag, maybe, seen]"""
    return really_seen(maybe_seen(tags, m, k, family)).select("seq", "tag", "maybe", "seen")


def _counters() -> list[Column]:
    maybe, seen = F.col("maybe"), F.col("seen")
    return [
        F.count_if(maybe & seen).alias("tp"),
        F.count_if(~maybe & ~seen).alias("tn"),
        F.count_if(maybe & ~seen).alias("fp"),
        F.count("*").alias("total"),
    ]


def bloom_confusion(flags: DataFrame) -> DataFrame:
    """[seq, tp, tn, fp, total] per message with tags."""
    return flags.groupBy("seq").agg(*_counters())


def bloom_report(flags: DataFrame, m: int = 100, k: int = 3) -> DataFrame:
    """[tp, tn, fp, total, keys, best_k, expected_fpp] over all messages."""
    totals = flags.agg(*_counters()).withColumn("keys", F.col("tn") + F.col("fp"))
    best_k, _ = bloom_sizing(F.col("keys"), m)
    _, rate = bloom_sizing(F.col("keys"), m, k)
    return totals.select("tp", "tn", "fp", "total", "keys", best_k.alias("best_k"), rate.alias("expected_fpp"))


def bloom_build(df: DataFrame, col: str, m: int = 100, k: int = 3, family: str = "mod") -> DataFrame:
    """[word, bits]: a filter of m bits over the values of a column, WORD bits to a word."""
    values = df.select(F.col(col).cast("string").alias("tag")).where(F.col("tag").isNotNull()).distinct()
    bits = values.select(F.explode(bloom_bits(F.col("tag"), m, k, family)).alias("bit"))
    return bits.groupBy(F.floor(F.col("bit") / WORD).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(bit % {WORD} as int))")).alias("bits")
    )


def bloom_probe(
    df: DataFrame,
    col: str,
    filter_words: DataFrame,
    m: int = 100,
    k: int = 3,
    family: str = "mod",
    max_broadcast_bits: int = MAX_BROADCAST_BITS,
    hot: list | None = None,
) -> DataFrame:
    """The rows with `maybe`; false means the value isn't in the filter, null that there is none.

    A filter of up to `max_broadcast_bits` is looked up in place. A larger one is joined
    by word with the distinct values, and the answers go back by value.
    """
    if m <= max_broadcast_bits:
        every = df.sparkSession.range(-(-m // WORD)).select(F.col("id").alias("word"))
        dense = every.join(filter_words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
        words = dense.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"]).scalar()
        bits = bloom_bits(F.col(col).cast("string"), m, k, family)
        hits = F.lit(True)
        for i in range(k):
            bit = F.col("_bits")[i]
            # shiftright wants a plain number of places, so divide by the power of two.
            word = words[F.floor(bit / WORD).cast("int")]
            hits = hits & (F.floor(word / F.pow(F.lit(2.0), bit % WORD)).cast("bigint") % 2 == 1)
        known = F.when(F.col(col).isNotNull(), hits)
        return df.withColumn("_bits", bits).withColumn("maybe", known).drop("_bits")
    values = df.select(F.col(col).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    bits = bloom_bits(F.col("_value").cast("string"), m, k, family)
    probes = values.select("_value", F.explode(bits).alias("bit")).withColumn("word", F.floor(F.col("bit") / WORD))
    found = probes.join(filter_words, "word", "left")
    is_set = F.coalesce(
        F.floor(F.col("bits") / F.pow(F.lit(2.0), F.col("bit") % WORD)).cast("bigint") % 2 == 1, F.lit(False)
    )
    answers = found.groupBy("_value").agg(F.bool_and(is_set).alias("maybe"))
    rows, hot = df, hot_keys(df, col) if hot is None else hot
    if hot:
        # Copies of one row get different salts. The ids repeat in a second run of a task,
        # because they follow the order of the rows in the written files.
        rows = materialise(df, "probed").withColumn("_row", F.monotonically_increasing_id())
    back = salted_join(rows, answers.withColumnRenamed("_value", col), col, "left", hot=hot)
    return back.select(*df.columns, "maybe")


# --- filters in blocks ---------------------------------------------------------------

# A block is so many words of 64 bits, and a value sets one bit in each word of its block.
LANES = 8
BLOCK_BITS = LANES * 64


def _block_of(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks))


def _lane_masks(value: Column) -> list[Column]:
    """Per word the value's bit: six bits of a second hash each."""
    draw = F.xxhash64(value, F.lit(1))
    one = F.lit(1).cast("bigint")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(draw, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(LANES)]


def _blocks(m: int) -> int:
    return max(1, -(-m // BLOCK_BITS))


def block_build(df: DataFrame, col: str, m: int) -> DataFrame:
    """[block, w0 .. w7]: a filter of about m bits in blocks, for filters too large to travel to the tasks."""
    values = df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    words = [F.bit_or(mask).alias(f"w{i}") for i, mask in enumerate(_lane_masks(F.col("v")))]
    return values.groupBy(_block_of(F.col("v"), _blocks(m)).alias("block")).agg(*words)


def block_probe(df: DataFrame, col: str, blocks: DataFrame, m: int, hot: list | None = None) -> DataFrame:
    """The rows with `maybe`; false means the value isn't in the filter, null that there is none.

    All bits of a value lie in one block, so a row meets one row of the filter, in one join. Blocks of very common
    values are salted; for that, the rows are numbered, so that equal ones are spread as well.
    """
    value = F.col(col).cast("string")
    rows = df.withColumn("block", _block_of(value, _blocks(m)))
    hot = hot_keys(rows, "block") if hot is None else hot
    if hot:
        rows = materialise(rows, "probed").withColumn("_row", F.monotonically_increasing_id())
    met = salted_join(rows, blocks, "block", "left", hot=hot)
    is_set = F.lit(True)
    for i, mask in enumerate(_lane_masks(value)):
        is_set = is_set & (F.coalesce(f"w{i}", F.lit(0).cast("bigint")).bitwiseAND(mask) != 0)
    return met.withColumn("maybe", F.when(F.col(col).isNotNull(), is_set)).select(*df.columns, "maybe")
