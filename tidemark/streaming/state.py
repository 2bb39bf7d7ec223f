"""State of a streaming job: first messages of keys in Spark's state store, small tables as folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Groups that rows without a question are dealt out to.
SALTS = 64


class LatestState:
    """A small table that every batch replaces as a whole."""

    def __init__(self, path: str):
        self.path = path

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        return self.at(spark, batch_id - 1) if batch_id else None

    def last(self, spark: SparkSession) -> int:
        """The number of the last batch that was written."""
        return spark.read.parquet(self.path).selectExpr("max(batch)").first()[0]

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/batch={batch_id}")

    def put(self, df: DataFrame, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return self.at(df.sparkSession, batch_id)


def question(name: str, key: Column, place: Column) -> Column:
    """Was this place of this key met in an earlier message?"""
    return F.struct(F.lit(name).alias("name"), key.alias("key"), place.cast("int").alias("place"))


def _with_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct [tag, seq] with their number; `first` marks the first message of each tag in the batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).group_by(["tag", "seq"]).aggregate([([], "count_all")])
        tags = rows.group_by("tag").aggregate([("seq", "min")])
        at = pc.index_in(rows.column("tag"), tags.column("tag"))
        first = pc.equal(rows.column("seq"), tags.column("seq_min").take(at))
        columns = [rows.column("tag"), rows.column("seq"), rows.column("count_all"), pc.and_(first, rows.column("tag").is_valid())]
        yield from pa.table(columns, names=["tag", "seq", "n", "first"]).combine_chunks().to_batches()


def _open_questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without those that an earlier message of the same batch answers."""
    for batch in batches:
        asked = pa.Table.from_batches([batch])
        place = pc.binary_join_element_wise(asked.column("key"), asked.column("place").cast(pa.string()), " ")
        least = pa.table([place, asked.column("seq")], names=["place", "seq"]).group_by("place").aggregate([("seq", "min")])
        at = pc.index_in(place, least.column("place"))
        stays = pc.or_(pc.equal(asked.column("name"), ""), pc.equal(asked.column("seq"), least.column("seq_min").take(at)))
        yield from asked.filter(stays).combine_chunks().to_batches()


def _answer(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state of a key: the first message at each of its places."""
    if key[0].startswith("#"):
        for rows in frames:
            yield rows.assign(before=True)[["tag", "seq", "n", "name", "before"]]
        return
    asked = pd.concat(list(frames), ignore_index=True)
    place, seq = asked["place"].to_numpy(), asked["seq"].to_numpy()
    unset = np.iinfo(np.int64).max
    held = np.array(state.get[0] if state.exists else [], dtype=np.int64)
    firsts = np.full(max(len(held), int(place.max()) + 1), unset)
    firsts[: len(held)] = held
    np.minimum.at(firsts, place, seq)
    if len(firsts) > len(held) or (firsts != held).any():
        state.update((firsts.tolist(),))
    yield asked.assign(before=firsts[place] < seq)[["tag", "seq", "n", "name", "before"]]


def met_before(tags: DataFrame, questions: Column) -> DataFrame:
    """[tag, seq, n, name, before] from a stream of [seq, tag]: answers to an array of questions about each tag.

    Only the first message of a tag in an Arrow batch asks, and of the questions about one place only
    those of the earliest message stay; all others are answered with yes by what is left out here. So a
    tag or a place with most of the messages sends few rows to its group, and the work of a
    batch depends on the batch alone: each group reads and writes the state of its own key. Each distinct
    [tag, seq] also comes once with the name "" and its number of rows.
    """
    rows = tags.select("tag", "seq").mapInArrow(_with_firsts, "tag string, seq bigint, n bigint, first boolean")
    salt = F.concat(F.lit("#"), F.pmod(F.xxhash64("tag", "seq"), F.lit(SALTS)).cast("string"))
    itself = question("", salt, F.lit(0))
    asked = F.explode(F.concat(F.array(itself), F.when(F.col("first"), questions).otherwise(F.array().cast(QUESTIONS))))
    probes = rows.select("tag", "seq", "n", asked.alias("q")).select("tag", "seq", "n", "q.name", "q.key", "q.place")
    fields = "tag string, seq bigint, n bigint, name string, key string, place int"
    return (
        probes.mapInArrow(_open_questions, fields)
        .groupBy("key")
        .applyInPandasWithState(
            _answer,
            "tag string, seq bigint, n bigint, name string, before boolean",
            "firsts array<bigint>",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


QUESTIONS = "array<struct<name:string,key:string,place:int>>"


def answers(found: DataFrame, *names: str) -> DataFrame:
    """[seq, tag, name...] of every row of a batch of `met_before`."""
    asked = [F.coalesce(F.bool_and(F.when(F.col("name") == name, F.col("before"))), F.lit(True)).alias(name) for name in names]
    rows = F.sum(F.when(F.col("name") == "", F.col("n"))).alias("n")
    flags = found.groupBy("tag", "seq").agg(rows, *asked)
    return flags.select("seq", "tag", *names, F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).drop("col")
