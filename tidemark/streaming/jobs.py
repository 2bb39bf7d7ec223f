"""The stream jobs: reservoir sample, Bloom filter, exact memory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.hashing import bloom_bits
from tidemark.operators import bloom, reservoir
from tidemark.streaming.state import LatestState, answers, met_before, question


def start(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run `step` on every micro-batch. Without a trigger, process what is there and end."""
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def last_batch(query: StreamingQuery) -> int:
    """Wait for the end; the number of the last batch with rows in this run, -1 if there was none."""
    query.awaitTermination()
    return max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=-1)


def reservoir_stream(
    stream: DataFrame,
    state_dir: str,
    checkpoint: str,
    k: int = reservoir.CAPACITY,
    draw: Column | None = None,
    mode: str = "uniform",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a reservoir of [seq, ...] messages; the state has k rows whatever the stream."""
    state = LatestState(f"{state_dir}/reservoir")

    def step(batch: DataFrame, batch_id: int) -> None:
        held = state.before(batch.sparkSession, batch_id)
        entered = reservoir.accepted(batch, k, draw, mode)
        if held is not None:
            entered = held.unionByName(entered)
        state.put(reservoir.latest_per_slot(entered), batch_id)

    return start(stream, step, checkpoint, trigger)


def reservoir_state(spark, state_dir: str, batch_id: int = -1) -> DataFrame:
    """The reservoir after a batch; -1, as after a run without new rows, is the last that exists."""
    state = LatestState(f"{state_dir}/reservoir")
    return state.at(spark, batch_id if batch_id >= 0 else state.last(spark))


def write_stream_report(
    stream: DataFrame,
    state_dir: str,
    report_dir: str,
    checkpoint: str,
    k: int = reservoir.CAPACITY,
    draw: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """One report row [n, top_tags, avg_len] per micro-batch of [seq, len, tags], in a folder
    of its own; read together they also have the column `batch`."""
    state = LatestState(f"{state_dir}/reservoir")
    reports = LatestState(report_dir)

    def step(batch: DataFrame, batch_id: int) -> None:
        arrivals = batch.select("seq", "len", "tags")
        held = state.before(batch.sparkSession, batch_id)
        entered = reservoir.accepted(arrivals, k, draw)
        if held is not None:
            entered = held.unionByName(entered)
        held = state.put(reservoir.latest_per_slot(entered), batch_id)
        reports.put(reservoir.held_report(held), batch_id)

    return start(stream, step, checkpoint, trigger)


def _tag(name: str) -> Column:
    return question(name, F.concat(F.lit("tag "), "tag"), F.lit(0))


def _flag_stream(
    tags: DataFrame, questions: Column, names: tuple[str, ...], out_dir: str, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    out = LatestState(out_dir)

    def step(batch: DataFrame, batch_id: int) -> None:
        out.put(answers(batch, *names), batch_id)

    return start(met_before(tags, questions), step, checkpoint, trigger)


def exact_seen_stream(
    stream: DataFrame, state_dir: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Flag every [seq, tag] with `seen`; the state, kept by Spark, is the first message of each tag."""
    return _flag_stream(stream, F.array(_tag("seen")), ("seen",), f"{state_dir}/seen", checkpoint, trigger)


def bloom_stream(
    stream: DataFrame,
    state_dir: str,
    checkpoint: str,
    m: int = 100,
    k: int = 3,
    family: str = "mod",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Flag every [seq, tag] with `maybe` and `seen`; read them with `stream_flags`.

    The state, kept by Spark, holds the first message of each tag and, by word of the filter, of
    each set bit. A tag may have been met if earlier messages have set all its bits.
    """
    bits = F.transform(
        F.array_distinct(bloom_bits(F.col("tag"), m, k, family)),
        lambda bit: question(
            "maybe", F.concat(F.lit("word "), F.floor(bit / bloom.WORD).cast("string")), bit % bloom.WORD
        ),
    )
    questions = F.concat(F.array(_tag("seen")), bits)
    return _flag_stream(stream, questions, ("maybe", "seen"), f"{state_dir}/flags", checkpoint, trigger)


def stream_flags(spark, state_dir: str, table: str = "flags") -> DataFrame:
    """The flags of all batches so far, with the number of the `batch`."""
    return spark.read.parquet(f"{state_dir}/{table}")
