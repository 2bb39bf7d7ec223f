import math
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import bloom_bits
from tidemark.operators import bloom, reservoir, skew
from tidemark.sources.readers import read_messages_stream
from tidemark.sources.sinks import write_arrivals
from tidemark.streaming import jobs, state


def tag_rows(seed, n=300, hot=True):
    """[(seq, tag)], a third of them with the same tag, some messages repeating a tag."""
    rng = random.Random(seed)
    rows = []
    for seq in range(1, n + 1):
        rows.append((seq, "hot" if hot and rng.random() < 0.33 else f"t{rng.randrange(40)}"))
        if rng.random() < 0.3:
            rows.append((seq, rng.choice([rows[-1][1], f"t{rng.randrange(40)}"])))
    return rows


def sequential_bloom(rows, bits):
    """Flags of a filter that takes a message's tags in after all of them were tested."""
    set_bits, known, flags = set(), set(), []
    for seq in sorted({s for s, _ in rows}):
        tags = [t for s, t in rows if s == seq]
        flags += [(seq, t, set(bits[t]) <= set_bits, t in known) for t in tags]
        for t in tags:
            set_bits |= set(bits[t])
            known.add(t)
    return sorted(flags)


def bits_of(spark, rows, m, k, family):
    tags = spark.createDataFrame([(t,) for t in {t for _, t in rows}], "tag string")
    return {r.tag: r.b for r in tags.select("tag", bloom_bits(F.col("tag"), m, k, family).alias("b")).collect()}


@pytest.mark.parametrize("m,k,family", [(100, 3, "mod"), (64, 2, "xxhash"), (5000, 4, "xxhash")])
def test_bloom_replay_is_the_sequential_filter(spark, m, k, family):
    rows = tag_rows(m)
    df = spark.createDataFrame(rows, "seq bigint, tag string").repartition(4)
    found = sorted(tuple(r) for r in bloom.bloom_replay(df, m, k, family).collect())
    assert found == sequential_bloom(rows, bits_of(spark, rows, m, k, family))


def test_confusion_and_report(spark):
    rows = [(1, True, True), (1, False, False), (2, True, False), (2, True, True)]
    flags = spark.createDataFrame(rows, "seq bigint, maybe boolean, seen boolean")
    found = sorted(tuple(r) for r in bloom.bloom_confusion(flags).collect())
    assert found == [(1, 1, 1, 0, 2), (2, 1, 0, 1, 2)]
    report = bloom.bloom_report(flags).first()
    assert (report.tp, report.tn, report.fp, report.total, report["keys"]) == (2, 1, 1, 4, 2)
    assert report.best_k == 35 and 0 < report.expected_fpp < 1


@pytest.mark.parametrize("limit,hot", [(1 << 26, None), (0, None), (0, ["k3"])])
@pytest.mark.parametrize("m,k,family", [(100, 3, "mod"), (2048, 5, "xxhash")])
def test_probe_has_no_false_negatives(spark, limit, hot, m, k, family):
    inside = spark.range(60).select(F.concat(F.lit("k"), "id").alias("v"))
    words = bloom.bloom_build(inside, "v", m, k, family)
    probe = spark.range(400).select(F.concat(F.lit("k"), "id").alias("v"), "id")
    probe = probe.unionByName(probe.where("id = 3"))
    found = bloom.bloom_probe(probe, "v", words, m, k, family, max_broadcast_bits=limit, hot=hot).collect()
    assert len(found) == 401 and all(r.maybe for r in found if r.id < 60)
    rows = [(0, f"k{i}") for i in range(400)]
    bits = bits_of(spark, rows, m, k, family)
    full = {b for i in range(60) for b in bits[f"k{i}"]}
    assert {(r.v, r.maybe) for r in found} == {(t, set(b) <= full) for t, b in bits.items()}
    holes = spark.createDataFrame([("k1",), (None,), (None,)], "v string")
    kept = bloom.bloom_probe(holes, "v", words, m, k, family, max_broadcast_bits=limit, hot=hot).collect()
    assert sorted((r.v or "", r.maybe) for r in kept) == [("", None), ("", None), ("k1", True)]


@pytest.mark.parametrize("hot", [None, [0, 3]])
def test_block_filter_against_plain_sets(spark, hot):
    """A value may be there exactly if the values of its block have set its bit in every word."""
    m = 5 * bloom.BLOCK_BITS
    probe = spark.range(1500).select(F.concat(F.lit("k"), "id").alias("v"), "id", F.lit(1).alias("block_no"))
    probe = probe.unionByName(probe.where("id = 3"))
    inside = probe.where("id < 400")
    places = probe.select("id", "v", bloom._block_of(F.col("v"), 5).alias("b"), F.array(*bloom._lane_masks(F.col("v"))).alias("m")).distinct()
    bits = {r.v: {(r.b, i, mask) for i, mask in enumerate(r.m)} for r in places.collect()}
    assert all(len({b for b, _, _ in own}) == 1 and all(bin(mask & (2**64 - 1)).count("1") == 1 for _, _, mask in own) for own in bits.values())
    full = set().union(*(bits[f"k{i}"] for i in range(400)))
    found = bloom.block_probe(probe, "v", bloom.block_build(inside, "v", m), m, hot).collect()
    assert len(found) == 1501 and all(r.maybe == (bits[r.v] <= full) for r in found)
    assert all(r.maybe for r in found if r.id < 400)
    alarms = sum(r.maybe for r in found if r.id >= 400)
    rate = (1 - math.exp(-8 * 400 / m)) ** 8
    assert alarms <= 1.5 * rate * 1100 + 3 * math.sqrt(rate * 1100)
    holes = spark.createDataFrame([("k1",), (None,)], "v string")
    kept = bloom.block_probe(holes, "v", bloom.block_build(inside, "v", m), m).collect()
    assert sorted((r.v or "", r.maybe) for r in kept) == [("", None), ("k1", True)]
    none = bloom.block_probe(holes, "v", bloom.block_build(inside.limit(0), "v", m), m).collect()
    assert sorted((r.v or "", r.maybe) for r in none) == [("", None), ("k1", False)]


def draw():
    return (F.col("seq") * 2654435761 + 42) % 4294967296


def sequential_reservoir(n, k, literal=False):
    """(slots, [(arrival, slots after it)] for every replacement)"""
    slots, history = [], []
    for seq in range(1, n + 1):
        if len(slots) < k:
            slots.append(seq)
            continue
        at = (seq * 2654435761 + 42) % 4294967296 % (seq - 1 if literal else seq)
        if at < k:
            slots[at] = seq
            history.append((seq, list(slots)))
    return slots, history


def messages(spark, n):
    tags = F.array(F.concat(F.lit("u"), F.col("id") % 7), F.concat(F.lit("v"), F.col("id") % 3))
    return spark.range(1, n + 1).select(F.col("id").alias("seq"), (F.col("id") % 50).alias("len"), tags.alias("tags"))


@pytest.mark.parametrize("n", [5, 10, 11, 800])
@pytest.mark.parametrize("literal", [False, True])
def test_reservoir_is_the_sequential_one(spark, n, literal):
    mode = "literal" if literal else "uniform"
    found = reservoir.reservoir_sample(messages(spark, n), 10, draw(), mode).orderBy("slot").collect()
    slots, _ = sequential_reservoir(n, 10, literal)
    assert [(r.slot, r.seq) for r in found] == list(enumerate(slots))


def expected_report(n, slots):
    counts = {}
    for seq in slots:
        for t in (f"u{seq % 7}", f"v{seq % 3}"):
            counts[t] = counts.get(t, 0) + 1
    top = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:5]
    return n, [f"{t}:{c}" for t, c in top], sum(s % 50 for s in slots) / len(slots)


def test_snapshots(spark):
    df = messages(spark, 300)
    slots, history = sequential_reservoir(300, 10)
    found = reservoir.reservoir_snapshot(df, 10, draw()).orderBy("n").collect()
    assert [(r.n, r.top_tags, r.avg_len) for r in found] == [expected_report(*h) for h in history]
    last = reservoir.reservoir_snapshot(df, 10, draw(), every="batch").first()
    assert (last.n, last.top_tags, last.avg_len) == expected_report(max(slots), slots)
    short = reservoir.reservoir_snapshot(messages(spark, 4), 10, draw(), every="batch").first()
    assert short.avg_len == 2.5
    entered = reservoir.accepted(df, 10, draw())
    totals = {r.seq: r.total_len for r in reservoir.running_length_sum(entered).collect()}
    assert all(totals[n] == sum(s % 50 for s in kept) for n, kept in history)
    assert reservoir.replaced_message(entered).where("prev_seq is null").count() == 10


def test_default_draw_keeps_about_k_over_n(spark):
    kept = reservoir.reservoir_sample(messages(spark, 20000), 500)
    rows = [r.seq for r in kept.collect()]
    assert len(set(rows)) == 500 and abs(sum(rows) / 500 - 10000) < 1500


def test_tags(spark):
    rows = [("a", 1), ("a", 1), ("b", 1), ("b", -1), ("c", 1)]
    counts = reservoir.tag_counts(spark.createDataFrame(rows, "tag string, sign int"))
    assert [tuple(r) for r in reservoir.top_tags(counts, 5).collect()] == [(1, "a", 2), (2, "c", 1)]


def write_files(df, path, files):
    """Split a table by arrival into one folder of `files` files."""
    total = df.agg(F.max("seq")).first()[0]
    for i in range(files):
        low, high = total * i // files, total * (i + 1) // files
        df.where(f"seq > {low} and seq <= {high}").coalesce(1).write.mode("append").parquet(str(path))


@pytest.mark.parametrize("files", [1, 3, 5])
def test_stream_bloom_for_any_split(spark, tmp_path, files):
    df = spark.createDataFrame(tag_rows(files), "seq bigint, tag string")
    write_files(df, tmp_path / "in", files)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    state = str(tmp_path / "state")
    assert jobs.last_batch(jobs.bloom_stream(stream, state, f"{state}/offsets")) == files - 1
    found = sorted(tuple(r) for r in jobs.stream_flags(spark, state).select("seq", "tag", "maybe", "seen").collect())
    assert found == sorted(tuple(r) for r in bloom.bloom_replay(df).collect())
    seen = str(tmp_path / "seen")
    jobs.last_batch(jobs.exact_seen_stream(stream, seen, f"{seen}/offsets"))
    found = sorted(tuple(r) for r in jobs.stream_flags(spark, seen, "seen").select("seq", "tag", "seen").collect())
    assert found == sorted(tuple(r) for r in bloom.really_seen(df).select("seq", "tag", "seen").collect())


def test_stream_flags_of_odd_rows(spark, tmp_path):
    """Repeated rows, null tags, a tag twice in its first message; as the table operators answer."""
    rows = [(1, "a"), (1, "a"), (1, None), (2, "b"), (2, "a"), (3, None), (3, "b"), (3, "c"), (3, "c")]
    df = spark.createDataFrame(rows, "seq bigint, tag string")
    write_files(df, tmp_path / "in", 3)
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    state = str(tmp_path / "state")
    jobs.last_batch(jobs.bloom_stream(stream, state, f"{state}/offsets", 5000, 4, "xxhash"))
    key = lambda r: (r[0], r[1] or "", r[2:])
    found = sorted(map(tuple, jobs.stream_flags(spark, state).select("seq", "tag", "maybe", "seen").collect()), key=key)
    assert found == sorted(map(tuple, bloom.bloom_replay(df, 5000, 4, "xxhash").collect()), key=key)


def test_memory_is_spark_state_alone(spark, tmp_path):
    """A later batch needs nothing of what earlier ones wrote."""
    df = spark.createDataFrame(tag_rows(9), "seq bigint, tag string")
    source, offsets, found = tmp_path / "in", str(tmp_path / "offsets"), []
    for part in range(3):
        df.where(f"seq > {part * 100} and seq <= {part * 100 + 100}").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(df.schema).parquet(str(source))
        out = str(tmp_path / f"out{part}")
        jobs.last_batch(jobs.bloom_stream(stream, out, offsets))
        found += map(tuple, jobs.stream_flags(spark, out).select("seq", "tag", "maybe", "seen").collect())
    assert sorted(found) == sorted(map(tuple, bloom.bloom_replay(df).collect()))


def test_a_hot_tag_asks_once_per_arrow_batch():
    rows = [(seq, "hot" if seq % 3 else f"t{seq}") for seq in range(1000, 0, -1)]
    seqs, tags = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(tags), pa.array(seqs)], names=["tag", "seq"])
    firsts = pa.Table.from_batches(list(state._with_firsts([batch])))
    assert firsts.num_rows == 1000
    asking = firsts.filter(pc.field("first")).to_pylist()
    assert [r["seq"] for r in asking if r["tag"] == "hot"] == [1]
    probes = pa.RecordBatch.from_pylist(
        [{"tag": r["tag"], "seq": r["seq"], "n": 1, "name": "maybe", "key": "word 0", "place": r["seq"] % 4} for r in asking]
    )
    kept = pa.Table.from_batches(list(state._open_questions([probes]))).to_pylist()
    assert sorted(r["seq"] for r in kept) == [1, 3, 6, 12]


@pytest.mark.parametrize("rows, file_bytes", [(0, 1 << 20), (1, 1 << 20), (5, 1 << 20), (403, 1 << 20), (4000, 3000)])
def test_arrivals_come_range_by_range(spark, tmp_path, rows, file_bytes):
    df = spark.range(rows).select((F.col("id") * 7919 % 4001).alias("seq"), F.col("id").cast("string").alias("tag"))
    path = str(tmp_path / "in")
    files = write_arrivals(df, path, "seq", file_bytes=file_bytes)
    assert files >= min(rows // 4, 2)
    stream = read_messages_stream(spark, path, df.schema, max_files=files)
    batches = {}

    def step(batch, batch_id):
        batches[batch_id] = [r.seq for r in batch.collect()]

    jobs.last_batch(jobs.start(stream, step, str(tmp_path / "offsets")))
    got = [sorted(batches[i]) for i in sorted(batches) if batches[i]]
    assert [s for part in got for s in part] == sorted(r.seq for r in df.collect())
    assert len(got) >= (4 if rows > 100 else -(-rows // 2))
    if file_bytes < 5000:
        assert files > 2


def test_triggers_by_bytes(spark, tmp_path):
    path, sizes = str(tmp_path / "in"), []
    spark.range(4000).repartition(8).write.parquet(path)
    stream = read_messages_stream(spark, path, "id bigint", max_bytes=6000)
    jobs.last_batch(jobs.start(stream, lambda batch, _: sizes.append(batch.count()), str(tmp_path / "offsets")))
    assert sum(sizes) == 4000 and len([n for n in sizes if n]) > 1


def test_streams_go_on_after_a_restart(spark, tmp_path):
    df = messages(spark, 600)
    tags = df.select("seq", F.explode("tags").alias("tag"))
    source, state = tmp_path / "in", str(tmp_path / "state")
    for part in range(3):
        df.where(f"seq > {part * 200} and seq <= {part * 200 + 200}").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(df.schema).parquet(str(source))
        last = jobs.last_batch(jobs.reservoir_stream(stream, state, f"{state}/o1", 10, draw()))
        exploded = stream.select("seq", F.explode("tags").alias("tag"))
        jobs.last_batch(jobs.bloom_stream(exploded, state, f"{state}/o2"))
        report = jobs.write_stream_report(stream, f"{state}/r", f"{state}/reports", f"{state}/o3", 10, draw())
        jobs.last_batch(report)
    assert last == 2
    # A start without new messages leaves the state where it was.
    assert jobs.last_batch(jobs.reservoir_stream(stream, state, f"{state}/o1", 10, draw())) == -1
    again = {r.slot: r.seq for r in jobs.reservoir_state(spark, state).collect()}
    assert again == dict(enumerate(sequential_reservoir(600, 10)[0]))
    held = {r.slot: r.seq for r in jobs.reservoir_state(spark, state, last).collect()}
    assert held == dict(enumerate(sequential_reservoir(600, 10)[0]))
    flags = jobs.stream_flags(spark, state).select("seq", "tag", "maybe", "seen")
    assert sorted(map(tuple, flags.collect())) == sorted(map(tuple, bloom.bloom_replay(tags).collect()))
    reports = spark.read.parquet(f"{state}/reports").orderBy("batch").collect()
    for row, n in zip(reports, (200, 400, 600), strict=True):
        slots = sequential_reservoir(n, 10)[0]
        assert (row.n, row.top_tags, row.avg_len) == expected_report(max(slots), slots)


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("g")).repartition(5)
    found = sorted((r.x, r.n) for r in skew.number_rows(df, "x").collect())
    assert found == [(i, i + 1) for i in range(1000)]
    grouped = skew.number_rows(df, "x", within=("g",)).collect()
    for g in range(3):
        assert [r.n for r in sorted((r for r in grouped if r.g == g), key=lambda r: r.x)] == list(
            range(1, 1 + sum(r.g == g for r in grouped))
        )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_a_join(spark, how):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    assert skew.hot_keys(left, "k", min_rows=100) == ["hot"]
    plain = sorted(map(str, left.join(right, "k", how).select("k", "id", "v").collect()))
    salted = skew.salted_join(left, right, "k", how, hot=["hot"], salts=8).select("k", "id", "v")
    assert sorted(map(str, salted.collect())) == plain
    with pytest.raises(ValueError):
        skew.salted_join(left, right, "k", "outer")
