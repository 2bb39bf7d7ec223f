"""Registered queries over message streams, on whole tables and as stream jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.hashing import bloom_bits as bits_of
from tidemark.functions.hashing import bloom_sizing as sizing_of
from tidemark.functions.hashing import java_hash as hash_of
from tidemark.operators import bloom, reservoir
from tidemark.plans.oracle_views import MESSAGES, TAGS, java_hash_sql
from tidemark.session import scratch_dir
from tidemark.sources import adapters
from tidemark.sources.readers import read_messages_stream
from tidemark.sources.sinks import write_arrivals
from tidemark.streaming import jobs

K = reservoir.CAPACITY


def _draw():
    """A draw that other engines can repeat."""
    return (F.col("seq") * 2654435761 + 42) % 4294967296


def _messages(spark, sf_dir):
    """[seq, len, tags]"""
    return adapters.message_lengths(spark, sf_dir).select("seq", "len", "tags")


def java_hash(spark, sf_dir):
    tags = adapters.message_tags(spark, sf_dir).select("tag").distinct()
    return tags.select("tag", hash_of(F.col("tag")).alias("h"))


def bloom_bits(spark, sf_dir):
    tags = adapters.message_tags(spark, sf_dir).select("tag").distinct()
    bits = bits_of(F.col("tag"))
    return tags.select("tag", bits[0].alias("h1"), bits[1].alias("h2"), bits[2].alias("h3"))


def bloom_sizing(spark, sf_dir):
    m = 1 << 14
    n = adapters.message_tags(spark, sf_dir).agg(F.countDistinct("tag").alias("n"))
    k, rate = sizing_of(F.col("n"), m)
    return n.select("n", k.alias("k"), F.round(rate, 9).alias("fpp"))


def bloom_replay(spark, sf_dir):
    return bloom.bloom_replay(adapters.message_tags(spark, sf_dir))


def bloom_replay_wide(spark, sf_dir):
    """A filter of many bits with 64-bit hashes, against the truth."""
    flags = bloom.bloom_replay(adapters.message_tags(spark, sf_dir), m=1 << 20, k=7, family="xxhash")
    return flags.groupBy("maybe", "seen").agg(F.count("*").alias("n"))


def bloom_wide_checks(spark, sf_dir):
    """What holds for any filter: a tag seen before is never called new."""
    flags = bloom.bloom_replay(adapters.message_tags(spark, sf_dir), m=1 << 20, k=7, family="xxhash")
    return flags.agg(
        F.count("*").alias("tags"), F.count_if(F.col("seen") & ~F.col("maybe")).alias("missed"),
        F.count_if(F.col("seen")).alias("seen"),
    )


def exact_seen(spark, sf_dir):
    return bloom.really_seen(adapters.message_tags(spark, sf_dir)).select("seq", "tag", "seen")


def bloom_confusion(spark, sf_dir):
    return bloom.bloom_confusion(bloom.bloom_replay(adapters.message_tags(spark, sf_dir)))


def bloom_report(spark, sf_dir):
    report = bloom.bloom_report(bloom.bloom_replay(adapters.message_tags(spark, sf_dir)))
    return report.withColumn("expected_fpp", F.round("expected_fpp", 6))


def _named_customers(spark, sf_dir):
    nation = adapters.table(spark, sf_dir, "nation")
    customer = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    region = adapters.table(spark, sf_dir, "region")
    wanted = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name = 'ASIA'")
    return named, bloom.bloom_build(wanted, "n_name")


def bloom_build(spark, sf_dir):
    return bloom.bloom_build(adapters.table(spark, sf_dir, "customer"), "c_mktsegment")


def bloom_probe(spark, sf_dir):
    """Customers whose nation may lie in Asia."""
    named, words = _named_customers(spark, sf_dir)
    return bloom.bloom_probe(named, "n_name", words)


def bloom_probe_joined(spark, sf_dir):
    """The same with the filter joined by word, as for filters too large to broadcast."""
    named, words = _named_customers(spark, sf_dir)
    return bloom.bloom_probe(named, "n_name", words, max_broadcast_bits=0)


def bloom_block_checks(spark, sf_dir):
    """A filter in blocks over the even order keys, probed with all of them: none is missed, and the rate of false
    alarms is within 1.5 of the formula (and three standard deviations)."""
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderkey")
    even = orders.where("o_orderkey % 2 = 0")
    m = 6 * even.count()
    found = bloom.block_probe(orders, "o_orderkey", bloom.block_build(even, "o_orderkey", m), m)
    inside = F.col("o_orderkey") % 2 == 0
    _, rate = sizing_of(F.count_if(inside), m, bloom.LANES)
    alarms, outside = F.count_if(~inside & F.col("maybe")), F.count_if(~inside)
    return found.agg(
        F.count("*").alias("orders"),
        F.count_if(inside & ~F.col("maybe")).alias("missed"),
        (alarms <= 1.5 * rate * outside + 3 * F.sqrt(rate * outside)).alias("rate_holds"),
    )


def arrival_number(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events").select("event_id", "ts")
    return reservoir.arrival_number(events, "ts", "event_id").select("event_id", "n")


def reservoir_sample(spark, sf_dir):
    sample = reservoir.reservoir_sample(_messages(spark, sf_dir), K, _draw())
    return sample.select("slot", "seq", "len")


def reservoir_literal(spark, sf_dir):
    sample = reservoir.reservoir_sample(_messages(spark, sf_dir), K, _draw(), mode="literal")
    return sample.select("slot", "seq", "len")


def _entered(spark, sf_dir):
    return reservoir.accepted(_messages(spark, sf_dir), K, _draw())


def reservoir_replaced(spark, sf_dir):
    return reservoir.replaced_message(_entered(spark, sf_dir)).select("seq", "slot", "prev_seq")


def reservoir_length(spark, sf_dir):
    return reservoir.running_length_sum(_entered(spark, sf_dir))


def _report_text(report):
    return report.withColumn("top_tags", F.array_join("top_tags", " ")).withColumn("avg_len", F.round("avg_len", 6))


def reservoir_snapshot(spark, sf_dir):
    return _report_text(reservoir.reservoir_snapshot(_messages(spark, sf_dir), K, _draw()))


def reservoir_snapshot_last(spark, sf_dir):
    return _report_text(reservoir.reservoir_snapshot(_messages(spark, sf_dir), K, _draw(), every="batch"))


def avg_text_length(spark, sf_dir):
    turns = adapters.table(spark, sf_dir, "conversations")
    return reservoir.avg_text_length(turns, "text").withColumn("avg_len", F.round("avg_len", 6))


def tag_counts(spark, sf_dir):
    """Tags that entered the reservoir less those that left it."""
    entered = _entered(spark, sf_dir)
    added = entered.select(F.explode("tags").alias("tag"), F.lit(1).alias("sign"))
    held = reservoir.latest_per_slot(entered).select("seq")
    evicted = entered.join(held, "seq", "left_anti")
    removed = evicted.select(F.explode("tags").alias("tag"), F.lit(-1).alias("sign"))
    return reservoir.positive_tags(reservoir.tag_counts(added.unionByName(removed)))


def top_tags(spark, sf_dir):
    tags = adapters.message_tags(spark, sf_dir).select("tag", F.lit(1).alias("sign"))
    return reservoir.top_tags(reservoir.tag_counts(tags))


def _event_stream(spark, sf_dir):
    """The events as a stream of several micro-batches, in their order, as messages would arrive."""
    events = adapters.table(spark, sf_dir, "events")
    path = scratch_dir(spark, "events")
    return read_messages_stream(spark, path, events.schema, max_files=write_arrivals(events, path, "event_id"))


def stream_reservoir(spark, sf_dir):
    """The reservoir as a stream job; the texts are joined to the k messages it holds."""
    state = scratch_dir(spark, "reservoir")
    stream = adapters.tags_of(_event_stream(spark, sf_dir))
    query = jobs.reservoir_stream(stream, state, f"{state}/offsets", K, _draw())
    held = jobs.reservoir_state(spark, state, jobs.last_batch(query))
    documents = adapters.table(spark, sf_dir, "documents")
    lengths = adapters.with_text(held, documents, adapters.text_length(), "len").select("seq", "len")
    return held.select("slot", "seq").join(lengths, "seq")


def _tag_stream(spark, sf_dir):
    return adapters.tags_of(_event_stream(spark, sf_dir)).select("seq", F.explode("tags").alias("tag"))


def stream_bloom(spark, sf_dir):
    state = scratch_dir(spark, "bloom")
    jobs.last_batch(jobs.bloom_stream(_tag_stream(spark, sf_dir), state, f"{state}/offsets"))
    return jobs.stream_flags(spark, state).select("seq", "tag", "maybe", "seen")


def stream_exact_seen(spark, sf_dir):
    state = scratch_dir(spark, "seen")
    jobs.last_batch(jobs.exact_seen_stream(_tag_stream(spark, sf_dir), state, f"{state}/offsets"))
    return jobs.stream_flags(spark, state, "seen").select("seq", "tag", "seen")


def stream_report(spark, sf_dir):
    """The per-batch report; the length of a message is that of its properties text."""
    state = scratch_dir(spark, "report")
    events = _event_stream(spark, sf_dir).withColumn("len", F.length("props").cast("bigint"))
    tagged = adapters.tags_of(events, "len")
    query = jobs.write_stream_report(tagged, state, f"{state}/reports", f"{state}/offsets", K, _draw())
    last = jobs.last_batch(query)
    reports = spark.read.parquet(f"{state}/reports").where(F.col("batch") == last)
    return _report_text(reports.select("n", "top_tags", "avg_len"))


QUERIES = {
    f.__name__: f
    for f in (
        java_hash, bloom_bits, bloom_sizing, bloom_replay, bloom_replay_wide, bloom_wide_checks, exact_seen, bloom_confusion,
        bloom_report, bloom_build, bloom_probe, bloom_probe_joined, bloom_block_checks, arrival_number, reservoir_sample,
        reservoir_literal, reservoir_replaced, reservoir_length, reservoir_snapshot,
        reservoir_snapshot_last, avg_text_length, tag_counts, top_tags, stream_reservoir, stream_bloom,
        stream_exact_seen, stream_report,
    )
}

# The remainders of the three hash functions.
_H1 = "abs(h % 100)"
_H2 = "(abs(h % 50) + abs(h % 51))"
_H3 = "(abs(h % 25) + abs(h % 76))"


def _positions(name, source, column):
    """[tag, b]: bit positions of the distinct values of a column."""
    return f"""{name}_hash AS (SELECT tag, {java_hash_sql('tag')} AS h FROM (SELECT DISTINCT {column} AS tag FROM {source})),
{name} AS (SELECT tag, unnest([{_H1}, {_H2}, {_H3}]) AS b FROM {name}_hash)"""


_REPLAY = f"""WITH {TAGS},
{_positions('positions', 'tags', 'tag')},
firsts AS (SELECT tag, min(seq) AS first FROM tags GROUP BY tag),
set_at AS (SELECT b, min(first) AS first FROM positions JOIN firsts USING (tag) GROUP BY b),
maybe_after AS (SELECT p.tag, max(s.first) AS after FROM positions p JOIN set_at s USING (b) GROUP BY p.tag),
flags AS (SELECT t.seq, t.tag, a.after < t.seq AS maybe, f.first < t.seq AS seen
          FROM tags t JOIN maybe_after a USING (tag) JOIN firsts f USING (tag))"""
_COUNTERS = """count(*) FILTER (maybe AND seen) AS tp, count(*) FILTER (NOT maybe AND NOT seen) AS tn,
       count(*) FILTER (maybe AND NOT seen) AS fp, count(*) AS total"""


def _entered_sql(arrivals):
    return f"""WITH {MESSAGES},
drawn AS (SELECT seq, body_len AS len,
          CASE WHEN seq <= {K} THEN seq - 1 ELSE ((seq * 2654435761 + 42) % 4294967296) % {arrivals} END AS slot
          FROM messages),
entered AS (SELECT * FROM drawn WHERE slot < {K}),
held AS (SELECT slot, max(seq) AS seq, arg_max(len, seq) AS len FROM entered GROUP BY slot)"""


_ENTERED = _entered_sql("seq")
_SNAPSHOTS = f"""{_ENTERED}, {TAGS},
spans AS (SELECT *, lead(seq) OVER (PARTITION BY slot ORDER BY seq) AS gone FROM entered),
alive AS (SELECT s.seq AS n, e.seq, e.len FROM entered s JOIN spans e
          ON e.seq <= s.seq AND (e.gone IS NULL OR e.gone > s.seq) WHERE s.seq > {K}),
counts AS (SELECT a.n, t.tag, count(*) AS c FROM alive a JOIN tags t ON t.seq = a.seq GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY c DESC, tag) AS r FROM counts),
shown AS (SELECT n, string_agg(tag || ':' || CAST(c AS VARCHAR), ' ' ORDER BY r) AS top_tags FROM ranked WHERE r <= 5 GROUP BY n)
SELECT a.n, any_value(s.top_tags) AS top_tags, round(avg(a.len), 6) AS avg_len
FROM alive a JOIN shown s ON s.n = a.n GROUP BY a.n"""


def _last_snapshot(text_length):
    return f"""WITH {TAGS},
lengths AS ({text_length}),
drawn AS (SELECT seq, len, CASE WHEN seq <= {K} THEN seq - 1
          ELSE ((seq * 2654435761 + 42) % 4294967296) % seq END AS slot FROM lengths),
held AS (SELECT slot, max(seq) AS seq, arg_max(len, seq) AS len FROM drawn WHERE slot < {K} GROUP BY slot),
counts AS (SELECT tag, count(*) AS c FROM held JOIN tags USING (seq) GROUP BY tag),
ranked AS (SELECT *, row_number() OVER (ORDER BY c DESC, tag) AS r FROM counts)
SELECT (SELECT max(seq) FROM held) AS n, (SELECT round(avg(len), 6) FROM held) AS avg_len,
       string_agg(tag || ':' || CAST(c AS VARCHAR), ' ' ORDER BY r) AS top_tags
FROM ranked WHERE r <= 5"""


_DOCUMENT_LENGTHS = """SELECT m.event_id + 1 AS seq, length(d.text) AS len
  FROM (SELECT event_id, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events) m
       JOIN documents d ON m.doc_id = d.doc_id"""
_PROBE = f"""WITH wanted AS (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
{_positions('filter_bits', 'wanted', 'n_name')},
{_positions('probe_bits', 'nation', 'n_name')},
answers AS (SELECT tag, bool_and(b IN (SELECT b FROM filter_bits)) AS maybe FROM probe_bits GROUP BY tag)
SELECT c.c_custkey, n.n_name, a.maybe
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN answers a ON a.tag = n.n_name"""

ORACLE = {
    "java_hash": f"WITH {TAGS} SELECT tag, {java_hash_sql('tag')} AS h FROM (SELECT DISTINCT tag FROM tags)",
    "bloom_bits": f"""WITH {TAGS},
hashed AS (SELECT tag, {java_hash_sql('tag')} AS h FROM (SELECT DISTINCT tag FROM tags))
SELECT tag, {_H1} AS h1, {_H2} AS h2, {_H3} AS h3 FROM hashed""",
    "bloom_sizing": f"""WITH {TAGS}, n AS (SELECT count(DISTINCT tag) AS n FROM tags),
k AS (SELECT n, CAST(ceil(16384.0 / n * ln(2)) AS INTEGER) AS k FROM n)
SELECT n, k, round(pow(1 - exp(-k * n / 16384.0), k), 9) AS fpp FROM k""",
    "bloom_replay": f"{_REPLAY} SELECT seq, tag, maybe, seen FROM flags",
    "exact_seen": f"{_REPLAY} SELECT seq, tag, seen FROM flags",
    "bloom_confusion": f"{_REPLAY} SELECT seq, {_COUNTERS} FROM flags GROUP BY seq",
    "bloom_report": f"""{_REPLAY}, totals AS (SELECT {_COUNTERS} FROM flags)
SELECT *, tn + fp AS keys, CAST(ceil(100.0 / (tn + fp) * ln(2)) AS INTEGER) AS best_k,
       round(pow(1 - exp(-3 * (tn + fp) / 100.0), 3), 6) AS expected_fpp FROM totals""",
    "bloom_build": f"""WITH {_positions('positions', 'customer', 'c_mktsegment')}
SELECT b // 32 AS word, bit_or(1::BIGINT << (b % 32)::INTEGER) AS bits FROM positions GROUP BY 1""",
    "bloom_probe": _PROBE,
    "bloom_probe_joined": _PROBE,
    "bloom_block_checks": "SELECT count(*) AS orders, CAST(0 AS BIGINT) AS missed, true AS rate_holds FROM orders",
    "arrival_number": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events",
    "reservoir_sample": f"{_ENTERED} SELECT slot, seq, len FROM held",
    "reservoir_literal": f"{_entered_sql('(seq - 1)')} SELECT slot, seq, len FROM held",
    "reservoir_replaced": f"""{_ENTERED}
SELECT seq, slot, lag(seq) OVER (PARTITION BY slot ORDER BY seq) AS prev_seq FROM entered""",
    "reservoir_length": f"""{_ENTERED},
changes AS (SELECT seq, len - coalesce(lag(len) OVER (PARTITION BY slot ORDER BY seq), 0) AS change FROM entered)
SELECT seq, CAST(sum(change) OVER (ORDER BY seq) AS BIGINT) AS total_len FROM changes""",
    "reservoir_snapshot": _SNAPSHOTS,
    "reservoir_snapshot_last": _last_snapshot(_DOCUMENT_LENGTHS),
    "avg_text_length": "SELECT round(avg(length(text)), 6) AS avg_len FROM conversations",
    "tag_counts": f"{_ENTERED}, {TAGS} SELECT tag, count(*) AS n FROM held JOIN tags USING (seq) GROUP BY tag",
    "top_tags": f"""WITH {TAGS}, counts AS (SELECT tag, count(*) AS n FROM tags GROUP BY tag)
SELECT CAST(row_number() OVER (ORDER BY n DESC, tag) AS INTEGER) AS rank, tag, n FROM counts
ORDER BY n DESC, tag LIMIT 5""",
    "stream_reservoir": f"{_ENTERED} SELECT slot, seq, len FROM held",
    "bloom_wide_checks": f"""WITH {TAGS}
SELECT count(*) AS tags, CAST(0 AS BIGINT) AS missed, count(*) - count(DISTINCT tag) AS seen FROM tags""",
    "stream_bloom": f"{_REPLAY} SELECT seq, tag, maybe, seen FROM flags",
    "stream_exact_seen": f"{_REPLAY} SELECT seq, tag, seen FROM flags",
    "stream_report": _last_snapshot("SELECT event_id + 1 AS seq, length(props) AS len FROM events"),
}
