"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles of similar size, a band, can differ in at most
k = (1 - t) / (1 + t) * (|r| + |s|) features when their Jaccard similarity reaches t. A hash cuts the
domain of features into more than k partitions, so two such sets agree in at least one whole
partition, and the content of a partition is a signature that they share. A set needn't emit all of
its signatures: it keeps the partitions with at least m of its features, m being the largest
number that leaves it k + 1 + e of them. Of two sets, the one with the larger m agrees with the
other in e + 1 of its own partitions, which the other keeps too, so no pair is lost; and hardly a
set keeps an empty partition, in which unrelated sets would agree. A set near the end of
its band also takes part in the next one.

Since similar sets share e + 1 signatures, they still share one when each set leaves out its e most
frequent ones, in one order for all. So a line or passage of very many documents makes
no candidates, and a set with no more than e shared signatures is done.

Exact copies are collapsed to one set first. Signatures travel packed, by hash, to buckets of
bounded size; sets that share one are met inside a batch before anything is exchanged, so a
large group of near copies sends one line per batch and signature. Similarities are then computed
exactly, from the whole sets, in two rounds: every set with the set it shares most signatures
with; then all pairs of different components that share a signature, in cells of bounded size
that give links and not pairs.

Defined results: without words or text the set is empty, links with nothing and is its own
component. With fewer words than a shingle the whole sequence is the one shingle. Rows with a null
id get no component and link with nothing. Rows with equal ids are one vertex. An empty table
gives an empty result. Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import giving_back, text_slices
from tidemark.llm.components import components
from tidemark.operators.bloom import bloom_build, bloom_probe
from tidemark.session import materialise

WORDS = 5
# Similarity from which two sets link, in hundredths.
PERCENT = 80
# Largest size of a band over its smallest.
BAND = 1.6
# Partitions per signature that sets of a band keep at least.
SPARE = 1.1
# Signatures that a bucket is meant to hold.
BUCKET = 1_000_000
# Features of a block of sets that are compared in one go, and columns of a slice of them.
BLOCK = 300_000
FEATURES = 2048
# Sets whose unions with all others of a cell are worked out at a time.
ROWS = 256
# Bytes of text that become words and sets at a time.
SLICE = 1_000_000
# Bits of the filter of wanted ids: 8 MB as an array of words.
FILTER_BITS = 1 << 25
# Signatures that a task holds at once before it packs them.
HELD = 1_000_000

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    hashes = _WordHashes()
    # Of bytes, only A to Z have a lower case, and only the six blanks of ASCII divide words.
    split = [t.encode().lower().split() for t in texts]
    counts = [len(s) for s in split]
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split)), dtype=np.uint64, count=sum(counts))
    multipliers = _mix(np.resize(_MULTIPLIERS, words) + np.arange(words, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(max(0, len(flat) - words + 1), dtype=np.uint64)
    for i in range(words):
        total += flat[i : i + len(total)] * multipliers[i]
    total = _mix(total)
    out, at = [], 0
    for n in counts:
        if n >= words:
            out.append(np.unique(total[at : at + n - words + 1]))
        else:
            # A short sequence as one shingle; its length keeps it apart from all longer ones.
            short = (flat[at : at + n] * multipliers[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(_mix(np.array([short][: min(n, 1)], dtype=np.uint64)))
        at += n
    return out


def set_key(features: np.ndarray) -> int:
    """One number for a whole set."""
    total = _mix(features + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return int(_mix(np.array([total + np.uint64(len(features))], dtype=np.uint64)).view(np.int64)[0])


def bands(largest: int) -> list[tuple[int, int]]:
    """(smallest, largest size) of the bands up to a size."""
    out, low = [], 1
    while low <= largest or not out:
        high = max(low, int(low * BAND))
        out.append((low, high))
        low = high + 1
    return out


def differences(a: int, b: int, percent: int) -> int:
    """Most features in which similar sets of the sizes a and b differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def extra(high: int, percent: int) -> int:
    """Signatures that similar sets of a band up to the size `high` share besides one."""
    return (differences(high, high, percent) + 1) // 5


def signatures(features: np.ndarray, edges: list[tuple[int, int]], percent: int = PERCENT) -> np.ndarray:
    """Signatures of one sorted set in all bands it takes part in.

    Bit 32 tells the two bands of a set apart.
    """
    n = len(features)
    mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(features), dtype=np.uint64)])
    out = []
    first = next(i for i, (_, high) in enumerate(edges) if n <= high)
    for band in (first, first + 1):
        if band >= len(edges) or 100 * n < percent * edges[band][0]:
            break
        high = edges[band][1]
        more = extra(high, percent)
        partitions = max(1, int(SPARE * (differences(high, high, percent) + 1 + more)))
        needed = differences(n, min(high, 100 * n // percent), percent) + 1 + more
        # The partition of a feature is its place in the range of hashes, so it is a run of the set.
        starts = np.arange(partitions + 1, dtype=np.float64) * (2.0**64 / partitions)
        limits = np.minimum(starts, 2.0**64 - 2048).astype(np.uint64)
        places = np.searchsorted(features, limits)
        places[0], places[-1] = 0, n
        counts = np.diff(places)
        least = np.sort(counts)[-needed]
        kept = np.nonzero(counts >= least)[0]
        content = mixed[places[kept + 1]] - mixed[places[kept]]
        name = (np.uint64(band) << np.uint64(40)) + kept.astype(np.uint64)
        mark = _mix(_mix(content) + name * np.uint64(0x9E3779B97F4A7C15) + counts[kept].astype(np.uint64))
        out.append(mark & ~np.uint64(1 << 32) | np.uint64((band & 1) << 32))
    return np.concatenate(out)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first, last, sets) of slices of a batch."""
    for first, texts in text_slices(batch.column(column), SLICE):
        yield first, first + len(texts), shingle_sets(texts.to_pylist())


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, sets in _texts(batch, 1):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                ],
                names=["id", "n", "key"],
            )


_PACKED = "bucket long, sig binary, at binary, keys binary, rep binary"


def _runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of equal values."""
    first = np.nonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))[0]
    return first, np.diff(np.append(first, len(ids)))


def _shared(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (id, key) in order, the smallest key of each id, and which of the ids several keys hold."""
    order = np.lexsort((keys, ids))
    ids, keys = ids[order], keys[order]
    fresh = np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])])[: len(ids)]
    ids, keys = ids[fresh], keys[fresh]
    first, lengths = _runs(ids)
    return ids, keys, np.repeat(keys[first], lengths), np.repeat(lengths > 1, lengths)


def _emit(buckets: int, edges: list[tuple[int, int]]):
    """Signatures of a batch as one packed row per bucket."""

    def pack(bucket: int, ids: np.ndarray, keys: np.ndarray, rep: np.ndarray | None) -> dict:
        names, at = np.unique(keys, return_inverse=True)
        kind = np.uint16 if len(names) <= 1 << 16 else np.uint32
        local = rep is not None
        return {
            "bucket": bucket,
            "sig": (ids if local else ids.astype(np.uint32)).tobytes(),
            "at": at.astype(kind).tobytes(),
            "keys": names.tobytes(),
            "rep": rep.tobytes() if local else None,
        }

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            sigs, keys, held = [], [], 0
            for _, _, sets in _texts(batch, 0):
                for features in sets:
                    key = set_key(features) if len(features) else None
                    if key is None or key in seen:
                        continue
                    seen.add(key)
                    own = signatures(features, edges)
                    sigs.append(own)
                    keys.append(np.full(len(own), key, dtype=np.int64))
                    held += len(own)
                if held >= HELD:
                    yield packed(np.concatenate(sigs), np.concatenate(keys))
                    sigs, keys, held = [], [], 0
            if sigs:
                yield packed(np.concatenate(sigs), np.concatenate(keys))

    def packed(sig: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        # A signature is known by its bucket and 32 more bits; a chance meeting is only one more try.
        ids = (sig % np.uint64(buckets) << np.uint64(32)) + (sig >> np.uint64(32))
        ids, key, rep, shared = _shared(ids, key)
        rows = []
        if shared.any():
            # What meets inside the batch needs no exchange by signature, only a place.
            rows.append(pack(int(ids[0]) % buckets, ids[shared], key[shared], rep[shared]))
        first, _ = _runs(ids)
        ids, key = ids[first], key[first]
        bucket = ids >> np.uint64(32)
        first, lengths = _runs(bucket)
        for a, n in zip(first.tolist(), lengths.tolist(), strict=True):
            rows.append(pack(int(bucket[a]), ids[a : a + n], key[a : a + n], None))
        return pa.RecordBatch.from_pylist(
            rows,
            schema=pa.schema(
                [("bucket", pa.int64()), *((c, pa.binary()) for c in ("sig", "at", "keys", "rep"))]
            ),
        )

    return emit


def _meet(table: pa.Table) -> pa.Table:
    """[sig, rep, key] of the signatures of a bucket that several sets hold."""
    bucket = table.column("bucket")[0].as_py()
    ids, keys, out = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    for row in table.select(["sig", "at", "keys", "rep"]).to_pylist():
        names = np.frombuffer(row["keys"], dtype=np.int64)
        own = names[np.frombuffer(row["at"], dtype=np.uint16 if len(names) <= 1 << 16 else np.uint32)]
        if row["rep"] is None:
            ids.append(np.frombuffer(row["sig"], dtype=np.uint32).astype(np.uint64) + np.uint64(bucket << 32))
            keys.append(own)
        else:
            out.append((np.frombuffer(row["sig"], dtype=np.uint64), np.frombuffer(row["rep"], dtype=np.int64), own))
    sig, key = np.concatenate(ids), np.concatenate(keys)
    if len(sig):
        sig, key, rep, shared = _shared(sig, key)
        out.append((sig[shared], rep[shared], key[shared]))
    return pa.concat_tables(
        pa.table({"sig": s.view(np.int64), "rep": r, "key": k}) for s, r, k in out
    )


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the texts that have the wanted key."""
    for batch in batches:
        for first, last, sets in _texts(batch, 1):
            wanted = batch.column(0).slice(first, last - first).to_pylist()
            kept = [(k, s) for k, s in zip(wanted, sets, strict=True) if len(s) and set_key(s) == k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in kept], pa.int64()), pa.array([s.tobytes() for _, s in kept], pa.binary())],
                names=["key", "features"],
            )


def _are_similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        similar = []
        for left, right in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (left, right))
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            both = 0
            if 100 * len(small) >= PERCENT * len(large):
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            similar.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(similar, pa.bool_())], names=["a", "b", "similar"]
        )


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """[a, b, similar] of pairs of keys."""
    pairs = materialise(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    left = sets.select(F.col("key").alias("a"), F.col("features").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("features").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialise(met.mapInArrow(_are_similar, "a long, b long, similar boolean"), "verified")


def _rarest(shared: DataFrame, classes: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """[sig, rep, key] without the most frequent signatures of each set, as many as it has to spare."""
    frequency = materialise(shared.groupBy("sig").agg(F.count("*").alias("f")), "frequencies")
    highs = F.array(*[F.lit(high) for _, high in edges])
    spare = F.array(*[F.lit(extra(high, PERCENT)) for _, high in edges])
    first = F.size(F.filter(highs, lambda high: high < F.col("n")))
    # Of the set's two bands, the one with the parity of the signature.
    band = first + F.when(first % 2 == F.col("sig") % 2, 0).otherwise(1)
    order = Window.partitionBy("key", F.col("sig") % 2).orderBy(F.desc("f"), "sig")
    ranked = shared.join(frequency, "sig").join(classes.select("key", "n"), "key")
    ranked = ranked.withColumn("rank", F.row_number().over(order))
    kept = materialise(ranked.where(F.col("rank") > F.get(spare, band)).select("sig", "key"), "kept-signatures")
    reps = kept.groupBy("sig").agg(F.min("key").alias("rep"), F.count("*").alias("f")).where("f > 1")
    reps = materialise(reps.select("sig", "rep"), "reps")
    return materialise(kept.join(reps, "sig").select("sig", "rep", "key"), "candidates")


def _unresolved(shared: DataFrame, tree: DataFrame) -> DataFrame:
    """[sig, key, component] of the signatures that several components hold."""
    labelled = shared.join(tree.withColumnRenamed("id", "key"), "key", "left")
    labelled = labelled.select("sig", "key", F.coalesce("component", "key").alias("component"))
    mixed = labelled.groupBy("sig").agg(F.min("component").alias("l"), F.max("component").alias("h"))
    mixed = materialise(mixed.where("l <> h").select("sig"), "mixed")
    return materialise(labelled.join(mixed, "sig"), "unresolved")


def _forests(table: pa.Table) -> pa.Table:
    """[a, b]: each set of a cell that is similar to another, and the first set that it reaches.

    Intersections are counted exactly, over the features that several sets of the cell hold, a
    slice of features at a time.
    """
    keys = table.column("key").to_numpy()
    held = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in table.column("features")]
    sizes = np.array([len(x) for x in held])
    names, column, often = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(held)), sizes)
    place = np.cumsum(often > 1) - 1
    some = often[column] > 1
    row, column = row[some], place[column[some]]
    both = np.zeros((len(held), len(held)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int((often > 1).sum()), FEATURES):
        first, last = np.searchsorted(column, (low, low + FEATURES))
        part = np.zeros((len(held), FEATURES), dtype=np.float32)
        part[row[first:last], column[first:last] - low] = 1
        both += part @ part.T
    pairs = []
    for low in range(0, len(held), ROWS):
        own = both[low : low + ROWS]
        union = sizes[low : low + ROWS, None] + sizes[None, :] - own
        first, second = np.nonzero(np.triu(100 * own >= PERCENT * union, 1 + low))
        pairs.append((first + low, second))
    x, y = (np.concatenate(side) for side in zip(*pairs, strict=True))
    root = np.arange(len(held))
    while True:
        before = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(held))
    return pa.table({"a": keys[moved], "b": keys[root[moved]]})


def _packs(open_sigs: DataFrame, member: DataFrame) -> DataFrame:
    """[family, pack]: families that share open signatures, put together.

    Families linked by open signatures, directly or over others, are one pack if they make no more than a block.
    Where they make more, each family goes with the others of its most common open signature, so
    packs stay among sets that have something in common and are cut into blocks later. If the cells of such
    packs weigh more than those of all blocks of the linked families, as where a large pack meets many small
    ones, the linked families are one pack again.
    """
    seen = open_sigs.select("sig", "key").join(member.select("key", "family"), "key").select("sig", "family").distinct()
    common = seen.groupBy("sig").agg(F.min("family").alias("b"), F.count("*").alias("f")).where("f > 1")
    seen = materialise(seen.join(common, "sig"), "family-signatures")
    tree = components(seen.select(F.col("family").alias("a"), "b"))
    named = member.groupBy("family").agg(F.sum(F.greatest("n", F.lit(BLOCK // 1000))).alias("w"))
    named = named.join(tree.withColumnRenamed("id", "family"), "family", "left")
    named = materialise(named.select("family", "w", F.coalesce("component", "family").alias("linked")), "linked-families")
    sizes = named.groupBy("linked").agg(F.sum("w").alias("all"))
    most = seen.groupBy("family").agg(F.max_by("sig", F.struct("f", "sig")).alias("most"))
    apart = named.join(sizes.where(F.col("all") > BLOCK), "linked").join(most, "family", "left")
    apart = materialise(apart.select("family", "linked", "w", "all", F.coalesce("most", "family").alias("own")), "families-apart")
    cost = _cost_apart(seen.select("sig", "family"), apart)
    apart = apart.join(cost, "linked").select(
        "family", F.when(F.ceil(F.col("all") / BLOCK) * F.col("all") > F.col("cost"), F.col("own")).alias("own")
    )
    packs = named.join(apart, "family", "left")
    return materialise(packs.select("family", F.coalesce("own", "linked").alias("pack")), "packs")


def _cost_apart(seen: DataFrame, apart: DataFrame) -> DataFrame:
    """[linked, cost]: what the cells weigh if the families stay in packs of their own signatures."""
    packs = materialise(apart.groupBy("linked", "own").agg(F.sum("w").alias("w")), "own-packs")
    held = materialise(seen.join(apart, "family").select("sig", "linked", "own").distinct(), "pack-signatures")
    second = held.select("sig", F.col("own").alias("own2"))
    near = held.join(second, "sig").where("own < own2").select("linked", "own", "own2").distinct()
    near = near.join(packs, ["linked", "own"]).join(packs.select("linked", F.col("own").alias("own2"), F.col("w").alias("w2")), ["linked", "own2"])
    pairs = near.select("linked", (F.ceil(F.col("w") / BLOCK) * F.col("w2") + F.ceil(F.col("w2") / BLOCK) * F.col("w")).alias("c"))
    every = packs.select("linked", (F.ceil(F.col("w") / BLOCK) * F.col("w")).alias("c")).unionByName(pairs)
    return materialise(every.groupBy("linked").agg(F.sum("c").alias("cost")), "costs-apart")


def _cells(open_sigs: DataFrame, nearest: DataFrame, classes: DataFrame) -> DataFrame:
    """[cell, key]: the sets of the signatures that several components hold, in cells that are compared as a whole.

    Sets belong to the family of the set they share most signatures with, families are put together into
    packs, and packs are cut into blocks of about BLOCK features, a large component into blocks of its own. A cell is
    a pair of blocks of two packs that share an open signature, unless one component fills both. So every pair of
    different components that shares a signature lies in a cell, no pair is a row, and no cell
    grows with its pack. A group that fits a block is sent once, not once for each of its families.
    """
    member = open_sigs.select("key", "component").distinct().join(nearest.withColumnRenamed("rep", "family"), "key", "left")
    member = member.join(classes.select("key", "n"), "key")
    member = member.select("key", "component", "n", F.coalesce("family", "key").alias("family"))
    member = materialise(member, "open-sets")
    member = member.join(_packs(open_sigs, member), "family").select("key", "component", "n", F.col("pack").alias("family"))
    member = materialise(member, "packed-sets")
    # A small set weighs as much as a thousandth of a block, which bounds the number of sets in a block.
    weight = member.groupBy("family", "component").agg(F.sum(F.greatest("n", F.lit(BLOCK // 1000))).alias("w"))
    weight = materialise(weight, "family-weights")
    small = weight.where(F.col("w") <= BLOCK).groupBy("family").agg(F.sum("w").alias("rest"))
    weight = weight.join(small, "family", "left").withColumn("large", F.col("w") > BLOCK)
    weight = materialise(weight, "weights")
    # The first part of a block's name is its one component, or 0 in a block of small ones.
    parts = F.ceil(F.when(F.col("large"), F.col("w")).otherwise(F.col("rest")) / BLOCK)
    whole = F.when(F.col("large"), F.col("component")).otherwise(F.lit(0).cast("long"))
    spread = F.when(F.col("large"), F.xxhash64("key")).otherwise(F.xxhash64("component"))
    placed = member.join(weight, ["family", "component"]).select(
        "key", "family", "component", whole.alias("whole"), F.pmod(spread, parts).alias("part")
    )
    placed = materialise(placed, "blocks")
    blocks = materialise(placed.select("family", "whole", "part").distinct(), "block-names")
    seen = open_sigs.select("sig", "key").join(placed.select("key", "family"), "key").select("sig", "family").distinct()
    seen = materialise(seen, "families")
    other = seen.withColumnRenamed("family", "f2")
    near = seen.join(other, "sig").where("family <= f2").select("family", "f2").distinct()
    second = blocks.select(F.col("family").alias("f2"), F.col("whole").alias("w2"), F.col("part").alias("p2"))
    cells = materialise(near, "near-families").join(blocks, "family").join(second, "f2")
    cells = cells.where("family < f2 OR whole < w2 OR (whole = w2 AND part <= p2)").where("whole = 0 OR whole <> w2")
    cells = materialise(cells, "cells").withColumn("cell", F.xxhash64("family", "whole", "part", "f2", "w2", "p2"))
    sides = cells.select("cell", "family", "whole", "part").unionByName(
        cells.select("cell", F.col("f2").alias("family"), F.col("w2").alias("whole"), F.col("p2").alias("part"))
    )
    filled = sides.distinct().join(placed.select("key", "family", "whole", "part"), ["family", "whole", "part"])
    return filled.select("cell", "key")


def _open_links(open_sigs: DataFrame, nearest: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links [a, b] among the sets of the signatures that several components hold."""
    filled = _cells(open_sigs, nearest, classes).join(sets, "key")
    links = filled.groupBy("cell").applyInArrow(_forests, "a long, b long")
    return materialise(links.distinct(), "cell-links")


def _maybe_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id has its bit in a filter of the wanted ids, so that few other texts are exchanged.

    The filter has about 16 bits for an id and FILTER_BITS at most; what it lets through in vain, the join drops.
    """
    bits = min(FILTER_BITS, 1 << max(10, (16 * wanted.count()).bit_length()))
    words = bloom_build(wanted, "id", bits, 1, "xxhash")
    return bloom_probe(rows, "id", words, bits, 1, "xxhash").where("maybe").drop("maybe")


def join_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, n_shingles, component] of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = materialise(rows.mapInArrow(giving_back(_describe), "id long, n long, key long"), "sets")
    total = described.agg(F.sum("n").alias("n"), F.max("n").alias("largest")).first()
    if not total["largest"]:
        return described.select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component"))
    edges = bands(total["largest"])
    # About two in five shingles make a signature.
    buckets = max(64, 2 * total["n"] // (5 * BUCKET))
    packed = rows.where("id IS NOT NULL").select("text").mapInArrow(giving_back(_emit(buckets, edges)), _PACKED)
    met = packed.groupBy("bucket").applyInArrow(_meet, "sig long, rep long, key long")
    met = materialise(met, "shared-signatures")
    shared = materialise(
        met.select("sig", "key").unionByName(met.select("sig", F.col("rep").alias("key"))).distinct(), "shared"
    )

    classes = described.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key")
    classes = materialise(classes.agg(F.min("id").alias("rep_id"), F.first("n").alias("n")), "classes")
    met = _rarest(shared, classes, edges)
    shared = met.select("sig", "key")
    wanted = materialise(shared.select("key").distinct().join(classes, "key").select("key", F.col("rep_id").alias("id")), "wanted")
    # An id may stand for several texts, so the key of each text decides.
    sets = _maybe_wanted(rows, wanted).join(wanted, "id").select("key", "text").mapInArrow(giving_back(_whole_sets), "key long, features binary")
    sets = materialise(sets.dropDuplicates(["key"]), "features")

    often = met.where("rep <> key").groupBy("key", "rep").agg(F.count("*").alias("n"))
    nearest = materialise(often.groupBy("key").agg(F.max_by("rep", F.struct("n", "rep")).alias("rep")), "nearest")
    tried = _verify(nearest.select(F.col("rep").alias("a"), F.col("key").alias("b")), sets)
    tree = components(tried.where("similar").select("a", "b"))

    rest = _open_links(_unresolved(shared, tree), nearest, classes, sets)
    tree = components(tried.where("similar").select("a", "b").unionByName(rest))

    # From keys back to ids: the smallest id of each component, then of each row.
    member = tree.select(F.col("id").alias("key"), F.col("component").alias("root"))
    member = member.unionByName(tree.select(F.col("component").alias("key"), F.col("component").alias("root")).distinct())
    named = member.join(classes, "key")
    least = materialise(named.groupBy("root").agg(F.min("rep_id").alias("component")), "least")
    labels = named.join(least, "root").select("key", "component")
    labels = classes.select("key", "rep_id").join(labels, "key", "left").select("key", F.coalesce("component", "rep_id").alias("component"))
    labels = materialise(labels, "labels")
    return described.join(labels, "key", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id; rows with a null id stay."""
    joined = join_sets(docs, id_col, text_col).where("id = component")
    kept = materialise(joined.select(F.col("id").alias(id_col)).distinct(), "kept-ids")
    own = docs.join(kept, id_col, "left_semi")
    # Of rows with one id, which are one vertex, the first in the order of their columns stays.
    others = F.struct(*[c for c in docs.columns if c != id_col])
    # Maps have no order; rows with one are taken in the order of their JSON text.
    plain = "map<" not in docs.schema.simpleString()
    one = own.groupBy(id_col).agg((F.min(others) if plain else F.min_by(others, F.to_json(others))).alias("_row"))
    one = one.select(*[c if c == id_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where(F.col(id_col).isNull()))
