"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to features; document frequencies are counted over all documents. The benchmark's
passages, weighted by them, span the latent space: a randomised SVD with power iterations,
whose products over passages run in Spark tasks, finds its directions. Every document is cut
into overlapping windows of words, each window is folded into the space and multiplied with the unit vectors
of all benchmark passages. A pair is a candidate from a share of what a verbatim copy of the passage has in its best
window, however it lies to the windows; so short passages are found among any other words and long ones by their parts.
The cosine, in which what the space can't express of a window counts into its length, is reported. Around each candidate, the longest common subsequence of
words with the passage decides, and for looser matches also whether the words of the
item's answer are there, so that reordered or reworded copies are found. An item is reported when any of
its passages is there, with the figures of the best one.

The search reads each document once, in place, and compares windows with a stated set of queries in
blocks; nothing is exchanged by document. The benchmark is cut into parts of at most RANK passages, each with
a space of its own that holds all of them whole, so a copy loses nothing however many passages there are. A task
holds about PARTS parts at one time, and item texts up to `MAX_QUERY_BYTES`; larger benchmarks are searched block by
block.

Defined results: documents and items without words match nothing. Every row is searched, so
repeated rows and rows with equal or null ids are reported one by one. Items with equal texts are
all reported. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import giving_back, per_text, text_slices
from tidemark.operators.skew import number_rows
from tidemark.session import materialise

FEATURES = 1 << 17
# Passages that share a space, which has as many directions; parts that a task holds at one time.
RANK = 208
PARTS = 16
OVERSAMPLING = 16
POWER = 2
# Words of a window and between the beginnings of two windows.
HOP = 16
WINDOW = 2 * HOP
# Longest passage of an item; longer items are several.
PASSAGE = 64
# Share of a verbatim copy's product from which a window is a candidate; below LOOSE, as words lost can weigh more.
LEAST = 0.3
# Share of a passage's words in order, alone and together with that of its answer's words.
VERBATIM, LOOSE, ANSWER = 0.7, 0.5, 0.8
# One, but for rounding.
ENOUGH = 1 - 1e-4
MAX_QUERY_BYTES = 64 << 20
# Bytes of text whose words a task holds at a time.
SLICE = 1_000_000

_SENTENCE = re.compile(r"[.!?\n]+")

def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts in one array, number of words of each.

    A word is what a run without blanks holds of letters and digits, lower-cased; its id is a 32-bit
    hash. Each distinct run of a slice is hashed once.
    """
    runs = pc.ascii_split_whitespace(texts)
    coded = runs.flatten().dictionary_encode()
    words = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{N}]+", "")
    hashes = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint32)
    at = coded.indices.to_numpy()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[at]
    return hashes[at[real]], per_text(real, pc.list_value_length(runs).to_numpy())


def _feature(ids: np.ndarray) -> np.ndarray:
    return (ids & np.uint32(FEATURES - 1)).astype(np.int64)


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weight of each feature from the number of documents that hold it.

    Counts are summed per task, then per feature; FEATURES numbers reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for _, texts in text_slices(batch.column(0), SLICE):
                ids, counts = words_of(texts)
                owner = np.repeat(np.arange(len(counts)), counts)
                held = np.unique(owner * FEATURES + _feature(ids))
                total += np.bincount(held % FEATURES, minlength=FEATURES)
                n += len(texts)
        found = np.nonzero(total)[0]
        # Feature -1 counts the documents themselves.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(total[found], n))], names=["feature", "n"]
        )

    per_task = docs.select(F.col(text_col).alias("text")).mapInArrow(giving_back(count), "feature long, n long")
    rows = per_task.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    n_all = int(rows.loc[rows["feature"] == -1, "n"].sum())
    counts = np.zeros(FEATURES)
    real = rows[rows["feature"] >= 0]
    counts[real["feature"].to_numpy(dtype=np.int64)] = real["n"].to_numpy(dtype=float)
    return np.log((1 + n_all) / (1 + counts)).astype(np.float32) + np.float32(0.01)


def _passages(ids: np.ndarray) -> list[np.ndarray]:
    """Passages of an item of even lengths, each overlapping the next by half."""
    if len(ids) <= PASSAGE:
        return [ids] if len(ids) else []
    half = PASSAGE // 2
    return [ids[a : a + PASSAGE] for a in range(0, len(ids) - half, half)]


def benchmark_passages(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """[item, words, whole, answer]: word ids of every passage; `whole` tells items apart, the answer is that of the item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"item": [], "words": [], "answer": [], "whole": []}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                # An answer follows the question; without one the last sentence stands for it.
                asked = text.rpartition("?")
                sentences = [s for s in _SENTENCE.split(text) if s.strip()]
                answer = asked[2] if asked[1] and asked[2].strip() else (sentences or [""])[-1]
                whole = words_of(pa.array([text], pa.large_string()))[0]
                own = words_of(pa.array([answer], pa.large_string()))[0]
                key = hashlib.blake2b(whole.tobytes(), digest_size=16).digest()
                for passage in _passages(whole):
                    out["item"].append(item)
                    out["whole"].append(key)
                    for name, value in (("words", passage), ("answer", own)):
                        out[name].append(value.astype(np.int64).tolist())
            longs = pa.list_(pa.int64())
            types = {"item": pa.int64(), "words": longs, "answer": longs, "whole": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], names=list(types))

    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    schema = "item long, words array<long>, answer array<long>, whole binary"
    return materialise(rows.mapInArrow(split, schema), "passages")


def _signs(features: np.ndarray, width: int) -> np.ndarray:
    """Rows of the random test matrix: +-1 by a hash of feature and column."""
    x = features.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(width, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.where((x >> np.uint64(63)) > 0, 1.0, -1.0)


def _weighted(words: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a passage and its unit vector of TF-IDF weights."""
    features, counts = np.unique(_feature(np.array(words, dtype=np.uint32)), return_counts=True)
    weights = counts * idf[features].astype(float)
    return features, weights / np.linalg.norm(weights)


def verbatim_product(words: list[int], idf: np.ndarray) -> float:
    """Least product of a passage's unit vector with the best window of a copy, over all places of block borders."""
    own = _feature(np.array(words, dtype=np.uint32))
    features, unit = _weighted(words, idf)
    products = []
    for shift in range(HOP):
        # A word counts once per block.
        block, feature = np.divmod(np.unique((np.arange(len(own)) + shift) // HOP * FEATURES + own), FEATURES)
        sums = np.bincount(block, idf[feature] * unit[np.searchsorted(features, feature)])
        products.append((sums[:-1] + sums[1:]).max() if len(sums) > 1 else sums[0])
    return float(min(products))


def latent_space(passages: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Features that the passages hold, and their rows of the right singular vectors.

    Each product A'(A Q) is a pass over the passages: tasks multiply and add up their rows, sums per
    feature are made by Spark. At most FEATURES * (rank + OVERSAMPLING) numbers reach the driver, which
    orthonormalises them.
    """
    spark = passages.sparkSession
    width = rank + OVERSAMPLING
    features, basis = None, None
    for _ in range(1 + POWER):
        known = spark.sparkContext.broadcast((idf, features, basis))

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, own, held = known.value
            for batch in batches:
                rows = [_weighted(w, weights) for w in batch.column(0).to_pylist()]
                if not rows:
                    continue
                here = np.unique(np.concatenate([f for f, _ in rows]))
                part = _signs(here, width) if held is None else held[np.searchsorted(own, here)]
                total = np.zeros((len(here), width))
                for f, x in rows:
                    at = np.searchsorted(here, f)
                    total[at] += x[:, None] * (x @ part[at])
                vectors = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(here), vectors], names=["feature", "v"])

        def add(table: pa.Table) -> pa.Table:
            keys, at = np.unique(table.column("feature").to_numpy(), return_inverse=True)
            total = np.zeros((len(keys), width))
            np.add.at(total, at, table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width))
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
            return pa.table({"feature": keys, "v": vectors})

        parts = passages.select("words").mapInArrow(product, "feature long, v array<double>")
        blocks = parts.groupBy((F.col("feature") % 256).alias("block"))
        summed = blocks.applyInArrow(add, "feature long, v array<double>").orderBy("feature").toArrow()
        features = summed.column("feature").to_numpy()
        matrix = summed.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
        # Orthonormal directions by falling strength; those without any are left out.
        u, s, _ = np.linalg.svd(matrix, full_matrices=False)
        basis = u[:, s > 1e-9 * max(s[0], 1e-300)]
        if basis.shape[1] < width:
            basis = np.concatenate([basis, np.zeros((len(basis), width - basis.shape[1]))], axis=1)
    return features, basis[:, :rank]


@dataclass
class Index:
    """What a task needs to search: bounded by FEATURES * RANK numbers and the queries."""

    idf: np.ndarray
    rows: np.ndarray  # row of `basis` of each feature, -1 without one
    basis: np.ndarray
    queries: np.ndarray  # passages x rank, unit vectors divided by `least`
    least: np.ndarray  # product from which a window is a candidate of each passage
    most: np.ndarray  # of each feature, its largest share of `least` in a window
    items: list  # item id of each passage
    words: list[list[int]]
    whole: list[bytes]
    answers: list[set]


def _index(own: DataFrame, idf: np.ndarray) -> Index:
    """Index over at most RANK passages, which lie in their space with all of their weight."""
    listed = own.orderBy("item", "words").toArrow().to_pylist()
    features, basis = latent_space(own, idf)
    rows = np.full(FEATURES, -1, dtype=np.int32)
    rows[features] = np.arange(len(features))
    queries = np.zeros((len(listed), basis.shape[1]))
    for q, row in enumerate(listed):
        f, x = _weighted(row["words"], idf)
        queries[q] = x @ basis[rows[f]]
    least = LEAST * np.array([verbatim_product(row["words"], idf) for row in listed])
    most = np.zeros(FEATURES, dtype=np.float32)
    for row, enough in zip(listed, least, strict=True):
        f, x = _weighted(row["words"], idf)
        most[f] = np.maximum(most[f], idf[f] * x / enough)
    return Index(
        idf,
        rows,
        basis.astype(np.float32),
        (queries / least[:, None]).astype(np.float32),
        least,
        most,
        [row["item"] for row in listed],
        [row["words"] for row in listed],
        [row["whole"] for row in listed],
        [set(row["answer"]) for row in listed],
    )


def build_index(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id"
) -> Iterator[list[Index]]:
    """Indexes over the parts of the benchmark, block by block; all passages of an item are in one block."""
    idf = inverse_frequencies(docs, text_col)
    passages = benchmark_passages(items, item_col, "text")
    sizes = F.sum(F.size("words") + F.size("answer"))
    n, size = passages.agg(F.count("*"), sizes).first()
    if not n:
        yield []
        return
    blocks = 1 + max(n // (PARTS * RANK), 8 * size // MAX_QUERY_BYTES)
    dealt = passages.withColumn("block", F.pmod(F.xxhash64("item", "whole"), F.lit(blocks)))
    numbered = materialise(number_rows(dealt, "item", "words", within=("block",)), "numbered-passages")
    held = dict(numbered.groupBy("block").agg(F.count("*")).collect())
    for block in sorted(held):
        cuts = range(0, held[block], RANK)
        yield [_index(numbered.where((F.col("block") == block) & (F.col("n") > a) & (F.col("n") <= a + RANK)), idf) for a in cuts]


def common_subsequence(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for word in region:
        hit = places.get(word)
        if hit:
            met = state & hit
            state = ((state + met) | (state - met)) & full
    return len(item) - state.bit_count()


def candidate_windows(
    ids: np.ndarray, counts: np.ndarray, index: Index
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, passage, cosine) of the windows near a passage.

    A window is two neighbouring blocks of HOP words, or the only block of a text. A word counts
    once per block, so a text that repeats one word looks like that word and not like more of it.
    """
    blocks = -(-counts // HOP)
    first_word = np.cumsum(counts) - counts
    first_block = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(len(text)) - np.repeat(first_block, blocks)
    # The words of each block in a row, in the order of their features.
    at = (np.repeat(first_word, blocks) + number * HOP)[:, None] + np.arange(HOP)
    inside = at < np.repeat(first_word + counts, blocks)[:, None]
    feature = np.where(inside, _feature(ids)[np.minimum(at, max(len(ids) - 1, 0))], -1) if len(ids) else at
    feature.sort(axis=1)
    fresh = feature >= 0
    fresh[:, 1:] &= feature[:, 1:] != feature[:, :-1]
    weight = np.where(fresh, index.idf[feature], np.float32(0))
    row = index.rows[feature]
    known = fresh & (row >= 0)
    squares = (weight**2).sum(axis=1)
    shares = np.where(fresh, index.most[feature], np.float32(0)).sum(axis=1)
    # The last block of a longer text lies in the window before it.
    own = np.repeat(blocks, blocks)
    real = np.nonzero((number == 0) | (number < own - 1))[0]
    paired = own[real] > 1
    second = np.where(paired, real + 1, real)
    length = squares[real] + np.where(paired, squares[second], 0)
    # No passage's product is larger than the sum of the largest shares of the window's words.
    near = np.nonzero(shares[real] + np.where(paired, shares[second], 0) >= ENOUGH)[0]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for a in range(0, len(near), 4096):
        windows = near[a : a + 4096]
        left, right = real[windows], second[windows]
        used = np.union1d(left, right)
        folded = np.zeros((len(used), index.basis.shape[1]), dtype=np.float32)
        block, place = np.nonzero(known[used])
        edges = np.nonzero(np.concatenate([[True], block[1:] != block[:-1]]))[0]
        vectors = index.basis[row[used[block], place]]
        vectors *= weight[used[block], place][:, None]
        folded[block[edges]] = np.add.reduceat(vectors, edges, axis=0)
        sums = folded[np.searchsorted(used, left)]
        sums += folded[np.searchsorted(used, right)] * paired[windows][:, None]
        products = sums @ index.queries.T
        w, p = np.nonzero(products >= ENOUGH)
        cosines = products[w, p] * index.least[p] / np.sqrt(length[windows[w]])
        found.append((text[left[w]], number[left[w]] * HOP, p, cosines))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search(texts: pa.Array, indexes: list[Index]) -> list[tuple[int, int | None, float, float, float]]:
    """(text, item, cosine, lcs, answer) of every leak."""
    ids, counts = words_of(texts)
    first_word = np.cumsum(counts) - counts
    leaks: dict[tuple[int, int, int], tuple[float, float, float]] = {}
    for part, index in enumerate(indexes):
        for text, start, passage, cosine in zip(*(x.tolist() for x in candidate_windows(ids, counts, index)), strict=True):
            own = index.words[passage]
            # The passage can begin before the window and end behind it.
            low, high = max(0, start - len(own)), min(int(counts[text]), start + WINDOW + len(own))
            region = ids[first_word[text] + low : first_word[text] + high].tolist()
            lcs = common_subsequence(own, region) / len(own)
            answer = index.answers[passage]
            share = len(answer.intersection(region)) / len(answer) if answer else 1.0
            if lcs >= VERBATIM or (lcs >= LOOSE and share >= ANSWER):
                key = (text, part, passage)
                leaks[key] = max(leaks.get(key, (0.0, 0.0, 0.0)), (lcs, share, cosine))
    best: dict[tuple[int, int | None, bytes], tuple[float, float, float]] = {}
    for (text, part, passage), value in leaks.items():
        key = (text, indexes[part].items[passage], indexes[part].whole[passage])
        best[key] = max(best.get(key, value), value)
    return [(text, item, cosine, lcs, share) for (text, item, _), (lcs, share, cosine) in sorted(best.items(), key=str)]


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """[id, item_id, cosine, lcs, answer]: documents that hold a benchmark item."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def searched(indexes: list[Index]) -> DataFrame:
        known = docs.sparkSession.sparkContext.broadcast(indexes)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in text_slices(batch.column(1), SLICE):
                    leaks = search(texts, known.value)
                    ids = batch.column(0).take(pa.array([first + t for t, *_ in leaks], pa.int64()))
                    columns = [pa.array([x[i] for x in leaks], t) for i, t in ((1, pa.int64()), *((j, pa.float64()) for j in (2, 3, 4)))]
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", "item_id", "cosine", "lcs", "answer"])

        return rows.mapInArrow(find, "id long, item_id long, cosine double, lcs double, answer double")

    return reduce(DataFrame.unionByName, map(searched, build_index(docs, items, text_col, item_col)))


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, all columns unchanged.

    Between the blocks of a large benchmark the rows that are left are written.
    """
    place = docs.columns.index(text_col)

    def without(rows: DataFrame, indexes: list[Index]) -> DataFrame:
        known = docs.sparkSession.sparkContext.broadcast(indexes)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # Rows go back slice by slice: they lie whole in the worker's memory and in that of the JVM.
                for first, texts in text_slices(batch.column(place), SLICE):
                    clean = np.ones(len(texts), dtype=bool)
                    clean[[t for t, *_ in search(texts, known.value)]] = False
                    yield batch.slice(first, len(texts)).filter(pa.array(clean))

        return rows.mapInArrow(giving_back(keep), docs.schema)

    left = None
    for indexes in build_index(docs, items, text_col, item_col):
        left = without(docs if left is None else materialise(left, "without-leaks"), indexes)
    return left
