"""Language of a text: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, everything that is neither letter nor combining mark becomes one space,
and one space stands before and behind it. Its n-grams of the lengths in `ORDERS` are hashed into
2^`BITS` buckets. Learning counts the buckets of every language over all learning rows: a task
counts in numpy and gives one row per language and bucket, which Spark adds up. The
logarithms of the smoothed shares are kept as whole numbers (`UNIT` steps to the unit), so a score
is an exact sum that doesn't depend on how texts are cut into batches. The matrix of
buckets by languages is broadcast, and a batch is scored as a sparse matrix: the
buckets of its n-grams pick rows, which are added up between the texts' bounds.

At most `LANGUAGES` languages are in one matrix, which bounds it to about 8 MB; more languages are
scored in further passes over the texts, with the same result.

Defined results: a null text and a text without any letter is `und` with score 0, and so is every
text when there is nothing to learn from. Ties go to the language that comes first in order
of code points. Texts are read whole, in pieces of bounded size. Rows with a null language or text, and texts
without letters, teach nothing. Repeated rows count and are answered each on their own; null
ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import text_slices
from tidemark.session import materialise

ORDERS = (1, 2, 3)
BITS = 16
BUCKETS = 1 << BITS
# Steps of a logarithm.
UNIT = 1 << 16
# Languages in one matrix, and those whose counts a task holds before it gives them out.
LANGUAGES = 32
# Cells of the matrix that are picked at once.
CELLS = 1 << 23
# Characters of a text that are hashed at once.
PIECE = 1 << 20
UNKNOWN = "und"
_STEP, _MIX = 1_000_003, 1_540_483_477


def has_letter(texts: pa.Array) -> pa.Array:
    return pc.match_substring_regex(texts.fill_null(""), r"\p{L}")


def plain(texts: pa.Array) -> pa.Array:
    """Lower case, letters and marks only, single spaces, one space at either end."""
    words = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")
    words = pc.utf8_trim(words, " ")
    space = pa.scalar(" ", words.type)
    return pc.binary_join_element_wise(space, words, space, pa.scalar("", words.type))


def hashed(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each code point; BUCKETS where it would pass the text's end."""
    out = np.full(len(codes), BUCKETS, dtype=np.int64)
    whole = len(codes) - order + 1
    if whole > 0:
        key = np.zeros(whole, dtype=np.uint32)
        for j in range(order):
            key = key * np.uint32(_STEP) + codes[j : whole + j]
        out[:whole] = (key + np.uint32(order)) * np.uint32(_MIX) >> np.uint32(32 - BITS)
        for j in range(1, order):
            out[ends - j] = BUCKETS
    return out


def pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(own, starts, buckets): numbers of some texts, where they start, and the buckets of their n-grams per order.

    A text of more than PIECE code points comes in several pieces; each reaches into the next as far
    as its last n-grams do, and only n-grams that begin before that have a bucket.
    """
    for first, some in text_slices(texts):
        words = plain(some)
        lengths = pc.utf8_length(words).to_numpy()
        if len(words) == 1 and lengths[0] > PIECE:
            text = words[0].as_py()
            for a in range(0, len(text), PIECE):
                part = text[a : a + PIECE + max(ORDERS) - 1]
                yield np.array([first]), np.array([0]), _buckets(part, np.array([len(part)]), PIECE)
            continue
        ends = np.cumsum(lengths)
        yield first + np.arange(len(words)), ends - lengths, _buckets("".join(words.to_pylist()), ends, int(ends[-1]))


def _buckets(text: str, ends: np.ndarray, begins: int) -> list[np.ndarray]:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return [hashed(codes, ends, order)[:begins] for order in ORDERS]


def learn_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """[lang, bucket, n]: how often a language's texts have a bucket; bucket -1 counts its texts."""

    def give(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.nonzero(counts)[0]
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at - 1, pa.int64()), pa.array(counts[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            batch = batch.filter(has_letter(batch.column("text"))).sort_by("lang")
            langs, last = batch.column("lang").to_pylist(), -1
            for own, starts, buckets in pieces(batch.column("text")):
                bounds = np.append(starts, len(buckets[0])).tolist()
                a = 0
                while a < len(own):
                    # Texts of one language lie together.
                    lang, b = langs[own[a]], a + 1
                    while b < len(own) and langs[own[b]] == lang:
                        b += 1
                    if lang not in held:
                        if len(held) == LANGUAGES:
                            yield from give(held)
                            held = {}
                        held[lang] = np.zeros(BUCKETS + 2, dtype=np.int64)
                    held[lang][0] += np.count_nonzero(own[a:b] > last)
                    for part in buckets:
                        held[lang][1:] += np.bincount(part[bounds[a] : bounds[b]], minlength=BUCKETS + 1)
                    held[lang][-1] = 0
                    a, last = b, own[b - 1]
        yield from give(held)

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def log_shares(counts: np.ndarray) -> np.ndarray:
    """Logarithms of smoothed shares in whole steps, from counts by bucket and language."""
    shares = (counts + 1) / (counts.sum(axis=0) + len(counts))
    return np.floor(np.log(shares) * UNIT + 0.5).astype(np.int32)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[tuple[list[str], np.ndarray, np.ndarray]]:
    """Per matrix: its languages in order, their logarithmic priors, the matrix with a row of zeros at its end."""
    spark = docs.sparkSession
    counts = materialise(learn_counts(docs, text_col, lang_col), "language-counts")
    texts = {r["lang"]: r["n"] for r in counts.where("bucket = -1").select("lang", "n").collect()}
    langs, total = sorted(texts), sum(texts.values())
    model = []
    for at in range(0, len(langs), LANGUAGES):
        some = langs[at : at + LANGUAGES]
        number = spark.createDataFrame([(lang, i) for i, lang in enumerate(some)], "lang string, i int")
        read = counts.where("bucket >= 0").join(F.broadcast(number), "lang").select("i", "bucket", "n").toArrow()
        dense = np.zeros((BUCKETS, len(some)), dtype=np.int64)
        dense[read.column("bucket").to_numpy(), read.column("i").to_numpy()] = read.column("n").to_numpy()
        matrix = np.concatenate([log_shares(dense), np.zeros((1, len(some)), np.int32)])
        prior = np.array([math.floor(math.log(texts[lang] / total) * UNIT + 0.5) for lang in some], dtype=np.int64)
        model.append((some, prior, matrix))
    return model


def batch_sums(texts: pa.Array, matrix: np.ndarray) -> np.ndarray:
    """Sums of the matrix rows of each text's n-grams (texts x languages)."""
    sums = np.zeros((len(texts), matrix.shape[1]), dtype=np.int64)
    slab = max(1, CELLS // matrix.shape[1])
    for own, starts, buckets in pieces(texts):
        size = len(buckets[0])
        ends = np.append(starts[1:], size)
        for part in buckets:
            for a in range(0, size, slab):
                b = min(a + slab, size)
                low, high = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
                edges = np.maximum(starts[low:high], a) - a
                sums[own[low:high]] += np.add.reduceat(matrix[part[a:b]], edges, axis=0, dtype=np.int64)
    return sums


def predict(docs: DataFrame, model: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, lang_pred, score] of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    if not model:
        return rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # The best language so far, its sum, and the weights of all so far as multiples of the best one's.
    rows = rows.select(
        "id", "text", F.lit(None).cast("string").alias("best"), F.lit(None).cast("long").alias("top"), F.lit(0.0).alias("mass")
    )
    for langs, prior, matrix in model:
        rows = _add_matrix(rows, kind, langs, prior, docs.sparkSession.sparkContext.broadcast(matrix))
    known = F.col("best").isNotNull()
    return rows.select(
        "id",
        F.when(known, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.round(1 / F.col("mass"), 6)).otherwise(0.0).alias("score"),
    )


def _add_matrix(rows: DataFrame, kind: str, langs: list[str], prior: np.ndarray, shared) -> DataFrame:
    names = pa.array(langs, pa.string())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            sound = np.asarray(has_letter(texts))
            at = np.nonzero(sound)[0]
            sums = batch_sums(texts.filter(pa.array(sound)), shared.value) + prior
            here = sums.argmax(axis=1)
            top = sums.max(axis=1)
            mass = np.exp((sums - top[:, None]) / UNIT).sum(axis=1)
            before = batch.column("top").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)[at]
            # A tie stays with the earlier matrix, whose languages come first.
            newer = top > before
            highest = np.maximum(top, before)
            grown = mass * np.exp((top - highest) / UNIT)
            seen = before > np.iinfo(np.int64).min
            grown[seen] += batch.column("mass").to_numpy()[at][seen] * np.exp((before[seen] - highest[seen]) / UNIT)
            best = np.full(len(sound), -1)
            best[at[newer]] = here[newer]
            tops, masses = np.zeros(len(sound), np.int64), np.zeros(len(sound))
            tops[at], masses[at] = highest, grown
            picked = names.take(pa.array(best, mask=best < 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    texts,
                    pc.coalesce(picked, batch.column("best")),
                    pa.array(tops, mask=~sound),
                    pa.array(masses),
                ],
                names=["id", "text", "best", "top", "mass"],
            )

    return rows.mapInArrow(score, f"id {kind}, text string, best string, top long, mass double")


def is_held_out(doc_id: Column) -> Column:
    """A quarter of the ids, by their checksum; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
