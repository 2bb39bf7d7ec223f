"""Term counts, TF-IDF and word-count features of [doc_id, words] documents."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import number_rows
from tidemark.session import bucketed, buckets_for, materialise

# The functions that run in Python workers travel whole: these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# About so many words are counted at once.
SLICE_WORDS = 1 << 20
# Width of the hashed feature space.
HASH_FEATURES = 1 << 20


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the words of a slice of texts and count the pairs of text and number."""
    for batch in batches:
        lists = batch.column("words")
        sizes = np.diff(lists.offsets.to_numpy())
        texts, words = np.repeat(np.arange(len(sizes)), sizes), lists.flatten()
        wanted = pc.fill_null(pc.not_equal(words, ""), False)
        texts, words = texts[np.asarray(wanted)], words.filter(wanted)
        # A slice ends where a text ends.
        bounds = np.searchsorted(texts, np.append(texts[:: SLICE_WORDS], len(sizes)))
        for low, high in zip(bounds, bounds[1:], strict=False):
            coded = words.slice(low, high - low).dictionary_encode()
            many = max(1, len(coded.dictionary))
            pairs, counts = np.unique(texts[low:high] * many + coded.indices.to_numpy(), return_counts=True)
            text, word = np.divmod(pairs, many)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(text)), coded.dictionary.take(pa.array(word)), pa.array(counts)],
                names=["doc_id", "term", "tf"],
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """[doc_id, term, tf], counted where the document is, so nothing is exchanged.

    A document's row is one of a table with an id of its own; rows with equal ids aren't added up.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "words").mapInArrow(_count_words, f"doc_id {kind}, term string, tf bigint")


def document_count(docs: DataFrame) -> Column:
    """The number of documents as a scalar subquery."""
    return docs.agg(F.count("*")).scalar()


def idf(terms: DataFrame, n_docs: Column | int) -> DataFrame:
    """[term, df, idf] with idf = ln((n + 1) / (df + 1))"""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    frequency = terms.groupBy("term").agg(F.count("*").alias("df"))
    return frequency.select("term", "df", F.log((n + 1) / (F.col("df") + 1)).alias("idf"))


def tfidf_long(docs: DataFrame) -> DataFrame:
    """[doc_id, term, tfidf] on the exact terms.

    Counts and weights are written tables: words are counted once, and the join splits the rows of a term that most
    documents hold.
    """
    terms = materialise(term_counts(docs), "term-counts")
    weights = materialise(idf(terms, document_count(docs)).select("term", "idf"), "idf")
    return terms.join(weights, "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("tfidf"))


def weighted_terms(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """([doc_id, term_id, tf, tfidf], [term_id, term, df, idf]), both written; terms are numbered in their order.

    The rows are in buckets by document: what is put together or joined by document doesn't exchange them again.
    """
    terms = materialise(term_counts(docs), "term-counts")
    vocabulary = number_rows(idf(terms, document_count(docs)), "term", name="term_id")
    vocabulary = materialise(vocabulary, "vocabulary")
    rows = terms.join(vocabulary.select("term", "term_id", "idf"), "term")
    rows = rows.select("doc_id", "term_id", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    buckets = buckets_for(terms)
    return bucketed(rows.repartition(buckets, "doc_id"), "doc_id", buckets, "weighted-terms"), vocabulary


def hashing_tf(docs: DataFrame, num_features: int = HASH_FEATURES) -> DataFrame:
    """[..., tf]: hashed term frequencies as a sparse vector."""
    return HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features).transform(docs)


def tfidf(docs: DataFrame, num_features: int = HASH_FEATURES) -> DataFrame:
    """[doc_id, words, features]: hashed TF-IDF vectors."""
    return idf_vectors(hashing_tf(docs, num_features))


def idf_vectors(tf: DataFrame) -> DataFrame:
    """[doc_id, words, features] from [doc_id, words, tf], which is read once to fit and once for the vectors."""
    model = IDF(inputCol="tf", outputCol="features").fit(tf)
    return model.transform(tf).select("doc_id", "words", "features")


def bag_of_words(docs: DataFrame) -> DataFrame:
    """[doc_id, term, position, tf]: word counts over all words of the corpus.

    Words are numbered 0, 1, 2, ... in their order; no word is left out and none is on the driver.
    """
    terms = materialise(term_counts(docs), "term-counts")
    vocabulary = number_rows(terms.select("term").distinct(), "term", name="position")
    return terms.join(vocabulary, "term").select("doc_id", "term", (F.col("position") - 1).alias("position"), "tf")
