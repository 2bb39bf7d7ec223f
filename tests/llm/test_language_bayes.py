"""The language model: sums against a plain loop, accuracy on held-out rows, many languages, defined results."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_bayes, queries

SF = "/root/testdata/sf0.01"


def _grams(text):
    """Buckets of one text, by a loop over its characters."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    plain = f" {' '.join(kept.split())} "
    out = []
    for order in language_bayes.ORDERS:
        for i in range(len(plain) - order + 1):
            key = 0
            for c in plain[i : i + order]:
                key = (key * 1_000_003 + ord(c)) % 2**32
            out.append((key + order) * 1_540_483_477 % 2**32 >> 32 - language_bayes.BITS)
    return out


def _steps(x):
    return math.floor(math.log(x) * language_bayes.UNIT + 0.5)


def _plain_model(rows):
    counts, texts = {}, Counter()
    for text, lang in rows:
        if lang is not None and text is not None and any(map(str.isalpha, text)):
            counts.setdefault(lang, Counter()).update(_grams(text))
            texts[lang] += 1
    return counts, texts


def _plain_sums(text, model):
    counts, texts = model
    sums = {}
    for lang, own in counts.items():
        total = sum(own.values()) + language_bayes.BUCKETS
        sums[lang] = _steps(texts[lang] / sum(texts.values())) + sum(_steps((own[b] + 1) / total) for b in _grams(text))
    return sums


ROWS = [
    ("Der Hund, die Katze und das Haus!", "de"),
    ("the dog and the house 42 times", "en"),
    ("ÉTÉ à la maison, où est le chien?", "fr"),
    ("das ist ein Haus", "de"),
    ("  This -- is the house  ", "en"),
    ("Привет мир", "ru"),
    ("123 !!", "en"),
    ("", "fr"),
    (None, "fr"),
    ("le chien et la maison", None),
    ("ab " * 400 + "das Haus", "de"),
]


@pytest.fixture
def docs(spark):
    rows = [(i, text, lang, "score", 1) for i, (text, lang) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, best string, top int")


@pytest.mark.parametrize("piece, cells, languages", [(1 << 20, 1 << 23, 32), (64, 50, 32), (1 << 20, 1 << 23, 3), (7, 9, 1)])
def test_matches_a_plain_loop(docs, monkeypatch, piece, cells, languages):
    """Whatever the sizes of pieces, slabs and matrices."""
    for name, value in (("PIECE", piece), ("CELLS", cells), ("LANGUAGES", languages)):
        monkeypatch.setattr(language_bayes, name, value)
    if piece < 1 << 20:
        whole = language_bayes.text_slices
        monkeypatch.setattr(language_bayes, "text_slices", lambda texts: whole(texts, 8))
    model = _plain_model(ROWS)
    # The functions run here, where the smaller sizes hold.
    texts = pa.array([t for t, _ in ROWS if t and any(map(str.isalpha, t))])
    langs = sorted(model[0])
    matrix = np.stack([[_steps((model[0][lang][b] + 1) / (sum(model[0][lang].values()) + language_bayes.BUCKETS)) for b in range(language_bayes.BUCKETS)] + [0] for lang in langs], axis=1).astype(np.int32)
    prior = np.array([_steps(model[1][lang] / sum(model[1].values())) for lang in langs])
    got = language_bayes.batch_sums(texts, matrix) + prior
    want = [[_plain_sums(t, model)[lang] for lang in langs] for t in texts.to_pylist()]
    assert (got == np.array(want)).all()
    trained = language_bayes.train(docs)
    assert [lang for some, _, _ in trained for lang in some] == langs
    assert (np.concatenate([m for _, _, m in trained], axis=1) == matrix).all()
    assert (np.concatenate([p for _, p, _ in trained]) == prior).all()
    answers = {r.id: r for r in language_bayes.predict(docs, trained).collect()}
    assert len(answers) == len(ROWS)
    for i, (text, _) in enumerate(ROWS):
        if not text or not any(map(str.isalpha, text)):
            assert (answers[i].lang_pred, answers[i].score) == ("und", 0.0)
            continue
        sums = _plain_sums(text, model)
        top = max(sums.values())
        assert answers[i].lang_pred == min(lang for lang in sums if sums[lang] == top)
        share = 1 / sum(math.exp((s - top) / language_bayes.UNIT) for s in sums.values())
        assert abs(answers[i].score - share) < 1e-6


def test_held_out_accuracy(spark):
    got = queries.op11_hashed_bayes(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.99


def test_held_out_rows_teach_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = language_bayes.is_held_out(F.col("doc_id"))
    wrong = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("?"))
    wrong.write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(queries.op11_hashed_bayes(spark, SF).collect())
    assert sorted(queries.op11_hashed_bayes(spark, str(tmp_path)).collect()) == want


def test_hard_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, best string, mass double"
    rows = [(1, "der Hund und das Haus", "de"), (2, "the dog and the house", "en"), (2, "the dog and the house", "en"),
            (None, "the dog and the house", "en"), (3, None, "de"), (4, "", "de"), (5, "12 %% \n", "de"), (6, "x" * 300_000, None)]
    spark.createDataFrame([(*r, "b", 1.0) for r in rows], schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = queries.op11_hashed_bayes(spark, f"{tmp_path}/a").collect()
    assert len(got) == len(rows)
    said = {r.doc_id: r.lang_pred for r in got}
    assert said.pop(6) in ("de", "en")
    assert said == {1: "de", 2: "en", None: "en", 3: "und", 4: "und", 5: "und"}
    assert not next(r for r in got if r.doc_id is None).held_out
    # Equal evidence: the language that comes first.
    tie = [(1, "abc", "b"), (2, "abc", "a"), (3, "abc", None)]
    spark.createDataFrame([(*r, "b", 1.0) for r in tie], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert {(r.lang_pred, r.score) for r in queries.op11_hashed_bayes(spark, f"{tmp_path}/b").collect()} == {("a", 0.5)}
    spark.createDataFrame([(1, "abc", None, "b", 1.0)], schema).write.parquet(f"{tmp_path}/c/documents.parquet")
    assert [(r.lang_pred, r.score) for r in queries.op11_hashed_bayes(spark, f"{tmp_path}/c").collect()] == [("und", 0.0)]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/d/documents.parquet")
    assert queries.op11_hashed_bayes(spark, f"{tmp_path}/d").collect() == []
