"""The pipeline against plain versions of its stages."""

import zlib

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tests.llm.test_partenum import _components, _sets
from tests.llm.test_secret_scan import plain as plain_secrets
from tidemark.llm import quality_cnn

SF = "/root/testdata/sf0.001"


def _redacted(text):
    out, at = "", 0
    for start, end in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in plain_secrets(text))):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_cnn.train(docs, labels)
    score = {r.id: r.score for r in quality_cnn.score(docs, model).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if score[r.doc_id] >= corpus_pipeline.LEAST_QUALITY)
    ids, texts = zip(*rows, strict=True)
    component = _components(ids, _sets(texts))
    rows = [r for r, c in zip(rows, component, strict=True) if r[0] == c]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(item in t for item in items)]
    judge = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for i, text in rows:
        text = _redacted(text)
        pieces = np.array(judge.encode(text), dtype="<u4")
        want[i] = (len(pieces), zlib.crc32(pieces.tobytes()), zlib.crc32(text.encode()), True, True)
    got = {r[0]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_hard_rows_pass_every_stage(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema.add("row", "string").add("_kept", "integer")
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id here", "en", "s", 3), (None, None, None, None, None)]
    rows += [(3, "token = abcdef123456 and more words", "en", "s", 9), (3, "token = abcdef123456 and more words", "en", "s", 9)]
    for rows_in in ([], [(*r, "clash", 1) for r in rows]):
        docs = spark.createDataFrame(rows_in, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == schema.names
            docs = spark.createDataFrame(docs.collect(), schema)
        kept = {r.doc_id: r.text for r in docs.collect()}
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()
        if rows_in and 3 in kept:
            assert kept[3] == "[SECRET] and more words" and sum(r.doc_id == 3 for r in docs.collect()) == 1


def test_stages_are_those_named():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
