"""SentencePiece codec against the sentencepiece library on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from sentencepiece import SentencePieceProcessor

from tidemark.llm import queries, sentencepiece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Plain words and\nlines.",
    None,
    "",
    " ",
    "  two  blanks   three ",
    "日本語 😀 <s> </s> <0x41> é",
    " " * 40 + "q",
    "ab" * 5000,
    "word " * 20_000,
    "\u0000 z \t",
]


def _write(spark, path, rows):
    schema = "doc_id long, text string, ids string, parity int, decoded string"
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_matches_the_library(spark, tmp_path):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (None, "no id")]
    got = queries.op5_sentencepiece(spark, _write(spark, tmp_path, rows)).collect()
    judge = SentencePieceProcessor(model_file=PATH)
    want = []
    for doc_id, text in rows:
        ids = np.array(judge.encode(text or ""), dtype="<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes()), zlib.crc32((text or "").encode()), True, True))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    assert queries.op5_sentencepiece(spark, _write(spark, tmp_path, [])).count() == 0


def test_ids_travel_and_come_back(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    encoded = sentencepiece_codec.encode_pieces(docs, PATH)
    assert all(encoded.select("parity").toPandas()["parity"])
    back = {r.id: r.text for r in sentencepiece_codec.decode_pieces(encoded, PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_marker_in_a_text():
    codec = sentencepiece_codec.codec(PATH)
    texts = ["▁▁a ▁b", "x▁"]
    ids, lengths, agreed = codec.encode(pa.array(texts, pa.large_string()))
    want = codec.judge.encode(texts)
    assert ids.tolist() == sum(want, []) and lengths.tolist() == [len(w) for w in want] and agreed.all()


def test_decoded_as_by_the_library():
    codec = sentencepiece_codec.codec(PATH)
    rng = np.random.default_rng(5)
    size = len(codec.model.pieces)
    lists = [codec.judge.encode(t) for t in TEXTS if t is not None]
    # Any ids: control and unknown pieces, bytes that make no characters, ids beyond the model, none at all.
    lists += [rng.integers(0, 300 if k % 2 else size + 5, k % 9).tolist() for k in range(400)]
    lists += [[259], [259, 259, 1], [35, 259], [3 + 0x20, 3 + 0xC3], [3 + 0xC3, 3 + 0xA9]]
    lengths = np.array([len(x) for x in lists])
    got = codec.decode(np.array(sum(lists, []), dtype=np.uint32), lengths).to_pylist()
    assert got == codec.tokenizer.decode_batch(lists, skip_special_tokens=False)
    assert codec.decode(np.zeros(0, np.uint32), np.zeros(0, np.int64)).to_pylist() == []


def test_unigram_models_keep_their_scores():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("▁ab", -3.5, 1), ("ba", -6.0, 1)]
    model = sentencepiece_codec.Model(pieces, sentencepiece_codec.UNIGRAM, byte_fallback=True)
    tokenizer = sentencepiece_codec.build_tokenizer(model)
    assert tokenizer.encode(" ab  aba <s>é", add_special_tokens=False).tokens[:4] == ["▁ab", "▁ab", "a", "▁"]
    ids = tokenizer.encode("ab é", add_special_tokens=False).ids
    assert tokenizer.decode(ids) == "ab é"


def test_large_batches_are_encoded_in_small_slices(spark, monkeypatch):
    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            return function

    sizes = []
    plain = sentencepiece_codec.Codec.encode
    monkeypatch.setattr(sentencepiece_codec.Codec, "encode", lambda self, texts: sizes.append(sum(map(len, texts.to_pylist()))) or plain(self, texts))
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([f"some words {i} " * 60 for i in range(3000)])], names=["id", "text"])
    for function in (sentencepiece_codec.round_trips(Frame(), PATH), sentencepiece_codec.encode_pieces(Frame(), PATH)):
        sizes.clear()
        assert sum(b.num_rows for b in function(iter([batch]))) == 3000
        assert sum(sizes) > 2_500_000 and max(sizes) <= 1_000_000
