"""Token files against the library on whole texts, and the files' own layout."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm import queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, and DON'T stop; l'été.",
    None,
    "",
    " \n\t ",
    "ΣΑΣ ② ½ ｆｕｌｌ  naïve é Å",
    "日本語 テスト <|endoftext|>x 😀!!",
    "long " * 30_000,
    "x" * 5000,
    "a b c\x1cd\r\ne's",
]


def _write(spark, path, rows):
    schema = "doc_id long, text string, id string, start int, n_tokens string"
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_matches_the_library(spark, tmp_path):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(7, "same"), (7, "same"), (None, "no id")]
    got = queries.op1_token_files(spark, _write(spark, tmp_path, rows)).collect()
    whole = Tokenizer.from_file(PATH)
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_empty_table(spark, tmp_path):
    assert queries.op1_token_files(spark, _write(spark, tmp_path, [])).count() == 0


def test_files_hold_equal_sequences_and_masks(spark):
    rows = spark.createDataFrame([(i, "some words here " * i) for i in range(60)], "doc_id long, text string")
    manifest = token_files.write_token_files(rows.coalesce(1), PATH, sequence=32, batch=4).collect()
    for file in manifest:
        with token_files._open(f"{file.folder}/{file.file}.arrow") as source:
            data = pa.ipc.open_file(source)
            assert data.schema.field("ids").type == pa.list_(pa.uint16(), 32)
            batches = [data.get_batch(i) for i in range(data.num_record_batches)]
            assert all(len(b) == 4 for b in batches[:-1])
            mask = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in batches])
            assert mask.sum() == file.n_tokens and mask[: file.n_tokens].all() and len(mask) % 32 == 0
            # A slice is a view on the mapped file.
            view = next(token_files.token_slice(data, 5, 3))
            assert not view.flags.owndata and len(view) == 3


def test_a_full_table_starts_anew():
    from tidemark.llm.chunk_encoder import ChunkEncoder, Ids, in_calls, in_slices

    def own(chunk):
        return [len(chunk), *map(ord, chunk)]

    def encode_many(chunks):
        chunks = chunks[::-1]
        flat, lengths = in_calls(lambda some: [own(c) for c in some], chunks)
        return chunks, Ids(flat, lengths, np.array(["a" in c for c in chunks], dtype=bool))

    encoder = ChunkEncoder(encode_many, limit=5)
    for chunks in (["ab", "c", "ab"], ["d", "e", "f", "", "ab"], [], [str(i) for i in range(9)]):
        ids = encoder.encode(pa.array(chunks, pa.string()))
        assert ids.flat.tolist() == [x for c in chunks for x in own(c)]
        assert ids.lengths.tolist() == [len(own(c)) for c in chunks] and ids.marks.tolist() == ["a" in c for c in chunks]
    assert list(in_slices([5, 5, 1], 6)) == [(0, 1), (1, 3)] and list(in_slices([])) == []
