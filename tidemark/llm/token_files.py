"""Token ids as Arrow files of equal-length sequences, for zero-copy random access.

Documents are ordered by id and dealt over tasks by ranges. A task concatenates the ids of its
documents, an end id after each, cuts them into sequences of `SEQUENCE` ids and writes record
batches of two fixed-size-list columns, `ids` (16 bits where the vocabulary allows) and
`mask` (false on the padding of the last sequence). All batches of a file but the last hold
`BATCH` sequences, so sequence i is row i % BATCH of batch i // BATCH, read in place from
a memory-mapped file. A second Arrow file beside it lists the documents: id, start, ids.

A task writes under a name of its own and reports it in its result; the manifest, a table that
Spark commits, names the files of the tasks that succeeded. Files of lost tasks are in no
manifest.

Defined results: a null or empty text has the end id only; rows with equal ids stand beside
each other in any order; null ids come first. An empty table gives an empty manifest.
Extra columns of the input are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import ChunkEncoder, Ids, in_calls, per_text, text_slices
from tidemark.session import materialise, scratch_dir

SEQUENCE = 2048
BATCH = 256
END_ID = 1

_ENCODERS: dict[str, ChunkEncoder] = {}

# Latin letters, digits and signs that lower-casing and splitting treat alike here and in the
# library. An apostrophe can begin a suffix, and < a special token, so words with one go the
# library's way.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]+\Z")
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+|\n")


def word_encoder(path: str) -> ChunkEncoder:
    """Encoder of words between blanks for a tokenizer that lower-cases and drops white space.

    Its splitter never joins characters across a blank, a line feed, or the border of letters,
    digits and other signs. Plain words are split here and their pieces go through the
    library's byte-pair model; all other words go through the whole tokenizer.
    """
    if path not in _ENCODERS:
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        model = Tokenizer.from_file(path)
        model.normalizer = None
        model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        special = [t.content for t in whole.get_added_tokens_decoder().values()]
        if any(_PLAIN.match(s) for s in special):
            raise ValueError("special tokens of plain characters aren't covered")

        def ids(tokenizer):
            return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def encode_pieces(pieces: list[str]) -> tuple[list[str], Ids]:
            # The mark is that of the line feed between two words, which has no ids.
            flat, lengths = in_calls(lambda some: [[] if p == "\n" else i for p, i in zip(some, ids(model)(some))], pieces)
            return pieces, Ids(flat, lengths, np.array([p == "\n" for p in pieces]))

        pieces = ChunkEncoder(encode_pieces, limit=1_000_000)

        def encode_many(words: list[str]) -> tuple[list[str], Ids]:
            plain = list(filter(_PLAIN.match, words))
            other = [w for w in words if not _PLAIN.match(w)] if len(plain) < len(words) else []
            parts = pieces.encode(pa.array(_PIECES.findall("\n".join(plain).lower()), pa.string()))
            word = np.cumsum(parts.marks)
            lengths = np.bincount(word, parts.lengths, len(plain)).astype(np.int64) if plain else parts.lengths
            flat, more = in_calls(ids(whole), other)
            lengths = np.concatenate([lengths, more])
            return plain + other, Ids(np.concatenate([parts.flat, flat]), lengths, np.zeros(len(lengths), bool))

        # Pieces are fewer and come back more often than words, so only they are remembered.
        _ENCODERS[path] = ChunkEncoder(encode_many, limit=0)
    return _ENCODERS[path]


def encode_texts(encoder: ChunkEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, number of ids of each text."""
    words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    ids = encoder.encode(words.flatten())
    return ids.flat, per_text(ids.lengths, pc.list_value_length(words).to_numpy())


def _open(uri: str):
    where, path = fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path)


class _Writer:
    """Packs ids into sequences and writes them batch by batch."""

    def __init__(self, folder: str, dtype: str, sequence: int, batch: int):
        self.where, path = fs.FileSystem.from_uri(folder)
        self.where.create_dir(path, recursive=True)
        self.name = f"tokens-{uuid.uuid4().hex}"
        self.sequence, self.dtype = sequence, np.dtype(dtype)
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema({"ids": pa.list_(kind, sequence), "mask": pa.list_(pa.bool_(), sequence)})
        self.index_schema = pa.schema({"id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
        self.room = batch * sequence
        self.held: list[np.ndarray] = []
        self.n_held = self.n_all = 0
        self.sinks = [self.where.open_output_stream(f"{path}/{self.name}{end}.arrow") for end in ("", "-index")]
        self.out = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], self.index_schema)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        starts = self.n_all + np.cumsum(lengths) - lengths
        self.index.write_batch(
            pa.record_batch([doc_ids, pa.array(starts), pa.array(lengths)], schema=self.index_schema)
        )
        self.n_all += len(ids)
        ids = ids.astype(self.dtype)
        while len(ids):
            taken = ids[: self.room - self.n_held]
            self.held.append(taken)
            self.n_held += len(taken)
            ids = ids[len(taken) :]
            if self.n_held == self.room:
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.n_held // self.sequence)
        ids = np.zeros(rows * self.sequence, dtype=self.dtype)
        ids[: self.n_held] = np.concatenate(self.held)
        mask = np.arange(len(ids)) < self.n_held
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (ids, mask)]
        self.out.write_batch(pa.record_batch([c.cast(f.type) for c, f in zip(columns, self.schema)], schema=self.schema))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._flush()
        for file in (self.out, self.index, *self.sinks):
            file.close()


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    batch: int = BATCH,
) -> DataFrame:
    """Write the files; the manifest [part, folder, file, n_tokens], one row per file.

    `tokenizer` is the path of the vocabulary file, the same on every machine.
    """
    folder = scratch_dir(docs.sparkSession, "tokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        from tokenizers import Tokenizer

        wide = Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        writer = None
        for rows in batches:
            for first, texts in text_slices(rows.column(1)):
                ids, lengths = encode_texts(encoder, texts)
                # The end id goes behind the last id of each document.
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                if writer is None:
                    writer = _Writer(folder, "uint32" if wide else "uint16", sequence, batch)
                writer.add(rows.column(0).slice(first, len(texts)), ids, lengths + 1)
        if writer is not None:
            writer.close()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "folder": [folder], "file": [writer.name], "n_tokens": [writer.n_all]}
            )

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id")
    return materialise(
        ordered.mapInArrow(encode, "part long, folder string, file string, n_tokens long"), "token-manifest"
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """[id, start, n_tokens, ids_crc32] of every document, read back from the files.

    `start` counts the ids of all documents before it. The checksum is that of the ids as
    little-endian unsigned 32-bit integers.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so the one task of this window sees a short list.
    files = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    files = files.repartition(F.col("file")).select("folder", "file", "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                path = f"{row['folder']}/{row['file']}"
                with _open(f"{path}.arrow") as data, _open(f"{path}-index.arrow") as listed:
                    sequences, index = pa.ipc.open_file(data), pa.ipc.open_file(listed)
                    for i in range(index.num_record_batches):
                        docs = index.get_batch(i)
                        starts = docs.column(1).to_numpy()
                        yield pa.RecordBatch.from_arrays(
                            [
                                docs.column(0),
                                pa.array(starts + row["first"]),
                                docs.column(2),
                                pa.array(_checksums(sequences, starts, docs.column(2).to_numpy()), pa.int64()),
                            ],
                            names=["id", "start", "n_tokens", "ids_crc32"],
                        )

    return files.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def token_slice(sequences: pa.ipc.RecordBatchFileReader, start: int, n: int) -> Iterator[np.ndarray]:
    """The ids start .. start + n of a file, as views on its batches."""
    width = sequences.schema.field("ids").type.list_size
    room = len(sequences.get_batch(0)) * width
    while n > 0:
        at = start % room
        flat = sequences.get_batch(start // room).column(0).flatten().to_numpy()
        taken = flat[at : at + n]
        yield taken
        start, n = start + len(taken), n - len(taken)


def _checksums(sequences: pa.ipc.RecordBatchFileReader, starts: np.ndarray, lengths: np.ndarray) -> list[int]:
    out, held, number = [], None, -1
    room = len(sequences.get_batch(0)) * sequences.schema.field("ids").type.list_size
    for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
        check = 0
        while n > 0:
            if start // room != number:
                number = start // room
                held = sequences.get_batch(number).column(0).flatten().to_numpy()
            taken = held[start % room : start % room + n]
            check = zlib.crc32(taken.astype("<u4").tobytes(), check)
            start, n = start + len(taken), n - len(taken)
        out.append(check)
    return out
