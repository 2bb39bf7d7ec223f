"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read here, field by field; normaliser, white-space marker, scores or
merges and byte fallback are rebuilt from it, and batches are encoded by the library, in one thread: Spark's tasks take the cores.
Parity is verified against the sentencepiece library on every distinct chunk of the
texts, not on a sample: no piece joins a marker to what stands before it, so equal chunks make
equal texts. Pieces are decoded by their bytes all at once, the rest by the library. Where the libraries differ the ids are those of sentencepiece, and the
row says so.

Both kinds of model are covered: unigram models keep their scores; byte-pair models, which
store scores too, get their merges back in the order of these. The invented marker for a blank
also stands for itself, so a text that holds it decodes to a blank there.

Defined results: a null or empty text has no ids and decodes to an empty text. Rows are
encoded one by one, so repeated rows and ids give repeated results; an empty table an
empty one. Extra columns of the input are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import ChunkEncoder, Ids, giving_back, in_calls, per_text, text_slices

# Fixed values of the model format: the marker, types of pieces, types of models.
MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

# Bytes of text that are encoded at a time, chunks that go to the libraries in one call, and chunks whose ids a worker keeps.
SLICE = 200_000
CALL = 2_000
CHUNKS = 200_000

_CODECS: dict[str, Codec] = {}


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size, at = {1: (8, at), 5: (4, at)}[wire] if wire != 2 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
            model.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.unk_id = trainer.get(40, 0)
        elif number == 3:
            normalizer = dict(_fields(value))
            model.charsmap = normalizer.get(2, b"")
            model.add_dummy_prefix = bool(normalizer.get(3, 1))
            model.remove_extra_whitespaces = bool(normalizer.get(4, 1))
    return model


def build_tokenizer(model: Model):
    """The same tokenizer in the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    # Control pieces are never found in a text, so theirs are names that no text reaches.
    names = [f"\x00{i}\x00{p}" if kind in (CONTROL, UNUSED) else p for i, (p, _, kind) in enumerate(model.pieces)]
    if model.kind == UNIGRAM:
        scores = [(name, score) for name, (_, score, _) in zip(names, model.pieces, strict=True)]
        core = models.Unigram(scores, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        ids = {name: i for i, name in enumerate(names)}
        merges = []
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind in (NORMAL, USER_DEFINED):
                pairs = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
                merges += [(-score, i, ids[a], ids[b], a, b) for a, b in pairs if a in ids and b in ids]
        merges.sort()
        core = models.BPE(
            ids,
            [(a, b) for *_, a, b in merges],
            unk_token=names[model.unk_id],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"models of kind {model.kind} are neither unigram nor byte-pair")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    if splits_at_marker(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}+[^{MARKER}]*"), "isolated")
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
        + [decoders.Strip(" ", 1, 0)] * model.add_dummy_prefix
    )
    tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED])
    return tokenizer


def splits_at_marker(model: Model) -> bool:
    """No piece holds a marker behind another character."""
    return not any(MARKER in p.lstrip(MARKER) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


_CHUNKS = re.compile(f"{MARKER}+[^{MARKER}]*|^[^{MARKER}]+")


class Codec:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        # As many tasks as cores run beside this one; more threads would only cost time and hold memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, "rb") as file:
            self.model = parse_model(file.read())
        self.tokenizer = build_tokenizer(self.model)
        self.judge = SentencePieceProcessor(model_file=path)
        # Chunks are cut before the normaliser, so only an identical one lets them stand alone.
        self.by_chunk = (
            splits_at_marker(self.model)
            and not self.model.charsmap
            and not self.model.remove_extra_whitespaces
            and self.model.add_dummy_prefix
        )
        self.encoder = ChunkEncoder(self._encode_many, CHUNKS)
        # What each piece gives wherever it stands, then what it gives as the first of a text.
        inside = [_bytes_of(piece, kind) for piece, _, kind in self.model.pieces]
        first = [b.removeprefix(b" ") if self.model.add_dummy_prefix else b for b in inside]
        self.parts = pa.array(inside + first, pa.large_binary())
        kinds = np.array([kind for *_, kind in self.model.pieces])
        self.is_byte = kinds == BYTE
        self.is_plain = self.is_byte | np.isin(kinds, (NORMAL, USER_DEFINED))

    def chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Parts of the texts that are encoded alone, each without its first marker; parts of each text."""
        if not self.by_chunk:
            return texts, np.ones(len(texts), dtype=np.int64)
        odd = pc.match_substring_regex(texts, f"{MARKER}|  |^ ")
        if pc.any(odd).as_py():
            lists = [
                [c[1:] for c in _CHUNKS.findall(MARKER + t.replace(" ", MARKER))] if o else t.split(" ")
                for t, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)
            ]
            split = pa.array(lists, pa.list_(pa.large_string()))
        else:
            split = pc.split_pattern(texts, " ")
        # An empty text is no marker either.
        empty = pc.equal(texts, "")
        counts = np.where(empty, 0, pc.list_value_length(split).to_numpy())
        return pc.if_else(empty, pa.scalar(None, split.type), split).flatten(), counts

    def _encode_many(self, chunks: list[str]) -> tuple[list[str], Ids]:
        # An empty chunk is a lone marker: a blank with nothing behind it.
        alone = self.tokenizer.token_to_id(MARKER) if self.by_chunk else None
        agreed: list[bool] = []

        def encode(some: list[str]) -> list[list[int]]:
            out = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            for i, wanted in enumerate(self.judge.encode(some, num_threads=1)):
                lone = some[i] == "" and alone is not None
                agreed.append(lone or out[i] == wanted)
                if lone:
                    out[i] = [alone]
                elif not agreed[-1]:
                    out[i] = wanted
            return out

        flat, lengths = in_calls(encode, chunks, CALL)
        return chunks, Ids(flat, lengths, ~np.array(agreed, dtype=bool))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in one array, the number of each text, and whether the libraries agreed on it."""
        parts, counts = self.chunks(texts)
        ids = self.encoder.encode(parts)
        return ids.flat, per_text(ids.lengths, counts), per_text(ids.marks, counts) == 0

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """Texts of ids laid one after the other.

        The bytes of the pieces are put together at once. Texts with pieces that stand for no text, and those
        whose byte pieces make no characters, go through the library's decoder.
        """
        ids = ids.astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        size = len(self.is_plain)
        known = np.clip(ids, 0, size - 1)
        odd = per_text((ids != known) | ~self.is_plain[known], lengths) > 0
        known[ends[:-1][lengths > 0]] += size
        taken = self.parts.take(pa.array(known))
        borders = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        # The pieces lie one after the other already: a text is what lies between two borders.
        joined = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(borders[ends]), taken.buffers()[2]]
        )
        try:
            texts = joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            odd |= per_text(self.is_byte[np.clip(ids, 0, size - 1)], lengths) > 0
            texts = pc.if_else(pa.array(odd), pa.scalar(None, joined.type), joined).cast(pa.large_string())
        if odd.any():
            lists = [ids[ends[i] : ends[i + 1]].tolist() for i in np.nonzero(odd)[0]]
            decoded = self.tokenizer.decode_batch(lists, skip_special_tokens=False)
            texts = pc.replace_with_mask(texts, pa.array(odd), pa.array(decoded, pa.large_string()))
        return texts


def _bytes_of(piece: str, kind: int) -> bytes:
    """What a piece gives in a decoded text; byte pieces are named <0x00> to <0xFF>."""
    return bytes([int(piece[1:-1], 16)]) if kind == BYTE else piece.replace(MARKER, " ").encode()


def codec(path: str) -> Codec:
    """One codec for each worker process and model."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, ids, parity]: piece ids of every whole text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for rows in batches:
            for first, texts in text_slices(rows.column(1), SLICE):
                ids, lengths, agreed = pieces.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(first, len(texts)),
                        pa.ListArray.from_arrays(offsets, ids.astype(np.int32)),
                        pa.array(agreed),
                    ],
                    names=["id", "ids", "parity"],
                )
        pieces.encoder.forget()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(giving_back(encode), "id long, ids array<int>, parity boolean")


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """[id, text] of rows with piece ids; null ids are an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for rows in batches:
            lists = rows.column(1)
            lengths = pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)
            texts = pieces.decode(lists.flatten().to_numpy(), lengths)
            yield pa.RecordBatch.from_arrays([rows.column(0), texts.cast(pa.string())], names=["id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(decode, "id long, text string")


def round_trips(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, n_tokens, ids_crc32, decoded_crc32, round_trip, parity] of every row.

    Encodes and decodes in one task, so that no ids travel. The checksums are those of the ids as
    little-endian unsigned 32-bit integers and of the decoded text.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for rows in batches:
            for first, texts in text_slices(rows.column(1), SLICE):
                ids, lengths, agreed = pieces.encode(texts)
                decoded = pieces.decode(ids, lengths)
                ends = np.cumsum(lengths).tolist()
                little = ids.astype("<u4")
                checks = [zlib.crc32(little[e - n : e]) for e, n in zip(ends, lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(first, len(texts)),
                        pa.array(lengths, pa.int64()),
                        pa.array(checks, pa.int64()),
                        pa.array([zlib.crc32(t.as_buffer()) for t in decoded], pa.int64()),
                        pc.equal(decoded, texts),
                        pa.array(agreed),
                    ],
                    names=["id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip", "parity"],
                )
        pieces.encoder.forget()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean, parity boolean"
    return rows.mapInArrow(giving_back(check), schema)
