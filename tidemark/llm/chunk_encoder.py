"""Encode texts by way of their distinct chunks.

Where a tokenizer never joins characters across some boundary, the ids of a text are those of
its chunks one after the other, so each distinct chunk goes through the library once and the
texts are put together by numpy. The table of a worker process holds a bounded number
of chunks; when it is full it starts anew, which changes the time and never the ids.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Chunks that go to a library in one call; its results are objects, far larger than the ids.
CALL = 20_000


@dataclass
class Ids:
    """Ids of some chunks in one array, the number of each chunk, and a mark of each chunk."""

    flat: np.ndarray
    lengths: np.ndarray
    marks: np.ndarray


def in_calls(
    encode: Callable[[list[str]], list[list[int]]], chunks: list[str], call: int = CALL
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths from a library that returns lists, a bounded number of chunks at a time."""
    flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for at in range(0, len(chunks), call):
        lists = encode(chunks[at : at + call])
        lengths.append(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
        flat.append(np.fromiter((i for ids in lists for i in ids), dtype=np.uint32, count=int(lengths[-1].sum())))
    return np.concatenate(flat), np.concatenate(lengths)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    while size > len(array):
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class ChunkEncoder:
    """`encode_many` takes distinct chunks and gives them, in an order of its own, with their ids."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[list[str], Ids]], limit: int = 400_000):
        self.encode_many = encode_many
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.table: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.lengths = np.zeros(1 << 14, dtype=np.int64)
        self.marks = np.zeros(1 << 14, dtype=bool)

    def forget(self) -> None:
        """Give the table's memory back, for the tasks that use this worker next."""
        self._clear()

    def _learn(self, missing: list[str]) -> None:
        chunks, ids = self.encode_many(missing)
        known, end = len(self.table), len(self.table) + len(chunks)
        self.flat = _room(self.flat, self.used + len(ids.flat))
        self.starts, self.lengths, self.marks = (_room(x, end) for x in (self.starts, self.lengths, self.marks))
        self.flat[self.used : self.used + len(ids.flat)] = ids.flat
        self.starts[known:end] = self.used + np.cumsum(ids.lengths) - ids.lengths
        self.lengths[known:end] = ids.lengths
        self.marks[known:end] = ids.marks
        self.used += len(ids.flat)
        self.table.update(zip(chunks, range(known, end), strict=True))

    def encode(self, chunks: pa.Array) -> Ids:
        """Ids of an array of chunks."""
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [c for c in distinct if c not in self.table]
        if len(self.table) + len(missing) > self.limit:
            self._clear()
            missing = distinct
        if missing:
            self._learn(missing)
        places = np.fromiter(map(self.table.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        at = places[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        shift = self.starts[at] - (np.cumsum(lengths) - lengths)
        total = int(lengths.sum())
        return Ids(self.flat[np.repeat(shift, lengths) + np.arange(total)], lengths, self.marks[at])


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of a value of each chunk over the chunks of each text."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    edges = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(ends[edges])


def in_slices(sizes: list[int] | np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of texts of about so many bytes; a longer text has its own."""
    first, size = 0, 0
    for i, n in enumerate(sizes):
        if i > first and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if len(sizes):
        yield first, len(sizes)


def text_slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """(first, texts) of slices of a column; nulls become empty texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    for first, last in in_slices(np.diff(offsets).tolist(), most):
        yield first, texts.slice(first, last - first)


def give_back() -> None:
    """Return what Arrow and the C library keep of freed memory to the system, where the library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` for mapInArrow, whose worker stays no larger behind a task than what it still holds.

    Workers outlive tasks and stages, and share an executor's memory with the JVM.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
