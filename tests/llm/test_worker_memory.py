"""What the Python workers of the pipeline hold at a time, and keep behind a task."""

import re
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import chunk_encoder, latent_decontam, quality_cnn, sentencepiece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
BATCH = pa.RecordBatch.from_arrays(
    [pa.array([*range(2999), None]), pa.array([f"some words {i} " * 150 for i in range(2998)] + [None, ""])], names=["doc_id", "text"]
)
EMPTY = BATCH.slice(0, 0)


class Frame:
    """Takes the place of a DataFrame, and gives the function that its tasks run."""

    columns = BATCH.schema.names
    schema = None
    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


def _decontaminated(monkeypatch):
    monkeypatch.setattr(latent_decontam, "build_index", lambda *a: iter([[]]))
    monkeypatch.setattr(latent_decontam, "search", lambda texts, indexes: [(i, 0, 0, 0, 0) for i, t in enumerate(texts.to_pylist()) if " 7 " in t])
    return latent_decontam.drop_leaks(Frame(), None)


def _good(monkeypatch):
    # Scores by the number that stands in a text, so that each row's place counts.
    net = quality_cnn.Network(*(np.zeros(1),) * 4, 0.0)
    monkeypatch.setattr(quality_cnn, "pool", lambda texts, net: np.array([" 7 " not in bytes(t).decode() for t in texts]))
    monkeypatch.setattr(quality_cnn.Network, "probability", lambda self, pooled: pooled)
    return quality_cnn.keep_good(Frame(), net, 0.5)


@pytest.mark.parametrize("step", [_good, _decontaminated])
def test_rows_go_back_in_slices(monkeypatch, step):
    out = list(step(monkeypatch)(iter([BATCH, EMPTY, BATCH])))
    want = [i for i in BATCH.column(0).to_pylist() if i != 7]
    assert [i for b in out for i in b.column(0).to_pylist()] == want * 2
    assert max(b.nbytes for b in out) < 4_200_000 < BATCH.nbytes
    assert pa.Table.from_batches(out[: len(out) // 2]).column("text").to_pylist()[-2:] == [None, ""]


def test_codec_takes_small_slices_and_calls(spark, monkeypatch):
    codec = sentencepiece_codec.Codec(PATH)
    monkeypatch.setitem(sentencepiece_codec._CODECS, PATH, codec)
    sizes, calls, plain, judge = [], [], codec.encode, codec.judge
    codec.encode = lambda texts: sizes.append(sum(map(len, texts.to_pylist()))) or plain(texts)
    codec.judge = SimpleNamespace(encode=lambda some, **how: calls.append(len(some)) or judge.encode(some, **how))
    many = " ".join(f"w{i}x{i * 7}" for i in range(12_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a b", many, "c"])], names=["id", "text"])
    out = pa.Table.from_batches(sentencepiece_codec.round_trips(Frame(), PATH)(iter([BATCH, batch])))
    assert out.num_rows == 3003 and out.column("round_trip").to_pylist().count(True) == 3003
    # A longer text isn't cut.
    assert max(s for s in sizes if s != len(many)) <= 200_000 and sum(calls) > 12_000 and max(calls) <= 2_000


def _resident():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"\nAnonymous:\s+(\d+)", file.read())[1]) / 1024


def test_freed_memory_is_given_back():
    held = []

    def work(batches):
        # Small pieces that are freed below one that stays.
        pieces = [np.ones(20_000, dtype=np.uint8) for _ in range(6000)]
        held.append(pieces[-1])
        held.append(_resident())
        yield from batches

    start = _resident()
    assert list(chunk_encoder.giving_back(work)(iter([BATCH]))) == [BATCH]
    assert held[1] - start > 90 and _resident() - start < 40


def test_steps_of_the_pipeline_give_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(chunk_encoder, "give_back", lambda: given.append(1))
    steps = [_good(monkeypatch), _decontaminated(monkeypatch), sentencepiece_codec.round_trips(Frame(), PATH), sentencepiece_codec.encode_pieces(Frame(), PATH)]
    for n, step in enumerate(steps, 1):
        list(step(iter([EMPTY])))
        assert len(given) == n


def test_a_failing_task_gives_back_too(monkeypatch):
    given = []
    monkeypatch.setattr(chunk_encoder, "give_back", lambda: given.append(1))

    def work(batches):
        raise ValueError
        yield

    with pytest.raises(ValueError):
        list(chunk_encoder.giving_back(work)(iter([])))
    assert given
