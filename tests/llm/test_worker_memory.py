"""What a worker holds at a time is bounded: character classes come from short texts, keys are handed on."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cytoframe.llm import bpe, setjoin


def peak(work) -> float:
    """MB that Python and numpy took at most."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_character_classes_take_little():
    assert peak(bpe.character_classes.__wrapped__) < 40


def test_keys_are_handed_on():
    g = np.random.default_rng(3)
    text = [" ".join(f"w{x}" for x in g.integers(0, 1 << 30, 120)) for _ in range(12_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(text[i : i + 500])], names=["_text"]) for i in range(0, len(text), 500)]
    held = [sum(len(k.as_py()) // 4 for k in rows.column(1)) for rows in setjoin._post(10, setjoin.Names())(iter(batches))]
    assert sum(held) > 700_000 and max(held) < 500_000
