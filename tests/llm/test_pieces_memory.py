"""What a task of the encoder holds at once does not follow the size of its batches."""

from __future__ import annotations

import random
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa

from tidemark.llm import pieces


def _batch(rows, words):
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdeghinorst") for _ in range(r.randint(2, 9))) for _ in range(words)) for _ in range(rows)]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(rows), pa.int64()), "text": pa.array(texts)})


def _lists(batches):
    return [x for b in batches for x in b.column("ids").to_pylist()]


def test_encoding_holds_little_and_blocks_do_not_show(monkeypatch):
    batch, model = _batch(300, 400), SimpleNamespace(value=pieces.read_model())
    run = pieces._encoded(model, 1.0, 1)
    tracemalloc.start()
    try:
        sizes = [b.num_rows for b in run(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 130e6, peak
    assert sum(sizes) == 300
    usual = _lists(run(iter([batch])))
    monkeypatch.setattr(pieces, "BLOCK", 1000)
    monkeypatch.setattr(pieces, "EDGES", 5000)
    assert _lists(run(iter([batch]))) == usual
    texts = [t for b in pieces._decoded(SimpleNamespace(value=model.value["raw"]))(run(iter([batch]))) for t in b.column("text").to_pylist()]
    assert texts == batch.column("text").to_pylist()
