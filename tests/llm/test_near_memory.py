"""Memory of a worker that signs short documents or compares a block: by the size of the block, not of the batch."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import near_dedup as N


def _peak(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1] / 2**20
    tracemalloc.stop()
    return out, peak


def test_signing_many_short_documents():
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(5000)}" for _ in range(30)) for _ in range(2000)]
    b = pa.RecordBatch.from_pydict({"doc_id": range(2000), "tag": [0] * 2000, "text": texts})
    signed = N._signed(N.M, N.BANDS, N.WIDTH, N.SHINGLE)
    out, peak = _peak(lambda: list(signed(iter([b]))))
    got = [x for o in out for x in o.column("sig").to_pylist()]
    alone = N._nibbles(N.signatures([t.encode() for t in texts[:3] + texts[-3:]]))
    assert got[:3] + got[-3:] == [x.tobytes() for x in alone] and len(got) == 2000
    assert peak < 100


def test_a_block_whose_nodes_are_all_alike():
    n = 1024
    node = [i.to_bytes(16, "big") for i in np.random.default_rng(1).permutation(n).tolist()]
    t = pa.table({"cell": [0] * n, "large": [True] * n, "i": [0] * n, "j": [1] * n, "band": [0] * n, "nth": [0] * n,
                  "own": [k // 512 for k in range(n)], "node": pa.array(node, pa.binary()), "root": pa.array(node, pa.binary()),
                  "sig": pa.array([b"x" * 256] * n, pa.binary()), "keys": pa.array([[k] * 24 for k in range(n)], pa.list_(pa.int64()))})
    out, peak = _peak(lambda: N._across(N.enough(N.M, N.AT_LEAST))(t))
    pairs = set()
    for row in out.to_pylist():
        assert len(row["nodes"]) <= 2 * N.TILE
        own = np.frombuffer(row["pairs"], "<i2").reshape(-1, 2).tolist()
        pairs |= {frozenset((row["nodes"][x], row["nodes"][y])) for x, y in own}
    assert pairs == {frozenset((a, b)) for a in node[:512] for b in node[512:]}
    assert peak < 20
