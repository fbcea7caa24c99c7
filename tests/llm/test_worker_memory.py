"""Memory of the Python workers of the pipeline's stages."""

import tracemalloc

import numpy as np
import pandas as pd
import psutil

from basketgraph.llm import common, op5_suffix_dedup


def test_a_step_gives_freed_memory_back():
    kept = []

    def step(batches):
        for n in batches:
            held = [b"x" * 50_000 + bytes([i % 7]) for i in range(n)]
            kept.append(bytes(50_000))  # lies behind the freed pieces, so that the heap cannot just end earlier
            yield len(held)
            del held

    before = psutil.Process().memory_info().rss
    assert list(common.lean(step)(iter([3000]))) == [3000]
    assert psutil.Process().memory_info().rss - before < 50e6 and kept


def test_slices_follow_bytes():
    batch = pd.DataFrame({"text": ["a" * n for n in (10, 3 << 20, 5, 5, 2 << 20, 0)]})
    parts = list(common.slices(batch, batch["text"].map(len)))
    assert len(parts) > 1 and pd.concat(parts).equals(batch)
    assert list(common.slices(batch.iloc[:0], batch["text"].iloc[:0].map(len))) == []


def test_suffix_sorting_of_a_block_stays_small():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 123, 400_000, dtype=np.uint8).tobytes()
    n, at = rng.integers(1, 70, 10_000), rng.integers(0, 399_000, 10_000)
    rows = [(i, 0, int(s), int(k), text[s : s + k + op5_suffix_dedup.LENGTH - 1]) for i, (k, s) in enumerate(zip(n, at, strict=True))]
    block = pd.DataFrame(rows, columns=["doc", "v", "start", "n", "data"])
    tracemalloc.start()
    found = op5_suffix_dedup.repeated_windows(block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * block["data"].map(len).sum()
    seen, want = set(), set()
    for doc, _, start, k, data in rows:
        for j in range(k):
            window = data[j : j + op5_suffix_dedup.LENGTH]
            if window in seen:
                want.add((doc, start + j))
            seen.add(window)
    assert {(r.doc, r.start + j) for r in found.itertuples() for j in range(r.n)} == want


def test_a_block_without_repeats():
    block = pd.DataFrame([(1, 0, 0, 1, bytes(range(100)))], columns=["doc", "v", "start", "n", "data"])
    assert len(op5_suffix_dedup.repeated_windows(block)) == 0
