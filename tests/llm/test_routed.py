"""Sketch and exact blocks, of every size, against plain counts; and that a group's work follows its keys, not the blocks there are."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import routed as R

U = np.uint64


@pytest.mark.parametrize("small", [64 << 30, 1 << 22, 1 << 14])
@pytest.mark.parametrize("blocks", [1, 3])
def test_sketch_never_misses_a_repeated_key(monkeypatch, small, blocks):
    monkeypatch.setattr(R, "SMALL", small)
    rng = np.random.default_rng(blocks)
    pool = rng.integers(0, 1 << 64, 3000, dtype=U)
    groups = [np.concatenate([rng.choice(pool, 300), rng.integers(0, 1 << 64, 500, dtype=U)]) for _ in range(5)]
    rows = [m for g, h in enumerate(groups) for kind in (0, 1) for m in R.cell_messages(h, g, kind, blocks)]
    replies = []
    for kind, block in sorted({m[:2] for m in rows}):
        table = R.table_of([m for m in rows if m[:2] == (kind, block)], R.MESSAGE)
        replies += R.merge_cells(blocks)((pa.scalar(kind), pa.scalar(block)), table).to_pylist()
    count = Counter(np.concatenate(groups).tolist())
    for g, h in enumerate(groups):
        mine = [r for r in replies if r["g"] == g]
        hit = R.CellFilter(R.table_of([tuple(r.values()) for r in mine], R.REPLY), blocks)(h)
        again = np.array([count[k] > 1 for k in h.tolist()])
        assert hit[again].all() and hit[~again].mean() < 0.02


@pytest.mark.parametrize("blocks", [1, 7, 1000])
def test_exact_answers(blocks):
    rng = np.random.default_rng(blocks)
    pool = rng.integers(0, 1 << 64, (400, 2), dtype=U)
    pool[:50, 0] = pool[0, 0]  # keys that differ in their second half alone
    groups = [pool[rng.integers(0, 400, 150)] for _ in range(4)]
    count = Counter(map(tuple, np.concatenate(groups).tolist()))
    rows, known = [], []
    for g, keys in enumerate(groups):
        hi, lo, n, _ = R.distinct_pairs(keys[:, 0], keys[:, 1])
        known.append((hi, lo))
        rows += R.pair_messages(hi, lo, n, g, blocks)
    replies = []
    for block in sorted({m[1] for m in rows}):
        replies += R.merge_pairs((pa.scalar(block),), R.table_of([m for m in rows if m[1] == block], R.MESSAGE)).to_pylist()
    for g, (hi, lo) in enumerate(known):
        table = R.table_of([tuple(r.values()) for r in replies if r["g"] == g], R.REPLY)
        assert R.pair_answers(hi, table, blocks).tolist() == [count[k] > 1 for k in zip(hi.tolist(), lo.tolist())]


def test_work_follows_keys_not_blocks():
    """With so many blocks, a walk over them would not end."""
    h = np.random.default_rng(1).integers(0, 1 << 64, 2000, dtype=U)
    for blocks in (100, 1 << 31):
        assert 0 < len(R.cell_messages(h, 0, 0, blocks)) <= len(h) and 0 < len(R.pair_cuts(np.sort(h), blocks)) <= len(h)
    assert R.pair_cuts(h[:0], 5) == [] and R.cell_messages(h[:0], 0, 0, 5) == []


def test_sizes_grow_slowly():
    assert [R.group_bytes(t) >> 20 for t in (0, 64 << 30, 1 << 40, 16 << 40, 100 << 40)] == [16, 16, 32, 64, 64]
    bits = [R.cell_bits(max(1, (t * 2 // 3) >> R.CELL_BITS)) for t in (0, 64 << 30, 1 << 40, 16 << 40, 100 << 40)]
    assert bits[0] == 22 and bits[-1] == 26 and bits == sorted(bits)
