"""Hard negatives against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import hard_negatives


def plainly(rows, every, positives=5, negatives=3):
    """Rows (id, label, whole numbers) by Python integers."""
    found = []
    for i, label, v in rows:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            far = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            found += [(i, j, n + 1, s[1], score, s[0]) for n, s in enumerate(far[:negatives])]
    return sorted(found, key=str)


def mined(frame, rows, every, **options):
    table = frame([(i, label, [x / 256 for x in v]) for i, label, v in rows], "vec_id long, label int, embedding array<double>")
    found = hard_negatives.mine(table, F.col("id") % every == 0, **options).collect()
    return sorted((tuple(row) for row in found), key=str)


@pytest.mark.parametrize("seed, dims, spread, broadcast", [(1, 6, 4, 1 << 20), (2, 33, 100, 0), (3, 12, 2**30, 1 << 20), (4, 1, 2, 0)])
def test_against_plain_loops(frame, seed, dims, spread, broadcast):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-spread, spread + 1, (4, dims))
    rows = []
    for i in range(300):
        label = int(rng.integers(0, 4))
        noise = rng.integers(-spread // 2, spread // 2 + 1, dims)
        rows.append((i, label, (centres[rng.integers(0, 4)] + noise).tolist()))
    rows += [(1000 + i, i % 3, rows[40][2]) for i in range(60)]  # copies: ties, across labels
    rows += [(2000 + i, i % 2, [int(i % 5)] * 3) for i in range(20) if dims != 3]  # vectors of another length
    assert mined(frame, rows, 20, block_rows=50, pack_rows=7, broadcast_bytes=broadcast) == plainly(rows, 20)


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0]
    rows = [(0, 1, good), (1, 1, good), (2, 2, [0.7, 1.3]), (None, 2, [0.8, 1.2]), (3, None, good), (4, 2, None), (5, 2, [nan, 1.0]),
            (6, 2, [inf, 0.0]), (7, 2, [None, 1.0]), (8, 2, [0.5]), (9, 2, []), (50, 1, []), (2, 2, [0.7, 1.3])]
    table = frame([(*row, 1, "x") for row in rows], "vec_id long, label int, embedding array<double>, id long, pack string")
    found = hard_negatives.mine(table, F.col("id") % 50 == 0).collect()
    # 256 * (256 * 1.0 + 2 * ...): positive 5 * 65536 = 327680; negatives 0.7, 1.3 (179, 332) and 0.8, 1.2 (204, 307)
    assert sorted((tuple(row) for row in found), key=str) == sorted(
        [(0, 1, 1, 2, 327680, 215808), (0, 1, 2, 2, 327680, 215808), (0, 1, 3, None, 327680, 209408)], key=str
    )


def test_bitmap_shrinks_before_all_dimensions_are_read():
    rng = np.random.default_rng(7)
    columns = np.floor(rng.normal(0, 3, (64, 5000)))
    anchor = np.floor(rng.normal(0, 1, 64))
    anchor[:6] = [900, -800, 700, 650, -600, 500]  # six large magnitudes decide
    labels = np.zeros(5000, "<i8")
    block = hard_negatives.Block(64, 5000, np.arange(5000, dtype="<i8").tobytes(), labels.tobytes(), columns.tobytes())
    seen = []

    def keep(lower, upper):
        seen.append(len(lower))
        return upper >= hard_negatives.kth_largest(lower, 5)

    rows, scores = hard_negatives.scan(block, anchor, 0, 5000, np.ones(5000, bool), keep)
    exact = anchor @ columns
    assert seen[1] < 500 and set(np.argsort(-exact)[:5]) <= set(rows.tolist())
    assert (scores == exact[rows]).all()
