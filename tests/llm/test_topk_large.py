"""Exact top-k where components leave the exact range of doubles."""

import random

import numpy as np
import pytest

from sievemark.llm import topk

LONG = (1 << 63) - 1


def plain(rows, k):
    """rows: id → components; exact integers, saturated like the operator's."""
    ints = {i: [max(-LONG - 1, min(LONG, int(np.floor(float(x) * 256)))) for x in v] for i, v in rows.items()}
    out = []
    for i, v in ints.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ints.items() if j != i)
        out += [(i, r + 1, j, max(-LONG - 1, min(LONG, -s))) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 1e5, 1e9, 1e15, 1e200])
def test_large_components(spark, size):
    rng = random.Random(int(np.log10(size)))
    rows = {i: [rng.choice([rng.gauss(0, size), rng.gauss(0, 1), float(rng.randrange(3))]) for _ in range(6)] for i in range(120)}
    for i in range(90, 100):  # near ties beyond the digits of a double
        rows[i] = [rows[0][0] + (i % 3) / 256, *rows[0][1:]]
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.vec_id >= 0, k=4).collect())
    assert got == plain(rows, 4)


def test_scores_beyond_a_long_keep_their_order(spark):
    rows = {1: [123456789.5, 1.25], 2: [987654321.25, 3.0], 3: [987654321.25, 3.5], 4: [987654321.25, 2.5]}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.vec_id == 1).collect())
    assert got == [r for r in plain(rows, 5) if r[0] == 1] and [r[2] for r in got] == [3, 2, 4]
