"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import negatives

DDL = "vec_id long, embedding array<float>, label int"


def plain(data, share=10):
    """Sorted result rows by all pairs, in Python's integers."""
    kept = set()
    for id_, vec, label in data:
        if label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            kept.add((id_, tuple(math.floor(256 * float(np.float32(x))) for x in vec), label))
    result = []
    for a in kept:
        if a[0] is None or a[0] % share:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[1], b[1])), math.inf if b[0] is None else b[0], b)
            for b in kept if b[0] != a[0] and len(b[1]) == len(a[1])
        ]
        scored.sort(key=lambda s: s[:2])
        for score, _, p in [s for s in scored if s[2][2] == a[2]][:5]:
            fit = [s for s in scored if s[2][2] != a[2] and -80 * score <= -100 * s[0] <= -100 * score]
            result += [(a[0], p[0], i + 1, n[0], -score, -s) for i, (s, _, n) in enumerate(fit[:5])]
    return sorted(result, key=str)


def run(df, **kw):
    found = negatives.hard_negatives(df, anchors="id % 10 = 0", **kw)
    assert [f"{n} {t}" for n, t in found.dtypes] == [
        "anchor_id bigint", "positive_id bigint", "rank int", "negative_id bigint", "positive_score bigint", "negative_score bigint"
    ]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("dim,spread,at_once", [(3, 0.05, 8192), (16, 0.3, 7), (64, 1.0, 8192)])
def test_clustered_vectors_equal_all_pairs(rows, dim, spread, at_once):
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((6, dim))
    # A hot label holds half of all rows; coarse values make many equal scores.
    data = [
        (i, [float(x) for x in np.round((centres[rng.integers(6)] + spread * rng.standard_normal(dim)) * 4) / 4], int(rng.choice([0, 0, 0, 1, 2])))
        for i in range(700)
    ]
    assert run(rows(data, DDL), at_once=at_once) == plain(data)


def test_nulls_zeros_repeats_lengths_and_large_values(rows):
    rng = random.Random(4)
    data = [(i, [rng.uniform(-1, 1) for _ in range(4)], rng.randrange(3)) for i in range(150)]
    data += [data[0], data[10], (10, [1.0, 1.0, 1.0, 1.0], 1), (20, [1.0, 0.5, 0.0, 0.0], 2)]
    data += [(300, None, 1), (310, [1.0, None, 2.0, 0.0], 1), (320, [float("nan"), 1.0, 1.0, 1.0], 1), (330, [float("inf"), 1.0, 1.0, 1.0], 1)]
    data += [(340, [0.0] * 4, 1), (341, [0.0] * 4, 1), (342, [0.0] * 4, 2), (350, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 1)]
    data += [(400 + i, [rng.uniform(-1, 1) for _ in range(7)], i % 2) for i in range(30)]
    data += [(500, [], 1), (501, [], 1), (502, [], 2)]
    data += [(600 + i, [1e6 + i, 1e6, -1e5 * i, 5.0, 7.0], i % 2) for i in range(25)]
    assert run(rows(data, DDL)) == plain(data)


def test_empty_table_and_clashing_columns(rows):
    assert run(rows([], DDL)) == []
    data = [(i, [float(i % 7), 1.0], i % 2) for i in range(40)]
    more = rows([(*r, "x", 1, 2.0) for r in data], DDL + ", id string, rank int, score double")
    assert run(more) == plain(data)
    assert run(rows([(10, [1.0], 1), (20, [1.0], 1)], DDL)) == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (2, 8, 64):
        x = np.floor(256 * rng.standard_normal((300, dim)))
        x[:40] = np.floor(x[0] * rng.uniform(0.5, 2, (40, 1)))
        x[7] = 0
        refs = negatives.directions(x[rng.permutation(300)[:50]])
        norms, theta = negatives.angles(x, refs)
        for start in range(0, 300, 20):
            part = slice(start, start + 20)
            low, high = negatives.score_bounds(
                norms, theta, norms[part].min(keepdims=True), norms[part].max(keepdims=True),
                theta[part].min(axis=0)[None], theta[part].max(axis=0)[None],
            )
            scores = x @ x[part].T
            assert (low <= scores).all() and (scores <= high).all()


def test_blocks_far_away_are_not_scored():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2, 32)) * 100
    near, far = (c + rng.standard_normal((64, 32)) for c in x)
    refs = negatives.directions(np.vstack([near, far]), 4)
    norms, theta = negatives.angles(near[:1], refs)
    block_norms, block_theta = negatives.angles(far, refs)
    _, high = negatives.score_bounds(
        norms, theta, block_norms.min(keepdims=True), block_norms.max(keepdims=True), block_theta.min(axis=0)[None], block_theta.max(axis=0)[None]
    )
    assert high[0, 0] < (near[1:] @ near[0]).min()
