from __future__ import annotations

import itertools

import numpy as np
import pytest

from tidemark.llm import lattice
from tidemark.llm.components import merge_labels
from tidemark.llm.queries import QUERIES


def plain(ids, labels, vectors):
    """{index: (n_links, component)} by all pairs."""
    x = np.array(vectors, dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([[p == q for q in labels] for p in labels])
    close = (x @ x.T >= 0.98) & same
    np.fill_diagonal(close, False)
    root = merge_labels(len(ids), *np.nonzero(close))
    least = {}
    for i, r in zip(ids, root):
        least[r] = min(i, least.get(r, i))
    return [(int(n), int(least[r])) for n, r in zip(close.sum(axis=1), root)]


def clustered(seed, n=400, centres=25, noise=0.02, dimension=64):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((centres, dimension))[rng.integers(0, centres, n)]
    return (x + noise * np.sqrt(dimension / 8) * rng.standard_normal((n, dimension))).astype(np.float32)


@pytest.mark.parametrize("seed,noise,chunk", [(1, 0.02, 8192), (2, 0.05, 8192), (3, 0.03, 50)])
def test_against_all_pairs(spark, rows, monkeypatch, seed, noise, chunk):
    monkeypatch.setattr(lattice, "CHUNK", chunk)
    x = clustered(seed, noise=noise)
    ids, labels = list(range(1000, 1400)), [i % 2 for i in range(400)]
    want = plain(ids, labels, x)
    data = [(i, l, v.tolist()) for i, l, v in zip(ids, labels, x)]
    found = {r.vec_id: r for r in lattice.near_vectors(rows(data, "vec_id long, label int, embedding array<float>")).collect()}
    links = sum(n for n, _ in want)
    assert links and sum(found[i].n_links for i in ids) >= 0.99 * links
    assert np.mean([found[i].n_links <= n and found[i].component_id >= c for i, (n, c) in zip(ids, want)]) == 1
    assert np.mean([(found[i].n_links, found[i].component_id) == w for i, w in zip(ids, want)]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = plain([r.vec_id for r in table], [r.label for r in table], [r.embedding for r in table])
    found = {r.vec_id: r for r in QUERIES["op10_embedding_dedup"](spark, sf).collect()}
    assert [(found[r.vec_id].n_links, found[r.vec_id].component_id) for r in table] == want


def test_more_blocks_keep_the_recall():
    """Pairs just above the threshold meet in some table, whatever the cells are made of."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((3000, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.981 * a + np.sqrt(1 - 0.981**2) * side
    for blocks, tables in ((1, 5), (2, 10), (3, 20)):
        ha, na = lattice.cells(a, tables, blocks)
        hb, nb = lattice.cells(b, tables, blocks)
        met = ((ha == hb) | (ha == nb) | (na == hb)).any(axis=1)
        assert met.mean() > 0.97


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1.5, 1.5, (200, 8))
    got = lattice.decode(x)
    around = np.concatenate([lattice.ROOTS, [2 * np.eye(8)[i] * s for i, s in itertools.product(range(8), (1, -1))]])
    best = ((x - got) ** 2).sum(axis=1)
    for step in around:
        assert (((x - got - step) ** 2).sum(axis=1) >= best - 1e-12).all()
    assert (np.abs(lattice.ROOTS).sum(axis=1) > 0).all() and len(np.unique(lattice.ROOTS, axis=0)) == 240


def test_nulls_zeros_copies_and_clashing_columns(rows):
    v, nan = [1.0, 2.0, 3.0], float("nan")
    data = [
        (5, 1, v, "x"), (3, 1, v, "x"), (3, 1, v, "x"), (8, 1, [2.0, 4.0, 6.1], "x"), (9, 2, v, "x"), (10, None, v, "x"),
        (11, 1, None, "x"), (12, 1, [0.0, 0.0, 0.0], "x"), (13, 1, [nan, 1.0, 1.0], "x"), (14, 1, [float("inf"), 1.0, 1.0], "x"),
        (15, 1, [None, 1.0, 1.0], "x"), (16, 1, [], "x"), (17, 1, [1.0, 2.0], "x"), (None, 3, v, None),
        (18, 4, [1e300, 2e300, 3e300], "x"), (19, 4, [1e-300, 2e-300, 3e-300], "x"),
    ]
    vectors = rows(data, "vec_id long, label int, embedding array<double>, rep string")
    found = lattice.near_vectors(vectors).collect()
    assert len(found) == len(data)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in found if r.vec_id is not None)
    assert got == [
        (3, 3, 3), (3, 3, 3), (5, 3, 3), (8, 3, 3), *((i, 0, i) for i in range(9, 18)), (18, 1, 18), (19, 1, 18),
    ]
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None] == [(0, None, False)]
    assert lattice.near_vectors(vectors.limit(0)).count() == 0
