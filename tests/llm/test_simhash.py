from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import connected_components, merge_labels
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = []
    for c in (text or "").translate(table):
        if c in " \t\n\x0b\x0c\r":
            words.append("")
        elif not words:
            words.append(c)
        else:
            words[-1] += c
    words = [w for w in words if w]
    if not words:
        return 0
    runs = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    ones = [0] * 64
    for run in runs:
        h = xxhash.xxh64(" ".join(run).encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def plain_components(prints):
    distinct = sorted(set(prints))
    f = np.array(distinct, dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4)
    return dict(zip(distinct, merge_labels(len(f), a, b)))


def test_fingerprints_and_components_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    label = plain_components(prints.values())
    least = {}
    for d, p in prints.items():
        least[label[p]] = min(d, least.get(label[p], d))
    found = QUERIES["op4_simhash"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == least[label[prints[r.doc_id]]]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "Ä é", "A b C", "a b c d", "x\x0by z\x1cq w e", "B " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("size,centres,flips", [(1, 1, 0), (7, 2, 2), (400, 30, 5), (1500, 1, 3), (1500, 200, 7)])
def test_index_links_what_all_pairs_link(size, centres, flips):
    rng = np.random.default_rng(size + flips)
    f = rng.integers(0, 1 << 63, centres, dtype=np.uint64)[rng.integers(0, centres, size)]
    for _ in range(flips):
        f = f ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64))
    f = np.unique(f)
    rng.shuffle(f)
    a, b = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4)
    want, got = merge_labels(len(f), a, b), simhash.GrayIndex(f).components()
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("count", [10, 10_000_000, 10**9, 10**12])
def test_any_two_close_fingerprints_share_a_mask(count):
    masks = simhash.block_plan(count)
    rng = np.random.default_rng(3)
    for _ in range(300):
        flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(m & flipped == 0 for m in masks)


def test_nulls_copies_ties_and_clashing_columns(rows, spark):
    docs = rows(
        [
            (5, "same words in this text", "a", 1),
            (3, "Same WORDS in this text", "b", 2),
            (3, "Same WORDS in this text", "b", 2),
            (9, None, "c", 3),
            (8, "", None, 4),
            (None, "quite another text than those above", "d", 5),
        ],
        "doc_id long, text string, fp string, component_id int",
    )
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {(5, 3), (3, 3), (9, 8), (8, 8), (None, None)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted([docs.collect()[i] for i in (1, 4, 5)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_a_chain_and_a_hub_are_one_component_each(spark, rows):
    chain = [(i, i + 1) for i in range(100, 220)]
    hub = [(1000, 2000 + i) for i in range(300)]
    found = connected_components(rows([*chain, *hub, (7, 7), (None, 3), (100, 101)], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {
        **{i: 100 for i in range(100, 221)},
        **{i: 1000 for i in [1000, *range(2000, 2300)]},
    }


def test_equal_ids_with_different_texts_are_told_apart(rows):
    copy = "words that another document has as well and has first"
    own = "a text that no other document of all these holds anywhere"
    data = [(1, copy, 1), (5, copy, 2), (5, own, 3), (5, own, 3), (7, own, 4), (8, "quite alone", 5), (8, "quite other text", 6)]
    kept = simhash.keep_one(rows(data, "doc_id long, text string, n int"))
    assert sorted(r.n for r in kept.collect()) == [1, 3, 5, 6]
