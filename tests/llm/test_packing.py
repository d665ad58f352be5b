from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoder():
    return packing.ChunkEncoder(*map(packing.vocabulary, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))


def check_layout(rows, ids_of):
    """Every id once, pieces cut as told, sequences gapless and within capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, ids in ids_of.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        at = 0
        for r in pieces:
            assert r.start == at and (r.length == 1024 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return len(by_sequence)


def test_whole_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs}
    rows = QUERIES["op8_packing"](spark, SF).collect()
    sequences = check_layout(rows, ids)
    assert sequences <= 1.01 * packing.lower_bound(np.array([r.length for r in rows])) + 1


TEXTS = st.lists(
    st.sampled_from(["a", "The", "don't", "'s", " ", "  ", "\n", " \n", "\n ", "é", "ß,", "***", "12", " ", "\x1c", "<|endoftext|>", "<|", "日本", "​"]),
    max_size=12,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_tokenizer(plain, text):
    own = test_ids_are_those_of_the_tokenizer.__dict__.setdefault("own", encoder())
    assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_ids_after_the_memory_is_full(monkeypatch, plain):
    monkeypatch.setattr(packing, "MEMORY", 5)
    text = " ".join(f"word{i % 17}" for i in range(100))
    assert np.frombuffer(encoder().encode(text), "<u4").tolist() == plain.encode(text).ids


@given(st.lists(st.integers(1, 1024), max_size=60))
def test_bound_holds_and_bins_fit(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, offsets, rooms = packing.best_fit_decreasing(lengths)
    assert packing.lower_bound(lengths) <= len(rooms)
    for b in range(len(rooms)):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offsets[own])]
        assert np.array_equal(offsets[own], np.cumsum(lengths[own]) - lengths[own])
        assert lengths[own].sum() == 1024 - rooms[b]


def test_bound_sees_what_sums_do_not():
    assert packing.lower_bound(np.full(10, 600)) == 10
    assert packing.lower_bound(np.full(9, 342)) == 5


def test_parts_with_gaps_exchange(spark, rows, plain):
    docs = [(i, "word " * (1 + (i * 37) % 700)) for i in range(600)]
    ids = {i: plain.encode(t).ids + [2] for i, t in docs}
    found = packing.pack_documents(rows(docs, "doc_id long, text string"), part=100).collect()
    sequences = check_layout(found, ids)
    bound = packing.lower_bound(np.array([r.length for r in found]))
    assert bound <= sequences <= bound * 1.03


def test_nulls_long_texts_repeats_and_clashing_columns(spark, rows, plain):
    docs = rows(
        [(1, None, 7, "x"), (2, "", 7, "x"), (3, "a b " * 3000, 7, "x"), (None, "one", None, None), (4, "same", 1, "y"), (4, "same", 1, "y")],
        "doc_id long, text string, turn int, part string",
    )
    found = packing.pack_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in found if r.doc_id != 3) == [(0, 2), (1, 1), (2, 1), (4, 2), (4, 2)]
    long = sorted((r.piece, r.length) for r in found if r.doc_id == 3)
    total = len(plain.encode("a b " * 3000).ids) + 1
    assert sum(n for _, n in long) == total and all(n == 1024 for p, n in long if p)
    assert packing.pack_documents(docs.limit(0)).count() == 0
