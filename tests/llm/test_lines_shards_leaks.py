from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import decontaminate, line_dedup, sharding
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def python_in(df) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---- line dedup


def test_line_dedup_of_whole_table(spark, documents):
    df = QUERIES["op2_line_dedup"](spark, SF)
    assert not python_in(df)
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in df.collect()} == brute.line_dedup(documents)


LINES = st.lists(st.sampled_from(["a", "b", "", " ", "c d"]), max_size=12).map("\n".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(LINES, min_size=1, max_size=6))
def test_line_dedup_of_any_lines(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == brute.line_dedup(enumerate(texts))


def test_line_dedup_nulls_repeats_and_clashing_columns(rows):
    passage = "one\ntwo\nthree\nfour"
    data = [
        (1, None, 5, "x", 1),
        (2, "", 5, "x", 1),
        (3, passage, 5, None, 1),
        (3, passage, 5, None, 1),
        (None, "zero\n" + passage, 5, "y", 1),
        (4, passage + "\nfive", None, "y", 1),
        (5, "\n" * 50_000, 5, "y", 1),
    ]
    docs = rows(data, "doc_id long, text string, n_lines int, mark_id string, h1 int")
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines_", "n_removed"]
    got = sorted(((r.doc_id, r.text, r.n_lines_, r.n_removed) for r in found.collect()), key=str)
    # A null id comes first, so the passage stays in that row.
    assert got == sorted(
        [
            (1, None, 0, 0),
            (2, "", 1, 0),
            (3, "", 4, 4),
            (3, "", 4, 4),
            (None, "zero\n" + passage, 5, 0),
            (4, "five", 5, 4),
            (5, "\n" * 50_000, 50_001, 0),
        ],
        key=str,
    )
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# ---- sharding


def plain_shard(key, shards):
    import hashlib

    best = None
    for s in shards:
        u = (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        score = (1.0 / -math.log(u), -s)
        best = max(best or score, score)
    return -best[1]


def test_sharding_of_whole_table(spark, documents):
    df = QUERIES["op3_sharding"](spark, SF)
    assert not python_in(df)
    found = df.collect()
    text = dict(documents)
    assert sorted(r.doc_id for r in found) == sorted(text)
    for r in found:
        data = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == plain_shard(r.doc_id, range(8))
        assert r.grown_shard == plain_shard(r.doc_id, range(9))
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own)))


def test_weights_and_movement(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = {0: 1.0, 1: 2.0, 2: 1.0}
    both = sharding.shard_rows(sharding.shard_rows(keys, weights), {**weights, 7: 1.0}, column="grown").collect()
    sizes = Counter(r.shard for r in both)
    assert abs(sizes[1] / 20_000 - 0.5) < 0.02 and abs(sizes[0] / 20_000 - 0.25) < 0.02
    assert all(r.grown in (r.shard, 7) for r in both)
    assert abs(sum(r.grown == 7 for r in both) / 20_000 - 0.2) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("doc_id"), {0: 0.0})


def test_slots_with_hot_rows_nulls_and_clashing_columns(spark, rows, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    data = [(1, "x", 0)] * 100 + [(None, None, 0), (2, None, 1), (3, "y", 1)]
    docs = rows(data, "doc_id long, _size string, shard int")
    found = sharding.number_slots(docs).collect()
    assert Counter(tuple(r)[:3] for r in found) == Counter(data)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.number_slots(docs.limit(0)).count() == 0


# ---- decontamination


def test_decontamination_of_whole_table(spark, documents):
    df = QUERIES["op6_decontaminate"](spark, SF)
    assert not python_in(df)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.decontaminate(documents, items)
    found = df.collect()
    assert len(found) == len(documents)
    for r in found:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want[r.doc_id]
        assert r.contaminated == (r.n_hit > 0)
    assert any(r.contaminated for r in found)


ITEMS = [
    (1, "alpha Beta gamma-delta É1 zeta eta theta iota kappa lambda mu"),
    (2, "short one"),
    (10, "SHORT one"),
    (3, ""),
    (4, None),
    (None, "nobody names this"),
]
TEXTS = [
    (1, "so alpha beta gamma delta É1 zeta eta theta iota kappa LAMBDA mu nu"),
    (2, "alpha beta gamma delta é1 zeta eta theta iota kappa"),
    (3, "a short, one. short-one short ones"),
    (4, None),
    (5, ""),
    (6, "... !!"),
    (7, "short one " * 3000),
    (8, "nobody names this"),
]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_windows_of_several_lengths(rows, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    docs, items = rows(TEXTS, "doc_id long, text string"), rows(ITEMS, "item_id long, text string")
    found = decontaminate.find_contamination(docs, items).collect()
    want = brute.decontaminate(TEXTS, ITEMS)
    assert {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in found} == {d: w[:3] for d, w in want.items()}
    assert {r.doc_id for r in found if r.contaminated} == {1, 3, 7, 8}


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_a_text_of_100_000_words_both_ways(rows, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    words = [f"w{i * 7919 % 10007}" for i in range(100_000)]
    item = " ".join(words[50_000:50_030])
    data = [(1, " ".join(words)), (1, " ".join(words)), (None, "w1 w2"), (2, None), (3, item)]
    docs, items = rows(data, "doc_id long, text string"), rows([(1, item), (2, "never there")], "item_id long, text string")
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_contamination(docs, items).collect())
    want = brute.decontaminate([(1, " ".join(words)), (3, item)], [(1, item), (2, "never there")])
    assert found == [
        ("1", 100_000, want[1][1], ["1"]), ("1", 100_000, want[1][1], ["1"]), ("2", 0, 0, []), ("3", 30, 30, ["1"]), ("None", 2, 0, [])
    ]


def test_the_shuffled_way_carries_windows_not_texts(rows):
    def probes(n):
        docs = rows([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id long, text string")
        keyed = decontaminate.window_probes(docs, [2, 10])
        return keyed.selectExpr("sum(length(own)) as bytes", "count(*) as n").first()

    (small, _), (large, n) = probes(2000), probes(8000)
    assert n == 8000 - 1 + 8000 - 9 and large < 5 * small


def test_dropping_documents_or_spans(rows):
    data = [(d, t, "x", d) for d, t in TEXTS] + [(None, "short one", None, None), (7, "clean", "x", 7), (9, "clean", "x", 1), (9, "clean", "x", 1)]
    docs = rows(data, "doc_id long, text string, window string, hits int")
    items = rows(ITEMS, "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        [r for r in data if r[1] is None or (r[0] in (2, 5, 6, 9) or r[1] == "clean")], key=str
    )
    cleaned = decontaminate.drop_contaminated(docs, items, remove="spans").collect()
    texts = {r.doc_id: r.text for r in cleaned if r.text != "clean"}
    assert len(cleaned) == len(data)
    assert texts[1] == "so nu" and texts[3] == "a short ones" and texts[7] == "" and texts[2] == TEXTS[1][1]
    assert decontaminate.find_contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.find_contamination(docs.limit(0), items).count() == 0
    assert decontaminate.find_contamination(docs, items).count() == len(data)
