"""The pipeline's stages against brute force, one by one, each on what the last one kept."""

from __future__ import annotations


import public_tokenizers
import pytest
import tokenizers

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from tests.llm.test_packing import check_layout
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, input rows, output rows)] with every stage written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        after = docs.collect()
        found[name] = (before, after)
        before = after
    return found


def test_stages_are_in_order_and_registered(stages):
    assert list(stages) == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    for name, (before, after) in stages.items():
        if name != "packing":
            assert before[0].asDict().keys() == after[0].asDict().keys()


def test_language_id_keeps_clean_documents_as_they_are(stages):
    before, after = stages["language_id"]
    assert len(after) >= 0.98 * len(before) and set(after) <= set(before)
    assert all(any(c.isalpha() for c in r.text or "") for r in after)


def test_line_dedup_equals_brute_force(stages):
    before, after = stages["line_dedup"]
    want = brute.line_dedup([(r.doc_id, r.text) for r in before])
    assert len(after) == len(before)
    for r in after:
        assert r.text == want[r.doc_id][0] and r.n_chars == len(r.text)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["simhash_dedup"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
    label, least = plain_components(prints.values()), {}
    for doc, p in prints.items():
        least[label[p]] = min(doc, least.get(label[p], doc))
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    assert set(after) <= set(before)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.decontaminate([(r.doc_id, r.text) for r in before], items)
    assert set(after) == {r for r in before if not want[r.doc_id][1]}
    assert len(after) < len(before)


def test_packing_lays_out_every_token(stages):
    before, after = stages["packing"]
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [2] for r in before}
    check_layout(after, ids)


def test_run_equals_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, found.drop("sequence_id", "offset").collect())) == sorted(
        str(r) for r in spark.createDataFrame(stages["packing"][1]).drop("sequence_id", "offset").collect()
    )


def test_nulls_and_an_empty_table_pass_through(spark, rows, tmp_path):
    ddl = "doc_id long, text string, lang string, source string, n_chars long, score double"
    text = "one sentence of plain words stands here\nand another one\nand a third one"
    data = [(1, text, "en", "s", 71, 1.0), (2, None, None, None, None, None), (None, text + " that differs a bit", "en", "s", 5, 1.0), (1, text, "en", "s", 71, 1.0), (4, "", "en", "s", 0, None)]
    for n, docs in enumerate((rows(data, ddl), rows([], ddl))):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{n}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{name}")
        assert docs.count() == (2 if n == 0 else 0)
