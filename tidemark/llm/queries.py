"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, lattice, line_dedup, negatives, packing, quality, repair, sharding, simhash, suffix_tree, toxicity, warc
from tidemark.llm.common import cut, new_folder, remainder, remove, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    dictionaries = langid.learn_dictionaries(docs.filter("not held_out"))
    return langid.identify(docs.drop("lang"), dictionaries).drop("text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = sharding.shard_rows(rows, dict.fromkeys(range(8), 1.0))
    rows = sharding.shard_rows(rows, dict.fromkeys(range(9), 1.0), column="grown_shard")
    return sharding.number_slots(rows, order=("doc_id", "text_crc32")).withColumn("law", F.lit("key"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 5) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score_toxicity(docs, model).drop("text")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 7) == 2
    found = suffix_tree.score_texts(docs, docs.filter(~held_out))
    return found.withColumn("held_out", held_out)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = quality.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return quality.score_quality(docs, model).drop("text")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fault of a kind that the crc32 of ``conv_id:turn`` decides; a null is one space."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(told[0], F.lit(":"), told[1]).cast("binary")) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair.digests(repair.repair(rows, dropped="dropped"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = new_folder(spark, "warc")
    warc.write_archives(warc.plan_captures(pages), folder)
    records = cut(warc.read_archives(spark, folder, payload=False))
    remove(spark, folder)
    found = warc.resolve_revisits(cut(warc.assemble(records)))
    own, kind = F.col("referred").isNull(), pages.schema["page_id"].dataType.simpleString()
    return found.select(
        warc.capture_key(kind).alias("page_id"),
        F.when(own, F.col("payload_bytes")).otherwise(F.col("referred.payload_bytes")).alias("payload_bytes"),
        F.when(own, F.col("payload_digest")).otherwise(F.col("referred.payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("referred.key").cast(kind).alias("refers_to"),
        "target_uri",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_line_dedup,
        op3_sharding,
        op4_simhash,
        op5_toxicity,
        op6_decontaminate,
        op7_lm_scoring,
        op8_packing,
        op9_quality,
        op10_embedding_dedup,
        op11_conversation_repair,
        op12_hard_negatives,
        op13_warc,
    )
}
