"""From raw documents to packed training sequences: five stages, each over all that the last one kept.

1. language_id: drops texts without a letter and long texts whose language can't be told.
2. line_dedup: cuts passages of three lines or more that an earlier document or place has.
3. simhash_dedup: keeps the document of the smallest id of each group of near copies: texts whose
   fingerprints of four-word shingles differ in four bits at most.
4. decontaminate: drops documents that hold ten words in a row of a benchmark item.
5. packing: lays the documents' tokens out in sequences of 1024.

All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, line_dedup, packing, simhash
from tidemark.llm.common import free_name, lead_workers_here, new_folder, remove, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Dictionaries come from the documents' own labels; labels decide nothing about a document."""
    lead_workers_here(spark)
    found = langid.identify(docs, langid.learn_dictionaries(docs))
    return found.filter(~F.col(free_name("rejected", docs.columns))).select(*[f"`{c}`" for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No document is dropped; ``n_chars`` follows the text that is left."""
    found = line_dedup.dedup_lines(docs).select(*[f"`{c}`" for c in docs.columns])
    if "n_chars" not in docs.columns:
        return found
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", F.length("text").cast(kind)).select(*[f"`{c}`" for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lead_workers_here(spark)
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lead_workers_here(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("decontaminate", drop_leaks),
    ("packing", pack),
]

#: Language identification and tokens are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written to the shared folder and read again, and what
    the stage before wrote goes then."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
