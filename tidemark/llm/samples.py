"""Bounded samples of labelled rows, for classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def likely(h: Column, wanted: int, size: Column) -> Column:
    """Whether a hash is low enough to be among the ``wanted`` lowest of ``size``, with room to spare.

    It leaves about four times as many as wanted, so that no ranking sees a whole class. Should
    chance leave fewer than wanted, the sample is that much smaller.
    """
    return F.pmod(h, F.lit(1 << 40)) * size <= F.lit(4.0 * wanted * (1 << 40))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, text, label, h): of each class the ``rows`` labelled documents with the smallest hash of their id.

    Rows without a label, an id or a text are no part of it. A document with several labels
    counts once, with the highest. Ids alone are ranked, after a first choice by their hash that
    leaves a bounded number of each class, and the texts of those chosen, ``rows`` a class at
    most, are fetched by a broadcast of their ids.
    """
    marked = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
        .withColumn("h", F.xxhash64("id"))
    )
    sizes = marked.groupBy("label").agg(F.count("*").alias("size"))
    chosen = (
        marked.join(F.broadcast(sizes), "label")
        .filter(likely(F.col("h"), rows, F.col("size")))
        .drop("size")
        .withColumn("n", F.expr("row_number() over (partition by label order by pmod(h, 1099511627776), id)"))
        .filter(F.col("n") <= rows)
        .drop("n")
    )
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), "id")
