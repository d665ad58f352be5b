"""What several operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import lead_workers_here
from tidemark.session import shared_dir as shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lead_workers_here(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a missing key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that one of these operators wrote and no later plan reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and where: like ``cut``, but later steps
    read only the columns they need."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    The files survive lost executors, so nothing above is run again.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, or with underscores added until no column has that name."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def kept_rows(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of ``docs`` for each (id, text_hash) of ``kept``, and all rows without a doc_id.

    Repeated rows are numbered first: each map task keeps one of them, so a row that makes up a
    third of the table is not shuffled whole. A text is shuffled once, and the kept ones meet it
    in that shuffle's partitions.
    """
    hashed = free_name("kept_hash", docs.columns)
    number = free_name("repeat_no", docs.columns)
    wanted = kept.filter("id is not null").select(
        F.col("id").cast(docs.schema[doc_id].dataType).alias(doc_id), F.col("text_hash").alias(hashed)
    )
    found = (
        docs.filter(F.col(doc_id).isNotNull())
        .withColumn(hashed, F.xxhash64(F.col(text)))
        .withColumn(number, F.expr(f"row_number() over (partition by `{doc_id}`, `{hashed}` order by `{doc_id}`, `{hashed}`)"))
        .filter(F.col(number) == 1)
        .join(wanted.distinct(), [doc_id, hashed], "left_semi")
        .select(*[f"`{c}`" for c in docs.columns])
    )
    return found.unionByName(docs.filter(F.col(doc_id).isNull()))
