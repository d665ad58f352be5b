"""Daily sentiment from articles in the order they land: late ones count, repeated ones don't."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators.labelling import label_with_lexicon
from tidemark.plans import silver
from tidemark.plans.gold_news import LABELS
from tidemark.sources import landing
from tidemark.streaming.batches import store_batches

#: How long after the newest article seen an older one, or a copy, is still expected.
DELAY = "7 days"

COUNTS = ("daily_news_count", *[f"daily_{n}_news_count" for n in LABELS])


def daily_counts(articles: DataFrame, names: DataFrame, delay: str = DELAY) -> DataFrame:
    """Counters per ticker and day, as ``plans.gold_news.daily_news`` has them, of a stream of flattened,
    labelled articles; ``names`` is the bronze ticker map.

    The stream has two states, and the watermark bounds both: the keys of articles of twice the last
    ``delay``, in which a repeated article is found, and the counters of days that are not over.
    An article that lands later than ``delay`` behind the newest is dropped, copies of old ones
    with it. Articles without a time of publication never count.
    """
    keyed = landing.key_news(articles).withColumn("event_time", F.col("published_at").cast("timestamp"))
    different = keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["hash"])
    named = silver.ticker_map(names).select("ticket", F.upper("company").alias("_company"))
    return (
        different.filter(F.col("description").isNotNull())
        .join(named, F.upper("company") == F.col("_company"), "left")
        .groupBy("ticket", F.window("event_time", "1 day").alias("day"))
        .agg(
            F.count("*").alias("daily_news_count"),
            *[F.count_if(F.col("sentiment") == n).alias(f"daily_{n}_news_count") for n in LABELS],
        )
        .select("ticket", F.to_date("day.start").alias("news_date"), *COUNTS)
    )


def follow_articles(
    articles: DataFrame, names: DataFrame, out: str, progress: str, delay: str = DELAY
) -> StreamingQuery:
    """Take in what has landed and stop. The days that changed in a micro-batch go to a folder of
    its own under ``out``, so a batch that runs twice after a failure overwrites itself."""
    return store_batches(daily_counts(articles, names, delay), out, progress, mode="update")


def latest_days(spark: SparkSession, out: str) -> DataFrame:
    """The newest counters of each ticker and day that the batches under ``out`` hold."""
    counters = F.struct(*COUNTS)
    return (
        spark.read.parquet(out)
        .groupBy("ticket", "news_date")
        .agg(F.max_by(counters, "batch").alias("_newest"))
        .select("ticket", "news_date", "_newest.*")
    )


def landed_articles(spark: SparkSession, path: str) -> DataFrame:
    """The articles of result pages as they land under ``company=<name>/``, labelled by the lexicon.
    Pages that hold no usable articles add none."""
    pages = (
        spark.readStream.schema("value string, company string").option("wholetext", True).text(path)
        .withColumnRenamed("value", "payload")
    )
    judged = landing.judge_payloads(pages, "payload", schemas.NEWS_PAYLOAD, "articles")
    return label_with_lexicon(landing.flatten_news(judged))
