"""Gold: daily news sentiment per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.numeric import share_pct
from tidemark.functions.sentiment import BAD, GOOD, NEUTRAL
from tidemark.operators.windows import day_windows

LABELS = (GOOD, BAD, NEUTRAL)


def _per_label(template: str) -> str:
    return ", ".join(template.format(name=name) for name in LABELS)


def daily_news(silver_news: DataFrame) -> DataFrame:
    """Counters per ticker and day. Unmatched articles form a group with a NULL ticker."""
    counters = _per_label("count_if(news_sentiment = '{name}') AS daily_{name}_news_count")
    query = f"""
        SELECT ticket, to_date(published_at) AS news_date, count(*) AS daily_news_count, {counters}
        FROM {{news}} GROUP BY ALL"""
    return silver_news.sparkSession.sql(query, news=silver_news)


def news_signals(silver_news: DataFrame) -> DataFrame:
    """Daily counters and shares with their totals over the last five days that had news.

    A good article scores +1 and a bad one -1. The windows run on one row per ticker and day,
    so a hot ticker is bounded by the calendar.
    """
    shares = ", ".join(
        f"{share_pct(f'daily_{name}_news_count', 'daily_news_count')} AS daily_{name}_news_pct"
        for name in LABELS
    )
    totals = _per_label("sum(daily_{name}_news_count) OVER rolling AS rolling_5d_{name}_news_count")
    score = f"daily_{GOOD}_news_count - daily_{BAD}_news_count"
    query = f"""
        SELECT ticket, news_date, daily_news_count, {_per_label("daily_{name}_news_count")}, {shares},
               sum(daily_news_count) OVER rolling AS rolling_5d_news_count, {totals},
               {score} AS daily_sentiment_score,
               sum({score}) OVER rolling AS rolling_5d_sentiment_score
        FROM {{days}} {day_windows("ticket", "news_date")}"""
    return silver_news.sparkSession.sql(query, days=daily_news(silver_news))
