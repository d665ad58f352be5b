"""Silver: typed, renamed feeds with upper-case tickers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE = "decimal(18,4)"


@dataclass(frozen=True)
class Bronze:
    stocks: DataFrame
    news: DataFrame
    insider: DataFrame
    ticker_map: DataFrame


@dataclass(frozen=True)
class Silver:
    stocks: DataFrame
    news: DataFrame
    insider: DataFrame


def _whole(column: str, name: str) -> str:
    """A whole number from any numeric input; fractions round, as a SQL cast to bigint does."""
    return f"cast(round({column}) AS BIGINT) AS {name}"


def stamped(df: DataFrame) -> DataFrame:
    """Add the load time; kept apart from the typed columns because it differs per run."""
    return df.withColumn("updated_at", F.current_timestamp())


def stocks(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(
        "cast(hash AS STRING) AS stock_hash",
        "upper(cast(ticket AS STRING)) AS ticket",
        "cast(date AS DATE) AS trading_date",
        *[f"cast({f} AS {PRICE}) AS {f}_price" for f in ("close", "high", "low", "open")],
        _whole("volume", "trade_volume"),
    )


def insider(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(
        "cast(hash AS STRING) AS insider_transactions_hash",
        "upper(cast(symbol AS STRING)) AS symbol",
        "cast(name AS STRING) AS name",
        _whole("share", "share"),
        _whole("change", "change"),
        "cast(filing_date AS DATE) AS filing_date",
        "cast(transaction_date AS DATE) AS transaction_date",
        f"cast(transaction_price AS {PRICE}) AS transaction_price",
        "cast(transaction_code AS STRING) AS transaction_code",
    )


def ticker_map(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(
        "upper(cast(ticket AS STRING)) AS ticket", "cast(company AS STRING) AS company"
    )


def news(bronze: DataFrame, bronze_map: DataFrame) -> DataFrame:
    """Typed articles that have a description, with the ticker of their company if it is known.

    Companies match whatever their case. There is no broadcast hint: Spark broadcasts the map
    when its measured size allows, and otherwise shuffles and splits a hot company's rows.
    """
    query = """
        SELECT cast(n.hash AS STRING) AS hash_news, cast(n.company AS STRING) AS company, m.ticket,
               cast(n.title AS STRING) AS news_titel,
               cast(n.description AS STRING) AS news_description, cast(n.url AS STRING) AS news_url,
               cast(n.sentiment AS STRING) AS news_sentiment,
               cast(n.published_at AS TIMESTAMP_NTZ) AS published_at
        FROM {news} n LEFT JOIN {names} m ON upper(n.company) = upper(m.company)
        WHERE n.description IS NOT NULL"""
    return bronze.sparkSession.sql(query, news=bronze, names=ticker_map(bronze_map))


def build(bronze: Bronze) -> Silver:
    return Silver(
        stocks=stocks(bronze.stocks),
        news=news(bronze.news, bronze.ticker_map),
        insider=insider(bronze.insider),
    )
