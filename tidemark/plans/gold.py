"""The three gold tables together."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.plans.gold_insider import insider_signals
from tidemark.plans.gold_news import news_signals
from tidemark.plans.gold_price import EVERY, price_indicators
from tidemark.plans.silver import Silver


@dataclass(frozen=True)
class Gold:
    price: DataFrame
    news: DataFrame
    insider: DataFrame


def build(silver: Silver, price_columns: Iterable[str] = EVERY) -> Gold:
    """All gold tables; of the price table only the named columns, if not all are needed."""
    return Gold(
        price=price_indicators(silver.stocks, price_columns),
        news=news_signals(silver.news),
        insider=insider_signals(silver.insider),
    )
