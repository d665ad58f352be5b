"""Data-quality checks of the gold tables. A check reports failures; it never hides them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.gold import Gold


@dataclass(frozen=True)
class Expectations:
    table: str
    key: tuple[str, str]
    not_null: Sequence[str]
    accepted: dict[str, tuple[int, ...]] = field(default_factory=dict)


# The checks declared for the gold tables.
INSIDER_CHECKS = Expectations(
    table="stock_insider_transations",
    key=("symbol", "transaction_date"),
    not_null=(
        "symbol", "transaction_date", "distinct_insiders_active", "total_transactions_count",
    ),
    accepted={"rolling_5_day_sentiment": (1, -1, 0), "is_activity_cluster": (0, 1)},
)
NEWS_CHECKS = Expectations(
    table="stock_news",
    key=("ticket", "news_date"),
    not_null=("ticket", "news_date", "daily_news_count"),
)
PRICE_CHECKS = Expectations(
    table="stock_transations",
    key=("ticket", "trading_date"),
    not_null=("ticket", "trading_date", "close_price", "trade_volume"),
    accepted={"price_direction_1d": (1, -1, 0)},
)


def _composite_key(checks: Expectations) -> Column:
    """Key text, NULL as soon as one part is NULL."""
    first, second = checks.key
    return F.concat(F.col(first), F.lit("-"), F.col(second).cast("string"))


def duplicate_keys(df: DataFrame, checks: Expectations) -> DataFrame:
    """Keys that occur more than once, with their row counts. NULL keys are not compared."""
    key = _composite_key(checks)
    return (
        df.select(key.alias("key_text"))
        .filter(F.col("key_text").isNotNull())
        .groupBy("key_text")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
        .select(F.lit(checks.table).alias("table_name"), "key_text", "row_count")
    )


def null_key_rows(df: DataFrame, checks: Expectations) -> DataFrame:
    """The rows whose composite key is NULL."""
    first, second = checks.key
    return df.filter(_composite_key(checks).isNull()).select(
        F.lit(checks.table).alias("table_name"),
        F.col(first).alias("key_ticket"),
        F.col(second).alias("key_date"),
    )


def null_counts(df: DataFrame, checks: Expectations) -> DataFrame:
    """NULLs per required column, counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in checks.not_null])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
        for c in checks.not_null
    ]
    return counted.select(
        F.lit(checks.table).alias("table_name"), F.inline(F.array(*rows))
    )


def unaccepted_counts(df: DataFrame, checks: Expectations) -> DataFrame:
    """Rows per restricted column whose value is outside its list (NULL passes), in one pass."""
    counted = df.agg(
        *[F.count_if(~F.col(c).isin(list(v))).alias(c) for c, v in checks.accepted.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
        for c in checks.accepted
    ]
    return counted.select(
        F.lit(checks.table).alias("table_name"), F.inline(F.array(*rows))
    )


def _each(gold: Gold) -> list[tuple[DataFrame, Expectations]]:
    return [
        (gold.insider, INSIDER_CHECKS),
        (gold.news, NEWS_CHECKS),
        (gold.price, PRICE_CHECKS),
    ]


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_unique(gold: Gold) -> DataFrame:
    return _together([duplicate_keys(df, checks) for df, checks in _each(gold)])


def check_null_keys(gold: Gold) -> DataFrame:
    return _together([null_key_rows(df, checks) for df, checks in _each(gold)])


def check_null_columns(gold: Gold) -> DataFrame:
    return _together([null_counts(df, checks) for df, checks in _each(gold)])


def check_accepted_values(gold: Gold) -> DataFrame:
    return _together(
        [unaccepted_counts(df, checks) for df, checks in _each(gold) if checks.accepted]
    )
