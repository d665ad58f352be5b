"""Analysis datasets over the gold tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import safe_divide
from tidemark.functions.stats import pearson
from tidemark.plans.gold import Gold
from tidemark.plans.silver import Silver

# The ticker of the single-ticker datasets, the factors of the correlation
# matrix, and the whisker length of a box in quartile ranges.
PREFERRED_TICKER = "META"
FACTORS = (
    "close_price", "volume_1d", "daily_sentiment_score", "net_value_flow", "price_change_pct_1d",
)
WHISKER = 1.5

# A change that lies on a fence must count as inside, whatever the order of the arithmetic.
FENCE_PLACES = 9


def master_merge(gold: Gold) -> DataFrame:
    """Prices with the news and insider activity of the same ticker and day.

    Days without news or trades score 0; their other columns stay NULL. News and trades on
    days without a price are lost. Both joins use the whole (ticker, day) key, which spreads
    a hot ticker over its days.
    """
    query = """
        SELECT p.*, n.* EXCEPT (ticket, daily_sentiment_score), i.* EXCEPT (symbol, net_value_flow),
               coalesce(n.daily_sentiment_score, 0) AS daily_sentiment_score,
               coalesce(i.net_value_flow, 0) AS net_value_flow,
               abs(coalesce(n.daily_sentiment_score, 0)) AS sentiment_intensity
        FROM {price} p
        LEFT JOIN {news} n ON p.ticket = n.ticket AND p.trading_date = n.news_date
        LEFT JOIN {insider} i ON p.ticket = i.symbol AND p.trading_date = i.transaction_date"""
    return gold.price.sparkSession.sql(
        query, price=gold.price, news=gold.news, insider=gold.insider
    )


def target_ticker(silver_stocks: DataFrame, preferred: str = PREFERRED_TICKER) -> DataFrame:
    """One row: the preferred ticker if it has prices, else the most frequent one, the lowest
    on ties. The master merge keeps one row per price row, so prices decide."""
    return (
        silver_stocks.filter(F.col("ticket").isNotNull())
        .groupBy("ticket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .orderBy((F.col("ticket") == preferred).desc(), F.col("_rows").desc(), F.col("ticket"))
        .limit(1)
        .select("ticket")
    )


def for_target(silver: Silver, preferred: str = PREFERRED_TICKER) -> Silver:
    """The silver feeds of the target ticker only.

    Its name is found first and brought to the driver, one row by its LIMIT, so that the feeds are
    filtered by a literal: every gold window runs within a ticker, and the filter goes below the
    windows, aggregates and joins, but not below the choice of the first write of a key, which is
    made among all tickers. Without prices the feeds are empty.
    """
    found = target_ticker(silver.stocks, preferred).first()
    name = F.lit(found["ticket"] if found else None)
    return Silver(
        stocks=silver.stocks.filter(F.col("ticket") == name),
        news=silver.news.filter(F.col("ticket") == name),
        insider=silver.insider.filter(F.col("symbol") == name),
    )


def price_and_sentiment(target: DataFrame) -> DataFrame:
    return target.select(
        "ticket", "trading_date", "close_price", "daily_sentiment_score"
    ).orderBy("trading_date")


def price_and_insider(target: DataFrame) -> DataFrame:
    """Flow with its side: Buy above zero, Sell for anything else, zero included."""
    side = F.when(F.col("net_value_flow") > 0, "Buy").otherwise("Sell")
    return target.select(
        "ticket", "trading_date", "close_price", "net_value_flow", side.alias("flow_side")
    ).orderBy("trading_date")


def correlation_matrix(target: DataFrame) -> DataFrame:
    """Pearson matrix of the factors in long form, NULLs dropped pair by pair.

    One aggregation computes every pair once; the mirrored cells reuse it.
    """
    pairs = list(combinations(FACTORS, 2)) + [(f, f) for f in FACTORS]
    cells = target.agg(*[pearson(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a: str, b: str):
        name = f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
        return F.struct(
            F.lit(a).alias("factor_x"), F.lit(b).alias("factor_y"), F.col(f"`{name}`").alias("r")
        )

    return cells.select(F.inline(F.array(*[cell(a, b) for a in FACTORS for b in FACTORS])))


def insider_totals(gold_insider: DataFrame) -> DataFrame:
    """Shares bought and sold per ticker."""
    return (
        gold_insider.filter(F.col("symbol").isNotNull())
        .groupBy(F.col("symbol").alias("ticket"))
        .agg(
            F.sum("total_shares_bought").alias("total_shares_bought"),
            F.sum("total_shares_sold").alias("total_shares_sold"),
        )
        .withColumn("total_shares_sold_abs", F.abs("total_shares_sold"))
        .orderBy("ticket")
    )


def sell_buy_ratio(gold_insider: DataFrame) -> DataFrame:
    """Shares sold for each share bought; NULL where nothing was bought."""
    ratio = safe_divide("cast(total_shares_sold_abs AS DECIMAL(20,0))", "total_shares_bought")
    return insider_totals(gold_insider).selectExpr(
        "ticket",
        "total_shares_bought",
        "total_shares_sold_abs",
        f"round({ratio}, 4) AS sell_buy_ratio",
    )


def contrarian_buys(gold_insider: DataFrame) -> DataFrame:
    """Days on which some insiders bought while the net flow was selling."""
    return gold_insider.filter(
        (F.col("total_shares_bought") > 0) & (F.col("net_shares_flow") < 0)
    ).select(
        "symbol", "transaction_date", "total_shares_bought", "total_shares_sold", "net_shares_flow"
    )


def _value_counts(master: DataFrame) -> DataFrame:
    """How often each change occurs per intensity. Most days have intensity 0, so the rows are
    collapsed by (intensity, value) before anything is grouped by intensity alone."""
    return (
        master.filter(F.col("price_change_pct_1d").isNotNull())
        .groupBy("sentiment_intensity", F.col("price_change_pct_1d").cast("double").alias("change"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def _fences(counts: DataFrame) -> DataFrame:
    """Exact quartiles per intensity (linear interpolation) and the fences around them."""
    quartiles = F.percentile("change", [0.25, 0.5, 0.75], F.col("occurrences"))
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER)
    return (
        counts.groupBy("sentiment_intensity")
        .agg(quartiles.alias("_q"), F.sum("occurrences").alias("row_count"))
        .select(
            "sentiment_intensity",
            "row_count",
            F.col("_q")[0].alias("q1"),
            F.col("_q")[1].alias("median"),
            F.col("_q")[2].alias("q3"),
        )
        .withColumns(
            {
                "low_fence": F.round(F.col("q1") - reach, FENCE_PLACES),
                "high_fence": F.round(F.col("q3") + reach, FENCE_PLACES),
            }
        )
    )


def box_stats(master: DataFrame) -> DataFrame:
    """Box of the daily change per sentiment intensity: quartiles, whisker ends, outlier count.

    A whisker ends at the last value inside its fence and never inside the box.
    """
    counts = _value_counts(master)
    fences = _fences(counts)
    change, n = F.col("change"), F.col("occurrences")
    inside_low, inside_high = change >= F.col("low_fence"), change <= F.col("high_fence")
    ends = (
        counts.join(fences, "sentiment_intensity")
        .groupBy("sentiment_intensity")
        .agg(
            *[F.first(c).alias(c) for c in ("row_count", "q1", "median", "q3")],
            F.min(F.when(inside_low, change)).alias("_low"),
            F.max(F.when(inside_high, change)).alias("_high"),
            F.sum(F.when(inside_low & inside_high, 0).otherwise(n)).alias("outlier_count"),
        )
    )
    return ends.select(
        "sentiment_intensity",
        "row_count",
        "q1",
        "median",
        "q3",
        F.least("_low", "q1").alias("whisker_low"),
        F.greatest("_high", "q3").alias("whisker_high"),
        "outlier_count",
    )


def box_outliers(master: DataFrame) -> DataFrame:
    """The days whose change lies outside the fences of their intensity.

    The fences have one row per intensity; Spark broadcasts them when their measured size
    allows, and otherwise splits the hot intensity of the join.
    """
    fences = _fences(_value_counts(master)).select("sentiment_intensity", "low_fence", "high_fence")
    change = F.col("price_change_pct_1d").cast("double")
    return (
        master.filter(F.col("price_change_pct_1d").isNotNull())
        .join(fences, "sentiment_intensity")
        .filter((change < F.col("low_fence")) | (change > F.col("high_fence")))
        .select("ticket", "trading_date", "sentiment_intensity", "price_change_pct_1d")
    )


def news_volume_points(master: DataFrame) -> DataFrame:
    """News count against volume change; a day that lacks either is no point."""
    return master.select(
        "ticket", "trading_date", "daily_news_count", "volume_change_1d"
    ).dropna(subset=["daily_news_count", "volume_change_1d"])


def hype_correlation(master: DataFrame) -> DataFrame:
    """Correlation of the daily news count with the traded volume, overall and per ticker."""
    return (
        master.filter(F.col("daily_news_count").isNotNull() & F.col("trade_volume").isNotNull())
        .rollup("ticket")
        .agg(
            F.grouping("ticket").alias("_total"),
            F.count(F.lit(1)).alias("day_count"),
            pearson(F.col("daily_news_count"), F.col("trade_volume")).alias("r"),
        )
        .select(
            F.when(F.col("_total") == 1, "overall").otherwise("ticker").alias("scope"),
            "ticket",
            "day_count",
            "r",
        )
    )


def dispersion_by_intensity(master: DataFrame) -> DataFrame:
    """How widely the daily change spreads per sentiment intensity."""
    change = F.col("price_change_pct_1d")
    return (
        master.filter(change.isNotNull())
        .groupBy("sentiment_intensity")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.stddev_samp(change.cast("double")), 6).alias("change_stddev"),
            (F.max(change) - F.min(change)).alias("change_range"),
        )
    )
