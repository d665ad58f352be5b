"""Gold: price indicators, one output row per silver bar."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.functions.numeric import ratio_pct, safe_divide, sign_flag
from tidemark.operators.windows import CHUNK_DAYS, chunked

WINDOWED = {
    "close_price_yesterday": "lag(close_price) OVER ordered",
    "volume_1d": "lag(trade_volume) OVER ordered",
    "max_5d_close_price": "max(close_price) OVER rolling",
    "min_5d_close_price": "min(close_price) OVER rolling",
    "min_5d_low_price": "min(low_price) OVER rolling",
    "max_5d_volume": "max(trade_volume) OVER rolling",
    "_close_sum": "sum(close_price) OVER rolling",
    "_close_count": "count(close_price) OVER rolling",
    "_volume_sum": "sum(trade_volume) OVER rolling",
    "_volume_count": "count(trade_volume) OVER rolling",
    "_close_deviation": "stddev_samp(close_price) OVER rolling",
}

# Averages are sums over counts in decimals: ``avg`` of a decimal would keep 8 digits only.
_CHANGE = "close_price - close_price_yesterday"
_RANGE = "max_5d_close_price - min_5d_close_price"
_AVERAGE = safe_divide("_close_sum", "_close_count")
_VOLUME_AVERAGE = safe_divide("cast(_volume_sum AS DECIMAL(20,0))", "_volume_count")

# (close - average) / average, in terms of the sum. The narrow types leave the quotient enough
# digits to be rounded only once.
_TOTAL = "cast(_close_sum AS DECIMAL(19,4))"
_ABOVE_AVERAGE = f"close_price * cast(_close_count AS DECIMAL(1,0)) - {_TOTAL}"

INDICATORS = {
    "price_change_1d": _CHANGE,
    "price_change_pct_1d": ratio_pct(_CHANGE, "close_price_yesterday"),
    "volume_1d": "volume_1d",
    "volume_change_1d": "trade_volume - volume_1d",
    "ma5_close_price": f"round({_AVERAGE}, 2)",
    "ma5_volume": f"round({_VOLUME_AVERAGE}, 0)",
    "max_5d_close_price": "max_5d_close_price",
    "min_5d_close_price": "min_5d_close_price",
    "min_5d_low_price": "min_5d_low_price",
    "max_5d_volume": "max_5d_volume",
    "price_range_5d": f"round({_RANGE}, 2)",
    "price_percentile_5d": ratio_pct("close_price - min_5d_close_price", _RANGE),
    "stddev_5d_close_price": "round(_close_deviation, 2)",
    "distance_from_ma5": f"round(close_price - {_AVERAGE}, 2)",
    "distance_pct_from_ma5": ratio_pct(_ABOVE_AVERAGE, _TOTAL),
    "price_direction_1d": f"coalesce({sign_flag(_CHANGE)}, 0)",
}


KEY = ("ticket", "trading_date")
CARRIED = ("close_price", "low_price", "trade_volume")
EVERY = (*CARRIED, "close_price_yesterday", *INDICATORS)


def _named(texts: Iterable[str], names: Iterable[str]) -> list[str]:
    """The names that the SQL texts mention, in the order of ``names``."""
    words = set(re.findall(r"\w+", " ".join(texts)))
    return [n for n in names if n in words]


def price_indicators(
    silver_stocks: DataFrame, wanted: Iterable[str] = EVERY, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Daily change, five-row averages, extremes, range position, volatility and direction.

    ``wanted`` names the columns beside ticker and date. Only the windows and carried columns
    that they rest on are computed. So a chunk's rows and its lead-in need the same columns,
    and the bars below both are evaluated once.
    """
    wanted = list(wanted)
    sql = [INDICATORS.get(name, name) for name in wanted]
    columns = {n: WINDOWED[n] for n in _named(sql, WINDOWED)}
    if not columns:
        return silver_stocks.select(*KEY, *wanted)
    framed = chunked(
        silver_stocks,
        key="ticket",
        date="trading_date",
        tiebreak="stock_hash",
        carry=_named([*sql, *columns.values()], CARRIED),
        columns=columns,
        chunk_days=chunk_days,
    )
    return framed.selectExpr(*KEY, *[f"{text} AS {name}" for text, name in zip(sql, wanted)])
