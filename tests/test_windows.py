from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.windows import chunked
from tidemark.plans.gold_price import price_indicators

DAY0 = dt.date(1969, 11, 1)


def history(seed: int):
    """Dense, sparse, hot, same-day and undated rows, with missing keys and prices."""
    rng = random.Random(seed)
    out = []
    for ticket, step, n in (("DENSE", 1, 300), ("SPARSE", 97, 25), ("HOT", 2, 500), (None, 5, 40)):
        day = DAY0
        for i in range(n):
            day = day + dt.timedelta(days=rng.randint(0, step))
            close = None if rng.random() < 0.05 else Decimal(rng.randint(1, 10**7)).scaleb(-4)
            date = None if rng.random() < 0.02 else day
            out.append((ticket, date, f"{ticket}{i:05d}", close, close, rng.randint(0, 10**6)))
    rng.shuffle(out)
    return out


SCHEMA = (
    "ticket string, trading_date date, stock_hash string, close_price decimal(18,4), "
    "low_price decimal(18,4), trade_volume bigint"
)


@pytest.mark.parametrize("chunk_days", [1, 7, 64, 100_000])
def test_chunked_windows_equal_plain_ones(rows, chunk_days):
    df = rows(history(3), SCHEMA)

    columns = {
        "before": "lag(close_price) OVER ordered",
        "fourth_before": "lag(trade_volume, 4) OVER ordered",
        "total": "sum(trade_volume) OVER rolling",
        "low": "min(close_price) OVER rolling",
        "row_total": "count(*) OVER rolling",
    }
    order = Window.partitionBy("ticket").orderBy(
        F.col("trading_date").asc_nulls_last(), F.col("stock_hash").asc_nulls_last()
    )
    five = order.rowsBetween(-4, 0)
    expected = df.select(
        "*",
        F.lag("close_price").over(order).alias("before"),
        F.lag("trade_volume", 4).over(order).alias("fourth_before"),
        F.sum("trade_volume").over(five).alias("total"),
        F.min("close_price").over(five).alias("low"),
        F.count(F.lit(1)).over(five).alias("row_total"),
    )
    got = chunked(
        df,
        key="ticket",
        date="trading_date",
        tiebreak="stock_hash",
        carry=("close_price", "low_price", "trade_volume"),
        columns=columns,
        chunk_days=chunk_days,
    )
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def bars(rows, closes, lows=None, ticket="META", volumes=None):
    return rows(
        [
            (
                ticket,
                dt.date(2024, 1, 1) + dt.timedelta(days=i),
                f"h{i}",
                None if c is None else Decimal(c),
                None if c is None else Decimal((lows or closes)[i]),
                (volumes or [100] * len(closes))[i],
            )
            for i, c in enumerate(closes)
        ],
        SCHEMA,
    )


def by_date(df):
    return sorted(df.collect(), key=lambda r: r.trading_date)


def test_first_row_of_a_ticker(rows):
    first = by_date(price_indicators(bars(rows, ["10", "11"])))[0]
    assert first.close_price_yesterday is None
    assert first.price_change_1d is None
    assert first.price_change_pct_1d is None
    assert first.volume_1d is None
    assert first.stddev_5d_close_price is None
    assert first.price_percentile_5d is None
    assert first.price_direction_1d == 0
    assert first.ma5_close_price == Decimal("10.00")


def test_flat_window_has_no_range_position(rows):
    last = by_date(price_indicators(bars(rows, ["7.5"] * 6)))[-1]
    assert last.price_percentile_5d is None
    assert last.price_range_5d == 0
    assert last.stddev_5d_close_price == 0
    assert last.price_change_pct_1d == 0
    assert last.price_direction_1d == 0


def test_five_row_values(rows):
    closes = ["100", "1", "2", "3", "4", "6"]
    last = by_date(price_indicators(bars(rows, closes, volumes=[9, 1, 2, 3, 4, 6])))[-1]
    assert last.ma5_close_price == Decimal("3.20")
    assert last.ma5_volume == 3
    assert (last.max_5d_close_price, last.min_5d_close_price) == (6, 1)
    assert last.max_5d_volume == 6
    assert last.price_range_5d == 5
    assert last.price_percentile_5d == 100
    assert last.price_change_pct_1d == 50
    assert last.distance_from_ma5 == Decimal("2.80")
    assert last.distance_pct_from_ma5 == Decimal("87.50")
    assert last.stddev_5d_close_price == 1.92
    assert (last.volume_1d, last.volume_change_1d) == (4, 2)
    assert last.price_direction_1d == 1


def test_missing_and_zero_prices(rows):
    got = by_date(price_indicators(bars(rows, ["10", None, "0", "5"])))
    assert got[1].price_direction_1d == 0
    assert got[1].ma5_close_price == 10
    assert got[2].price_change_1d is None
    assert got[3].price_change_pct_1d is None  # from zero
    assert got[3].price_direction_1d == 1
    assert got[3].ma5_close_price == 5


def test_average_ties_round_away_from_zero(rows):
    got = by_date(price_indicators(bars(rows, ["1.0050"])))[0]
    assert got.ma5_close_price == Decimal("1.01")


def test_same_day_rows_are_all_kept(rows):
    df = bars(rows, ["1", "2"]).unionByName(bars(rows, ["1", "2"]).withColumn("stock_hash", F.lit("z")))
    assert price_indicators(df).count() == 4
