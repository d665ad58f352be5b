from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import keys, numeric, sentiment, stats


def one(df, column):
    return df.select(column.alias("x")).head().x


@pytest.fixture
def unit(spark):
    return spark.range(1)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_safe_divide_by_zero_is_null(unit):
    assert one(unit, F.expr(numeric.safe_divide("5.00", "0"))) is None


@pytest.mark.parametrize(
    ("numerator", "denominator", "expected"),
    [("2.01", "200", "1.01"), ("-2.01", "200", "-1.01"), ("1", "3", "33.33"), ("1", "0", None)],
)
def test_ratio_pct_rounds_half_away_from_zero(unit, numerator, denominator, expected):
    n, d = f"cast({numerator} AS DECIMAL(19,4))", f"cast({denominator} AS DECIMAL(18,4))"
    got = one(unit, F.expr(numeric.ratio_pct(n, d)))
    assert got == (None if expected is None else Decimal(expected))


def test_share_pct_of_large_counts_is_rounded_once(unit):
    # 44.9949999...: six digits first would make it 44.995 and then 45.00
    part, whole = 449949999, 1000000000
    assert one(unit, F.expr(numeric.share_pct(str(part), str(whole)))) == Decimal("44.99")


def test_sign_flag(unit):
    flags = [one(unit, F.expr(numeric.sign_flag(v))) for v in ("7", "-2", "0", "cast(NULL AS BIGINT)")]
    assert flags == [1, -1, 0, None]


def test_stock_key_prints_the_session_time(unit):
    date = F.lit(dt.date(2024, 1, 2)).cast("timestamp_ntz")
    assert one(unit, keys.stock_key(F.lit("META"), date)) == md5("META_2024-01-02 00:00:00")
    none = F.lit(None).cast("timestamp_ntz")
    assert one(unit, keys.stock_key(F.lit("META"), none)) == md5("META_NaT")


def test_missing_parts_enter_keys_as_text(unit):
    key = keys.news_key(F.lit("Meta"), F.lit(None).cast("string"), F.lit("2024-01-02T03:04:05Z"))
    assert one(unit, key) == md5("Meta_None_2024-01-02T03:04:05Z")
    key = keys.insider_key(F.lit("M"), F.lit("Ann"), F.lit("2024-01-02"), F.lit(-5), F.lit(10))
    assert one(unit, key) == md5("M_Ann_2024-01-02_-5_10")


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Profits SURGE after upgrade", "good"),
        ("Shares fall, lawsuit looms", "bad"),
        ("gain gain gain but loss and fraud", "bad"),
        ("profit and loss", "neutral"),
        ("nothing to see", "neutral"),
        ("", "neutral"),
        (None, "neutral"),
    ],
)
def test_lexicon_label(unit, text, label):
    assert one(unit, sentiment.lexicon_label(F.lit(text).cast("string"))) == label


def test_lexicon_reads_whole_texts(unit):
    assert one(unit, sentiment.lexicon_label(F.lit("word " * 50_000 + "surge"))) == "good"


@pytest.mark.parametrize(
    ("answer", "label"), [(" Good\n", "good"), ("\tMixed ", "mixed"), (None, "neutral")]
)
def test_normalise_label(unit, answer, label):
    assert one(unit, sentiment.normalise_label(F.lit(answer).cast("string"))) == label


def test_pearson_drops_nulls_pair_by_pair_and_guards_constants(rows):
    df = rows(
        [(1.0, 2.0, 0.1), (2.0, 4.0, 0.1), (3.0, 6.0, 0.1), (None, 9.0, 0.1), (9.0, None, 0.1)],
        "a double, b double, c double",
    )
    got = df.agg(
        stats.pearson(F.col("a"), F.col("b")).alias("ab"),
        stats.pearson(F.col("a"), F.col("c")).alias("ac"),
        stats.pearson(F.col("a"), F.col("a")).alias("aa"),
    ).head()
    assert (got.ab, got.ac, got.aa) == (1.0, None, 1.0)


def test_pearson_of_one_row_or_none_is_null(rows):
    schema = "a double, b double"
    for data in ([(1.0, 2.0)], []):
        assert rows(data, schema).agg(stats.pearson(F.col("a"), F.col("b")).alias("r")).head().r is None


def test_pearson_equals_the_textbook_value(rows):
    df = rows([(1.0, 3.0), (2.0, 1.0), (4.0, 5.0), (7.0, 4.0)], "a double, b double")
    got = df.agg(
        stats.pearson(F.col("a"), F.col("b")).alias("r"), F.round(F.corr("a", "b"), 6).alias("x")
    ).head()
    assert got.r == got.x
