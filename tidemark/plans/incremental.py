"""Gold prices kept up to date: only the months that a change reaches are computed and written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import FRAME_ROWS
from tidemark.plans.gold_price import price_indicators
from tidemark.sources.layers import Layers

TABLE = "stock_transations_by_month"
MONTH = "trading_month"
#: The month of undated rows, which come last.
UNDATED = "undated"


def month_of(date: str = "trading_date") -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def reached(counts: DataFrame, changed: DataFrame, rows: int = FRAME_ROWS) -> list[str]:
    """The months in which some indicator may differ: those with a changed row, and for each ticker
    those that hold one of the ``rows`` - 1 rows after it.

    ``counts`` (ticket, month, n) are the rows of each ticker and month, so the windows here are
    bounded by the calendar, and so is the list.
    """
    query = f"""
        WITH told AS (
            SELECT c.ticket, c.month, c.n, d.month IS NOT NULL AS changed
            FROM {{counts}} c LEFT JOIN (SELECT DISTINCT ticket, month FROM {{changed}}) d
                 ON c.ticket <=> d.ticket AND c.month = d.month),
        summed AS (SELECT *, sum(n) OVER (PARTITION BY ticket ORDER BY month ROWS UNBOUNDED PRECEDING) AS upto FROM told),
        known AS (
            SELECT *, last(if(changed, upto, null), true) OVER (
                          PARTITION BY ticket ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM summed)
        SELECT DISTINCT month FROM known WHERE changed OR upto - n - before < {rows - 1}"""
    return sorted(r[0] for r in counts.sparkSession.sql(query, counts=counts, changed=changed).collect())


def lead_in(counts: DataFrame, months: list[str], rows: int = FRAME_ROWS) -> DataFrame:
    """(ticket, month): the other months that hold one of the ``rows`` - 1 rows before a ticker's rows
    in ``months``, however far back they lie."""
    listed = counts.withColumn("wanted", F.col("month").isin(months))
    query = f"""
        WITH summed AS (
            SELECT *, sum(n) OVER (PARTITION BY ticket ORDER BY month DESC ROWS UNBOUNDED PRECEDING) AS onward FROM {{listed}}),
        known AS (
            SELECT *, last(if(wanted, onward, null), true) OVER (
                          PARTITION BY ticket ORDER BY month DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS later
            FROM summed)
        SELECT ticket, month FROM known WHERE NOT wanted AND onward - n - later < {rows - 1}"""
    return counts.sparkSession.sql(query, listed=listed)


def _write(layers: Layers, gold: DataFrame) -> None:
    (
        gold.withColumn(MONTH, month_of())
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(layers.path("gold", TABLE))
    )


def build_prices(layers: Layers, silver_stocks: DataFrame) -> None:
    """All months."""
    _write(layers, price_indicators(silver_stocks))


def refresh_prices(layers: Layers, silver_stocks: DataFrame, changed: DataFrame) -> list[str]:
    """Bring the table up to date after rows of ``silver_stocks`` were added or corrected, and tell the
    months that were written. ``changed`` holds their ticket and trading_date.

    A removed row is told in the same way if its ticker has other rows in that month; a month that has
    lost its last row needs ``build_prices``. Other months keep their files. Of the silver rows those
    of the written months are read, and those of the tickers and months that lead in to them.
    """
    keyed = silver_stocks.withColumn("month", month_of())
    counts, place = layers.stage("month-counts", keyed.groupBy("ticket", "month").agg(F.count("*").alias("n")))
    try:
        months = reached(counts, changed.select("ticket", month_of().alias("month")))
        if not months:
            return []
        before = lead_in(counts, months)
        earlier = [r[0] for r in before.select("month").distinct().collect()]
        wanted = keyed.filter(F.col("month").isin(months))
        # A ticker may be NULL, so the months before are matched null-safely.
        leading = keyed.filter(F.col("month").isin(earlier)).alias("k").join(
            before.alias("b"), F.expr("k.ticket <=> b.ticket AND k.month = b.month"), "left_semi"
        )
        rows = wanted.unionByName(leading).drop("month")
        _write(layers, price_indicators(rows).filter(month_of().isin(months)))
        return months
    finally:
        layers.remove(place)


def read_prices(layers: Layers) -> DataFrame:
    return layers.read("gold", TABLE).drop(MONTH)
