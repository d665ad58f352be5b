"""Interval join: points meet the intervals of their key that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days of a bucket. An interval is copied to each bucket it touches, a point is in one.
BUCKET_DAYS = 8


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    key: str,
    date: str,
    interval_key: str | None = None,
    low: str = "low",
    high: str = "high",
    bucket_days: int = BUCKET_DAYS,
    how: str = "inner",
) -> DataFrame:
    """Points beside every interval of their key with ``low <= date <= high`` (dates), all columns of
    both but ``interval_key``; ``how="left"`` keeps points that no interval holds.

    The join is an equality on key and bucket of ``bucket_days`` calendar days, with the bounds
    tested on what meets: no comparison of a key's points with all its intervals, and a hot
    key is dealt out by its calendar. A point without key or date, an interval without a bound, and
    one whose low is after its high match nothing. The column names must differ.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    interval_key = interval_key or key

    def bucket(name: str):
        return F.floor(F.unix_date(F.col(name)) / bucket_days)

    placed = (
        intervals.filter(F.col(low) <= F.col(high))
        .withColumn("_bucket", F.explode(F.sequence(bucket(low), bucket(high))))
        .withColumnRenamed(interval_key, "_key")
    )
    found = points.withColumn("_at", bucket(date)).join(
        placed,
        (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_bucket")) & F.col(date).between(F.col(low), F.col(high)),
        how,
    )
    return found.drop("_at", "_bucket", "_key")
