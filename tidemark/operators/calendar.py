"""Windows over the last calendar days, and sessions of activity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import CHUNK_DAYS


def recent_days(
    df: DataFrame,
    *,
    key: str,
    date: str,
    days: int,
    columns: Mapping[str, str],
    carry: Sequence[str],
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """``key``, ``date`` and ``carry`` with window columns over ``recent``: the rows of a key whose date is
    one of the last ``days`` calendar days, the row's own day included whole.

    Columns are SQL text such as ``sum(volume) OVER recent``. Undated rows see each other only. A
    key's history is cut into calendar chunks and the windows run per key and chunk. A row of
    the last ``days`` - 1 days of a chunk is copied to the next one as lead-in, which is
    dropped again: one shuffle, and no window over a key's whole history.
    """
    if not 1 <= days <= chunk_days:
        raise ValueError("days must be between 1 and the length of a chunk")
    listed = ", ".join(f"`{c}`" for c in carry)
    added = ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    chunk = f"cast(floor(unix_date(`{date}`) / {chunk_days}) AS INT)"
    at_end = f"pmod(unix_date(`{date}`), {chunk_days}) > {chunk_days - days}"
    query = f"""
        WITH dealt AS (
            SELECT `{key}`, `{date}`, {listed}, _place._chunk, _place._lead_in
            FROM (SELECT *, explode(filter(array(
                      struct({chunk} AS _chunk, false AS _lead_in),
                      if({at_end}, struct({chunk} + 1 AS _chunk, true AS _lead_in), null)), p -> p IS NOT NULL)) AS _place
                  FROM {{df}})),
        framed AS (
            SELECT *, {added} FROM dealt
            WINDOW recent AS (PARTITION BY `{key}`, _chunk ORDER BY `{date}`
                              RANGE BETWEEN INTERVAL '{days - 1}' DAY PRECEDING AND CURRENT ROW))
        SELECT * EXCEPT (_chunk, _lead_in) FROM framed WHERE NOT _lead_in"""
    return df.sparkSession.sql(query, df=df)


def activity_sessions(df: DataFrame, *, key: str, date: str, gap_days: int, totals: Mapping[str, Column]) -> DataFrame:
    """``key``, ``session_start``, ``session_end`` (dates) and ``totals`` of each run of days with activity in
    which no two neighbours are more than ``gap_days`` apart.

    ``df`` should hold one row per key and day, so that a hot key is bounded by the calendar. Undated
    rows are in no session; a NULL key has sessions like others.
    """
    # Half a day more, so that days which are the whole gap apart are inside whatever the end's kind.
    gap = F.session_window(F.col(date).cast("timestamp"), f"{gap_days} days 12 hours")
    return (
        df.filter(F.col(date).isNotNull())
        .groupBy(F.col(key), gap.alias("_session"))
        .agg(F.min(date).alias("session_start"), F.max(date).alias("session_end"), *[c.alias(n) for n, c in totals.items()])
        .drop("_session")
    )
