"""Row windows over time series.

Two kinds of input occur. After a group-by on (key, date) a key has at most one row per
calendar day, so a plain window by key is bounded whatever the raw skew was. Raw rows have no
such bound: one ticker may hold a third of them. ``chunked`` evaluates windows that look a
fixed number of rows back without ever bringing a key's whole history into one task.

Window columns are SQL text over the named windows ``ordered`` (the rows of a key by date),
``rolling`` (the last five of them) and ``running`` (all up to the current one).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# Fixed value: rows in a rolling frame, the current one included.
FRAME_ROWS = 5

CHUNK_DAYS = 64
_UNDATED_CHUNK = 2**31 - 1


def named_windows(partition: str, order: str) -> str:
    """The WINDOW clause that defines the three named windows."""
    spec = f"PARTITION BY {partition} ORDER BY {order}"
    return f"""WINDOW
        ordered AS ({spec}),
        rolling AS ({spec} ROWS BETWEEN {FRAME_ROWS - 1} PRECEDING AND CURRENT ROW),
        running AS ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def day_windows(key: str, date: str) -> str:
    """Windows within a key whose rows are already unique per day; undated rows come last."""
    return named_windows(key, f"{date} ASC NULLS LAST")


def chunked(
    df: DataFrame,
    *,
    key: str,
    date: str,
    tiebreak: str,
    carry: Sequence[str],
    columns: Mapping[str, str],
    lookback: int = FRAME_ROWS - 1,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Add window columns over ``ordered`` and ``rolling`` that reach at most ``lookback`` rows
    back within ``key``.

    A key's history is cut into calendar chunks and the windows run per (key, chunk). Each
    chunk is preceded by copies of the ``lookback`` rows before it, which are dropped again
    at the end. Those rows come from the chunk tails: Spark keeps the last rows of each
    chunk per map task, and every chunk in existence has at least one row, so the tails of
    the ``lookback`` chunks before it always hold the rows needed, however sparse the key is.
    """
    carried = [date, tiebreak, *carry]
    listed = ", ".join(carried)
    from_row = ", ".join(f"_row.{c}" for c in carried)
    added = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    order = f"{date} ASC NULLS LAST, {tiebreak} ASC NULLS LAST"
    newest_first = f"{date} DESC NULLS FIRST, {tiebreak} DESC NULLS FIRST"
    query = f"""
        WITH chunks AS (
            SELECT {key}, {listed},
                   coalesce(cast(floor(unix_date({date}) / {chunk_days}) AS INT), {_UNDATED_CHUNK}) AS _chunk
            FROM {{df}}),
        tails AS (
            SELECT {key}, _chunk, sort_array(collect_list(struct(-_back AS _position, {listed}))) AS _tail
            FROM (SELECT *, row_number() OVER (PARTITION BY {key}, _chunk ORDER BY {newest_first}) AS _back
                  FROM chunks)
            WHERE _back <= {lookback}
            GROUP BY {key}, _chunk),
        before AS (
            SELECT {key}, _chunk, flatten(collect_list(_tail) OVER (
                       PARTITION BY {key} ORDER BY _chunk ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING))
                   AS _rows
            FROM tails),
        lead_in AS (
            SELECT {key}, _chunk,
                   explode(slice(_rows, greatest(size(_rows) - {lookback - 1}, 1), {lookback})) AS _row
            FROM before),
        together AS (
            SELECT {key}, {listed}, _chunk, false AS _lead_in FROM chunks
            UNION ALL
            SELECT {key}, {from_row}, _chunk, true FROM lead_in),
        framed AS (
            SELECT *, {added} FROM together {named_windows(f"{key}, _chunk", order)})
        SELECT * EXCEPT (_chunk, _lead_in) FROM framed WHERE NOT _lead_in"""
    return df.sparkSession.sql(query, df=df)
