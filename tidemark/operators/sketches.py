"""Distinct counts over frames: sketches that merge, and the exact way beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import FRAME_ROWS

#: 2 ** 14 registers: a standard error of 0.8 percent, 16 KB a sketch at most.
LG_REGISTERS = 14
#: What an estimate may be off, as a share of the exact count: more than five standard errors.
BOUND = 0.05


def daily_sketches(df: DataFrame, *, key: str, date: str, value: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """``key``, ``date``, ``sketch``: a HyperLogLog sketch of the values of each key and day.

    Sketches are made in each map task and merged, so a hot key and day sends one sketch a task.
    NULL values are not counted. Stored sketches can be merged later without the rows.
    """
    return df.groupBy(key, date).agg(F.hll_sketch_agg(value, lg_registers).alias("sketch"))


def merged_over_frames(sketches: DataFrame, *, key: str, date: str, rows: int = FRAME_ROWS) -> DataFrame:
    """``key``, ``date``, ``estimate``: distinct values of the last ``rows`` dated rows of a key, by merging
    their sketches. One row per key and day comes in, so the windows are bounded by the calendar."""
    query = f"""
        SELECT `{key}`, `{date}`, hll_sketch_estimate(hll_union_agg(sketch) OVER (
                   PARTITION BY `{key}` ORDER BY `{date}` ASC NULLS LAST
                   ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)) AS estimate
        FROM {{sketches}}"""
    return sketches.sparkSession.sql(query, sketches=sketches)


def exact_over_frames(df: DataFrame, *, key: str, date: str, value: str, rows: int = FRAME_ROWS) -> DataFrame:
    """``key``, ``date``, ``distinct_values``: the exact count.

    The values of a frame's days are added up, less those said again: two days of a frame that say a value,
    and no day between them, count it once too often. So each value of a day is shuffled as often as it is
    told from others and no more. A day is looked up for pairs of days, not for values: of those only the pairs
    stay that are no further apart than the longest frame. Each step over values reads the same distinct rows.
    """
    by_date = f"PARTITION BY `{key}` ORDER BY `{date}` ASC NULLS LAST"
    frame = f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
    query = f"""
        WITH seen AS (SELECT DISTINCT `{key}`, `{date}`, `{value}` FROM {{df}}),
        counted AS (SELECT `{key}`, `{date}`, count(`{value}`) AS _values FROM seen GROUP BY `{key}`, `{date}`),
        days AS (
            SELECT `{key}`, `{date}`, _values, row_number() OVER ({by_date}) AS _number,
                   sum(_values) OVER ({by_date} {frame}) AS _in_frame,
                   datediff(`{date}`, min(`{date}`) OVER ({by_date} {frame})) AS _span
            FROM counted),
        speaking AS (SELECT * FROM days WHERE _values > 0),
        said AS (
            SELECT `{key}`, `{date}`, `{value}`,
                   lag(`{date}`) OVER (PARTITION BY `{key}`, `{value}` ORDER BY `{date}` ASC NULLS LAST) AS _before
            FROM seen),
        again AS (
            SELECT `{key}`, `{date}`, _before, count(`{value}`) AS _values
            FROM said
            WHERE _before IS NOT NULL
                  AND (`{date}` IS NULL OR datediff(`{date}`, _before) <= (SELECT max(_span) FROM speaking))
            GROUP BY `{key}`, `{date}`, _before),
        twice AS (
            SELECT `{key}`, _to, sum(_values) AS _values
            FROM (SELECT a.`{key}`, a._values, explode(sequence(d._number, b._number + {rows - 1})) AS _to
                  FROM again a
                  JOIN speaking d ON a.`{key}` <=> d.`{key}` AND a.`{date}` <=> d.`{date}`
                  JOIN speaking b ON a.`{key}` <=> b.`{key}` AND a._before <=> b.`{date}`
                  WHERE d._number < b._number + {rows})
            GROUP BY `{key}`, _to)
        SELECT d.`{key}`, d.`{date}`, d._in_frame - coalesce(t._values, 0L) AS distinct_values
        FROM days d LEFT JOIN twice t ON d.`{key}` <=> t.`{key}` AND d._number = t._to"""
    return df.sparkSession.sql(query, df=df)
