"""As-of match: each row meets the nearest row of its key in the other table, by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.windows import CHUNK_DAYS

BACKWARD, FORWARD = "backward", "forward"


def _listed(alias: str, names: Sequence[str]) -> str:
    return ", ".join(f"{alias}.`{n}`" for n in names)


def as_of(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str,
    time: str,
    right_key: str | None = None,
    right_time: str | None = None,
    carry: Sequence[str] = (),
    direction: str = BACKWARD,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Every row of ``left``, with ``right_time`` and ``carry`` of the row of ``right`` that has the same
    key and the latest time at or before its own (``backward``), or the earliest at or after it
    (``forward``); NULL where there is none.

    Times are dates or timestamps of one type. Of several right rows of one key and time the one
    of the greatest carried values counts going backward, of the least going forward. A left row
    without key or time matches nothing, a right row without them is no match. The new columns must
    not be named like one of ``left``'s.

    Both sides go into one union and a window takes the last right row seen. The windows run per
    key and chunk of ``chunk_days`` calendar days, so a hot key splits; the row that a chunk begins
    with comes from the ends of the chunks before it, one row for each key and chunk.
    """
    if direction not in (BACKWARD, FORWARD):
        raise ValueError("direction is 'backward' or 'forward'")
    right_key, right_time = right_key or key, right_time or time
    back = direction == BACKWARD
    nearest, order = ("max", "ASC") if back else ("min", "DESC")
    own = ", ".join(f"l.`{c}`" for c in left.columns)
    found = ", ".join(f"_match.`{c}` AS `{c}`" for c in (right_time, *carry))
    chunk = f"cast(floor(unix_date(cast({{}} AS DATE)) / {chunk_days}) AS INT)"
    query = f"""
        WITH lefts AS (
            SELECT struct({own}) AS _row, l.`{key}` AS _key, l.`{time}` AS _time, {chunk.format(f'l.`{time}`')} AS _chunk
            FROM {{left}} l),
        rights AS (
            SELECT r.`{right_key}` AS _key, r.`{right_time}` AS _time, {chunk.format(f'r.`{right_time}`')} AS _chunk,
                   struct({_listed('r', [right_time, *carry])}) AS _right
            FROM {{right}} r WHERE r.`{right_key}` IS NOT NULL AND r.`{right_time}` IS NOT NULL),
        ends AS (SELECT _key, _chunk, {nearest}(_right) AS _end FROM rights GROUP BY _key, _chunk),
        asked AS (SELECT DISTINCT _key, _chunk FROM lefts WHERE _key IS NOT NULL AND _chunk IS NOT NULL),
        entering AS (
            SELECT _key, _chunk, last(_end, true) OVER (
                       PARTITION BY _key ORDER BY _chunk {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _right
            FROM asked FULL JOIN ends USING (_key, _chunk)),
        together AS (
            SELECT _key, _chunk, _time, 2 AS _side, _row, null AS _right FROM lefts
            WHERE _key IS NOT NULL AND _time IS NOT NULL
            UNION ALL SELECT _key, _chunk, _time, 1, null, _right FROM rights
            UNION ALL SELECT _key, _chunk, null, 0, null, _right FROM entering WHERE _right IS NOT NULL),
        matched AS (
            SELECT _row, _side, last(_right, true) OVER (
                       PARTITION BY _key, _chunk ORDER BY _side = 0 DESC, _time {order}, _side, _right {order}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _match
            FROM together)
        SELECT _row.*, {found} FROM matched WHERE _side = 2
        UNION ALL
        SELECT _row.*, {', '.join(f'null AS `{c}`' for c in (right_time, *carry))} FROM lefts
        WHERE _key IS NULL OR _time IS NULL"""
    return left.sparkSession.sql(query, left=left, right=right)
