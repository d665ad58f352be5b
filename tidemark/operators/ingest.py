"""Bronze ingestion: appended frames, first write wins, constraints, idempotent append."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def append_frames(frames: Sequence[DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """Bag union by name; a column that a frame lacks is NULL; no frames give an empty frame."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_write_wins(
    df: DataFrame, arrival: Sequence[str | Column], key: str | Sequence[str] = "hash"
) -> DataFrame:
    """One row per key: the earliest by ``arrival``.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before the shuffle,
    so a key that holds a third of the batch sends one row per task, not all its copies.
    """
    order = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*arrival)
    return (
        df.withColumn("_arrival", F.row_number().over(order))
        .filter(F.col("_arrival") == 1)
        .drop("_arrival")
    )


def not_yet_stored(batch: DataFrame, stored: DataFrame, key: str = "hash") -> DataFrame:
    """Rows of an already de-duplicated batch whose key is not in the table."""
    return batch.join(stored.select(key), key, "left_anti")


def upsert(
    stored: DataFrame, batch: DataFrame, arrival: Sequence[str | Column], key: str = "hash"
) -> DataFrame:
    """The table after the batch: stored rows stay, new keys are added once."""
    fresh = not_yet_stored(first_write_wins(batch, arrival, key), stored, key)
    return stored.unionByName(fresh.select(stored.columns))


@dataclass(frozen=True)
class Constraints:
    """Column rules of a bronze table. ``decimals`` maps a column to (precision, scale)."""

    not_null: Iterable[str] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)

    def broken_rules(self) -> Column:
        """The names of the rules a row breaks, as an array; empty for a good row."""
        rules = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in self.not_null]
        rules += [
            F.when(F.length(c) > n, F.lit(f"{c} longer than {n}"))
            for c, n in self.max_length.items()
        ]
        rules += [
            F.when(F.col(c).isNotNull() & self._stored(c).isNull(), F.lit(f"{c} out of range"))
            for c in self.decimals
        ]
        return F.array_compact(F.array(*rules))

    def _stored(self, column: str) -> Column:
        """The value as the table holds it, rounded once; NULL if it is out of range."""
        return F.col(column).try_cast(T.DecimalType(*self.decimals[column]))

    def store_types(self, df: DataFrame) -> DataFrame:
        """Round the numeric columns to their stored scale."""
        casts = {c: self._stored(c) for c in self.decimals}
        return df.withColumns(casts) if casts else df


# Limits and types of the bronze tables.
NEWS_CONSTRAINTS = Constraints(
    not_null=("hash", "company", "title"),
    max_length={"hash": 32, "company": 100, "sentiment": 10},
)
INSIDER_CONSTRAINTS = Constraints(
    not_null=("hash", "symbol"),
    max_length={"hash": 32, "symbol": 10, "transaction_code": 10},
    decimals={"transaction_price": (10, 2)},
)
STOCK_CONSTRAINTS = Constraints(not_null=("hash",))


def violations(df: DataFrame, constraints: Constraints) -> DataFrame:
    """One row per broken rule, beside the whole input row."""
    return df.withColumn("broken_rule", F.explode(constraints.broken_rules()))


BROKEN = "broken_rules"


def judged(df: DataFrame, constraints: Constraints) -> DataFrame:
    """The rows with the list of rules they break."""
    return df.withColumn(BROKEN, constraints.broken_rules())


def split_judged(df: DataFrame, constraints: Constraints) -> tuple[DataFrame, DataFrame]:
    """(rows to store, rejected rows with their broken rules)."""
    good = df.filter(F.size(BROKEN) == 0).drop(BROKEN)
    return constraints.store_types(good), df.filter(F.size(BROKEN) > 0)


class RejectedBatch(ValueError):
    """A strict batch held a row that the table does not accept; nothing was stored."""


def refuse_broken(df: DataFrame) -> None:
    """Refuse a judged batch as a whole when any row breaks a rule."""
    bad = df.filter(F.size(BROKEN) > 0).select(BROKEN).head(1)
    if bad:
        raise RejectedBatch(f"batch rejected: {', '.join(bad[0][BROKEN])}")


def strict_batches(df: DataFrame, batch: str, constraints: Constraints) -> DataFrame:
    """The rows that strict runs store when each value of ``batch`` is a run of its own: those of
    batches without a broken row. What is shuffled of the judgement is one row per bad batch
    and task."""
    bad = df.filter(F.size(constraints.broken_rules()) > 0).select(batch).distinct()
    return constraints.store_types(df.join(bad, batch, "left_anti"))


def observed(metrics: Observation, nothing: dict) -> dict:
    """What a finished write observed. Where nothing was left to write, Spark replaces the plan by an
    empty one, which observes nothing: then it is ``nothing``."""
    try:
        return metrics.get
    except Py4JJavaError:
        return nothing


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Run summary: rows per value, most frequent first; NULL is not counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), F.col(column))
    )
