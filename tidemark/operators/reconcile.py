"""Comparison of two builds of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE, COPIES = "only_in", "copies"


def differences(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """The rows that one side has more often than the other: its columns, ``only_in`` and ``copies``, by how many.

    A bag difference both ways in one pass: each row counts for its side, equal rows add up in every
    map task, and what cancels out is gone. NULLs equal each other. Columns are matched by name and must
    be the same on both sides.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("both sides need the same columns")
    both = left.withColumn(COPIES, F.lit(1)).unionByName(right.withColumn(COPIES, F.lit(-1)))
    counted = both.groupBy(*[f"`{c}`" for c in left.columns]).agg(F.sum(COPIES).alias(COPIES)).filter(F.col(COPIES) != 0)
    side = F.when(F.col(COPIES) > 0, names[0]).otherwise(names[1])
    return counted.withColumn(SIDE, side).withColumn(COPIES, F.abs(COPIES))
