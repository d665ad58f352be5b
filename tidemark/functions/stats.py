"""Aggregates for the analysis datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column, places: int = 6) -> Column:
    """Pearson correlation over the rows where both values are present.

    ``corr`` raises on a constant column in ANSI mode. Constancy is tested by
    ``min < max``, which is exact, and not by a deviation that may be off zero by an ulp.
    """
    xs = F.when(y.isNotNull(), x).cast("double")
    ys = F.when(x.isNotNull(), y).cast("double")
    varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.when(varies, F.round(F.covar_pop(xs, ys) / F.nullif(spread, F.lit(0.0)), places))
