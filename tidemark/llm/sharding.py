"""Rendezvous hashing over weighted shards, and gapless slots. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Equal rows are numbered in runs of this length, so no task makes all copies of a hot row.
RUN = 4096


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) that the key's text and the shard decide: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", key, F.lit(str(shard))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def rendezvous_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: the highest ``weight / -ln(uniform(key, shard))`` wins.

    A shard takes a share of the keys in proportion to its weight. A key's score for a shard
    depends on that shard alone, so an added shard takes rows only into itself and a removed
    one gives away only its own. Ties, and a null key (taken as the empty text), are settled
    by the lowest shard number. Equal keys share a shard. Weights must be positive.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scored = [
        F.struct(
            (F.lit(float(w)) / -F.log(uniform(text, shard))).alias("score"),
            F.lit(-shard).alias("order"),
        )
        for shard, w in sorted(weights.items())
    ]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["order"]).cast("int")


def shard_rows(
    docs: DataFrame, weights: Mapping[int, float], key: str = "doc_id", column: str = "shard"
) -> DataFrame:
    """``docs`` with an int ``column``; a projection, nothing is shuffled or dropped."""
    return docs.withColumn(column, rendezvous_shard(F.col(key), weights))


def number_slots(
    rows: DataFrame, shard: str = "shard", order: Sequence[str] = ("doc_id",), slot: str = "slot"
) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, by the MD5 of ``order``, joined by colons.

    Rows are dealt into cells by the first two digits of that MD5, cells are numbered on their own
    and shifted by the sizes of the cells before: 256 sums a shard at most. Equal rows are
    counted before the shuffle and spread again in runs, so a row that makes up a third of the
    table never meets in one task. Every column of ``rows`` takes part in the order, so the
    numbers do not depend on how the rows are stored. An empty table stays empty.
    """
    names = rows.columns
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    digest = F.md5(F.concat_ws(":", *texts).cast("binary"))
    counted = cut(
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_digest", digest)
        .withColumn("_cell", F.conv(F.substring("_digest", 1, 2), 16, 10).cast("int"))
    )
    sizes = counted.groupBy(shard, "_cell").agg(F.sum("_copies").alias("_size"))
    # One row per shard and cell: bounded by the number of shards, not by the rows.
    before = sizes.selectExpr(
        f"`{shard}`",
        "_cell",
        f"sum(_size) over (partition by `{shard}` order by _cell rows unbounded preceding) - _size as _before",
    )
    window = f"partition by `{shard}`, _cell order by _digest, {', '.join(f'`{n}`' for n in names)} rows unbounded preceding"
    placed = (
        counted.selectExpr("*", f"sum(_copies) over ({window}) - _copies as _within")
        .join(F.broadcast(before), [shard, "_cell"])
        .withColumn("_start", F.col("_before") + F.col("_within"))
    )
    single = placed.filter(F.col("_copies") == 1).select(*names, F.col("_start").alias(slot))
    runs = (
        placed.filter(F.col("_copies") > 1)
        .withColumn("_run", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {RUN})")))
        .select(
            *names,
            (F.col("_start") + F.col("_run") * RUN).alias("_from"),
            F.least(F.lit(RUN), F.col("_copies") - F.col("_run") * RUN).alias("_length"),
        )
    )
    spread = runs.repartition(F.col("_from")).select(
        *names, F.explode(F.expr("sequence(_from, _from + _length - 1)")).alias(slot)
    )
    return single.unionByName(spread)
