"""Each ingestion run takes only the files that landed since the last one.

A run is a streaming query that stops when it has caught up. Its checkpoint remembers the
files taken. A batch that is replayed after a failure adds nothing twice, because the append
ignores keys that are already stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.layers import BronzeTable, Layers


def ingest_new_files(
    layers: Layers,
    table: BronzeTable,
    landing: str,
    schema: T.StructType,
    to_bronze: Callable[[DataFrame], DataFrame],
    arrival: Sequence[str | Column],
    *,
    fmt: str = "json",
    strict: bool = True,
    label: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append the new files of ``landing`` to a bronze table and stop."""
    landed = layers.spark.readStream.schema(schema).format(fmt).load(landing)

    def store(batch: DataFrame, _batch_id: int) -> None:
        layers.append_new(table, to_bronze(batch), arrival, strict=strict, label=label)

    return (
        landed.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{layers.root}/_progress/{table.name}")
        .trigger(availableNow=True)
        .start()
    )
