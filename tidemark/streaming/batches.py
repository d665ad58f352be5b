"""What the streams share: sessions of their own, and a sink that a repeated batch overwrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Partitions of a stream's state. They are fixed when a stream starts for the first time.
STATE_PARTITIONS = 8


def stream_session(spark: SparkSession, partitions: int = STATE_PARTITIONS) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB, which holds on
    disk what exceeds memory and saves only changes."""
    session = spark.newSession()
    for name, value in (
        ("spark.sql.shuffle.partitions", str(partitions)),
        ("spark.sql.streaming.stateStore.providerClass", ROCKSDB),
        ("spark.sql.session.timeZone", "UTC"),
    ):
        session.conf.set(name, value)
    return session


def store_batches(rows: DataFrame, out: str, progress: str, mode: str = "append") -> StreamingQuery:
    """Run a stream until it has caught up, each micro-batch to its own folder ``batch=<number>``."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        rows.writeStream.foreachBatch(store)
        .outputMode(mode)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
