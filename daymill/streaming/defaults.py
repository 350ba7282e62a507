"""Recovery defaults of every stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

CHECKPOINT_INTERVAL = "30 seconds"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RESTARTS = 3


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep stream state in RocksDB with change logs instead of executor heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stream_defaults(writer: DataStreamWriter, checkpoint: str, drain: bool = False) -> DataStreamWriter:
    """Checkpoint location and a 30 s trigger; ``drain`` reads what is there and stops.

    Spark keeps the checkpoint when a query stops, so the next start goes on
    where the last one ended.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=CHECKPOINT_INTERVAL)


def run_with_restarts(start, restarts: int = RESTARTS, wait: float = 10.0, sleep=None) -> StreamingQuery:
    """Start a query and await it; start again from its checkpoint after a failure."""
    import time

    pause = sleep or time.sleep
    for attempt in range(restarts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            if attempt == restarts:
                raise
            pause(wait)
    raise AssertionError("unreachable")
