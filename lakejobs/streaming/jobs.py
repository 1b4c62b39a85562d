"""Running streams: one checkpoint per query, one folder per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lakejobs.sinks.batches import write_batch

# How often each kind of stream runs when it runs for good.
LANDING_INTERVAL = "10 seconds"
TRANSACTIONS_INTERVAL = "1 second"
RATE_INTERVAL = "1 second"
STATUS_INTERVAL = "300 seconds"

BatchWriter = Callable[[DataFrame, int], None]


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """A stateful query keeps the shuffle partitions it first starts with for good.

    By default one per core, and on a cluster no fewer than the session has.
    """
    name = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(name), spark.sparkContext.defaultParallelism
    if not spark.sparkContext.master.startswith("local"):
        cores = max(cores, int(before))
    spark.conf.set(name, str(n or cores))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start ``df`` into ``write``: every ``interval``, or what there is now and stop."""
    writer: DataStreamWriter = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if interval:
        writer = writer.trigger(processingTime=interval)
    else:
        writer = writer.trigger(availableNow=True)
    with _state_partitions(df.sparkSession, state_partitions):
        return writer.start()


def into_batches(path: str, fmt: str = "parquet") -> BatchWriter:
    return lambda df, batch_id: write_batch(df, batch_id, path, fmt)


@contextmanager
def kept(batch: DataFrame):
    """Keep a micro-batch that is read more than once, so as to fetch it once.

    It is bounded by the source's per-trigger options, and read again from the source
    where an executor holding a part of it is lost.
    """
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def land_raw(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    fmt: str = "text",
) -> StreamingQuery:
    """Land raw records as they come, a folder per micro-batch, none for an empty one."""

    def land(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            write_batch(df, batch_id, path, fmt)

    return start(lines, land, checkpoint, interval)
