"""Topic sinks (need the spark-sql-kafka package on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def as_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """One string ``value`` per row: the value column itself, or the row as JSON."""
    names = [c for c in df.columns if c != key]
    value = F.col(names[0]) if len(names) == 1 else F.to_json(F.struct(*names))
    columns = [value.cast("string").alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    (
        as_records(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_stream_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None
) -> StreamingQuery:
    return (
        as_records(df, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
