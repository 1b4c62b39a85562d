"""Topics, bounded or streaming (needs the spark-sql-kafka package on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORD = ("key", "value", "partition", "offset", "topic")


def topic_options(servers: str, topic: str, offsets: str, **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        **more,
    }


def as_text(records: DataFrame) -> DataFrame:
    """Key and value as strings; the other record fields, where there are any, unchanged."""
    casts = [f"CAST({c} AS STRING) AS {c}" for c in ("key", "value") if c in records.columns]
    rest = [c for c in records.columns if c not in ("key", "value")]
    return records.selectExpr(*casts, *rest)


def kafka_dump(spark: SparkSession, servers: str, topic: str, **more: str) -> DataFrame:
    """Everything in a topic now: key, value, partition, offset, topic."""
    options = topic_options(servers, topic, "earliest", endingOffsets="latest", **more)
    return as_text(spark.read.format("kafka").options(**options).load()).select(*RECORD)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **more: str) -> DataFrame:
    """New records of a topic. Offsets live in the query's checkpoint, not in the broker.

    ``maxOffsetsPerTrigger`` bounds a micro-batch; ``minPartitions`` splits large ones.
    """
    options = topic_options(servers, topic, "latest", **more)
    return as_text(spark.readStream.format("kafka").options(**options).load())
