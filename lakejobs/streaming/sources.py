"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakejobs.session import is_file
from lakejobs.sources.topics import kafka_stream


def file_stream(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder, or one file, as a stream.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if is_file(spark, path):
        # The file source takes a plain path to be a folder, but a glob may name a file.
        parent, _, name = path.rpartition("/")
        path = f"{parent}/{{{name}}}"
    return reader.load(path)


# Row groups of the files a stream is made of: a reader splits a file only between them, so a
# micro-batch of one large file is read by many tasks and not one.
ROW_GROUP_BYTES = 1 << 20


def in_files(df: DataFrame, path: str, order: str, n: int) -> None:
    """Write ``df`` as ``n`` files (fewer for few values) by ranges of ``order``, which a file
    stream takes in that order.

    A stream takes the oldest file first, so their times are set a second apart.
    """
    df.repartitionByRange(n, order).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    first = min((f.getModificationTime() for f in found), default=0) - 1000 * len(found)
    for i, file in enumerate(sorted(found, key=lambda f: f.getPath().getName())):
        fs.setTimes(file.getPath(), first + 1000 * i, -1)


def stream_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """``kind`` is ``kafka`` (servers, topic, …) or a file format (path, schema, …)."""
    if kind == "kafka":
        return kafka_stream(spark, **options)
    return file_stream(spark, fmt=kind, **options)
