"""JDBC sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.sources.jdbc import Partition, read_table


def append_table(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 10_000) -> None:
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**dict(options))
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .save()
    )


def unwritten(df: DataFrame, written: DataFrame, keys: Sequence[str], batch_id: int) -> DataFrame:
    """Rows of batch ``batch_id`` whose keys are not yet in the target."""
    done = written.where(F.col("batch_id") == batch_id).select(*keys)
    return df.withColumn("batch_id", F.lit(batch_id).cast("long")).join(done, list(keys), "left_anti")


def append_once(
    df: DataFrame,
    batch_id: int,
    options: Mapping[str, str],
    table: str,
    keys: Sequence[str],
    partition: Partition | None = None,
) -> None:
    """For ``foreachBatch``: append a micro-batch, also when it is delivered again.

    The target has a ``batch_id`` column. A repeated batch adds only the rows a failed
    attempt left out. The ``batch_id`` filter is pushed to the database; ``partition``
    reads its answer in parallel.
    """
    written = read_table(df.sparkSession, options, table, partition)
    append_table(unwritten(df, written, keys, batch_id), options, table)
