"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Replace (or append to) a folder. One file per task: nothing is coalesced."""
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_key_value(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Text lines of tab-separated columns, replacing what was there."""
    df.write.mode("overwrite").csv(path, sep=sep, header=False)
