"""JDBC tables. Connection settings are always arguments; none are stored here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partition:
    """How to read a table in parallel ranges of one numeric or date column."""

    column: str
    lower: object
    upper: object
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition: Partition | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan a table (or a parenthesised query with an alias).

    Without ``partition`` the whole scan is one task: only for small lookup tables.
    Filters and column selection are pushed to the database by Spark.
    """
    reader = spark.read.format("jdbc").option("fetchsize", str(fetch_size))
    reader = reader.options(**dict(options)).option("dbtable", table)
    if partition:
        reader = reader.options(**partition.options())
    return reader.load()
