"""A folder per micro-batch, so that a batch delivered twice is written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(df: DataFrame, batch_id: int, path: str, fmt: str = "parquet") -> None:
    """Overwrite the folder of this batch; a retry replaces its own earlier attempt."""
    df.write.mode("overwrite").format(fmt).save(batch_path(path, batch_id))


def read_batches(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """All batches with their ``batch_id``; the declared schema avoids reading footers twice."""
    declared = StructType([*schema.fields, StructField("batch_id", LongType(), True)])
    return spark.read.schema(declared).format(fmt).load(path)


def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the newest batch for every key: what an upsert would have left."""
    newest = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "batch_id")
