"""Tables, kept intermediate results and text batches shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.session import delete, work_dir


ROOT = str(Path(__file__).resolve().parents[2])


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started.

    On a cluster the package is installed on every machine or sent with ``--py-files``.
    """
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files go with the job that made them, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned_up(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    What is read more than once is computed once, its lineage ends at files that outlive
    executors, and joins on it start from a plain shuffle, which adaptive execution can
    split when a key is hot. Its shuffle files are deleted once it is written.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    with _cleaned_up(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.kept_in = path
    return back


def forget(*tables: DataFrame | None) -> None:
    """Delete what ``kept`` wrote, once nothing reads it any more."""
    for df in tables:
        if df is not None:
            delete(df.sparkSession, df.kept_in)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def map_texts(
    df: DataFrame, columns: list[str], text: str, schema: str, fn: Callable[[list], dict]
) -> DataFrame:
    """``columns`` of ``df`` and, beside them, the columns ``fn`` makes from a batch of texts.

    Runs in Arrow batches; ``schema`` describes the columns ``fn`` returns as lists or
    arrays. NULL texts reach ``fn`` as None.
    """
    share_package(df.sparkSession)
    own = df.select(*[F.col(c) for c in columns], F.col(text).alias("__text"))
    base = df.select(*columns)
    full = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch.column(batch.num_columns - 1).to_pylist())
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *made])

    return own.mapInArrow(run, full)


def sampled(df: DataFrame, key: str, rate: float) -> DataFrame:
    """Rows whose hashed ``key`` falls under ``rate``: the same rows on every run."""
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)) < int(rate * 1_000_003) + 1)
