"""Several outputs of a micro-batch that appear together or not at all.

    {path}/batches/batch_id=7/kind=decided/…    the rows of a micro-batch, by kind
    {path}/_commits/7                           written last: micro-batch 7 is there
    {path}/merged/{name}/kind=decided/…         rows of many micro-batches in sized files
    {path}/_merged/5                            written last: holds the name, up to 5

A reader takes the newest mark of either kind: the merged rows up to one and the folders
after it up to the other. A folder without a mark is never read, and a committed
micro-batch that is delivered again is left alone. One stream writes a path, and one job
merges it; marks are single files that are renamed into place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakejobs.session import delete, file_system, input_bytes
from lakejobs.sinks.batches import batch_path

KIND, BATCH = "kind", "batch_id"
FILE_BYTES = 512 * 1024 * 1024


def marks(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the files in ``folder`` that are named by one."""
    fs, hpath = file_system(spark, folder)
    if not fs.exists(hpath):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hpath)]
    return sorted(int(n) for n in names if n.isdigit())


def put_mark(spark: SparkSession, folder: str, number: int, text: str = "") -> None:
    """Create the file ``number`` with ``text``, complete from the moment it can be seen."""
    fs, target = file_system(spark, f"{folder}/{number}")
    _, aside = file_system(spark, f"{folder}/_{number}-{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(aside, target):
        raise RuntimeError(f"could not write {folder}/{number}")


def read_mark(spark: SparkSession, folder: str, number: int) -> str:
    fs, hpath = file_system(spark, f"{folder}/{number}")
    size = fs.getFileStatus(hpath).getLen()
    stream = fs.open(hpath)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def last_commit(spark: SparkSession, path: str) -> int | None:
    """The newest committed micro-batch."""
    found = marks(spark, f"{path}/_commits")
    return found[-1] if found else None


def commit_batch(outputs: Mapping[str, DataFrame], batch_id: int, path: str) -> bool:
    """Write all ``outputs`` (kind to rows) of a micro-batch in one job, then its mark.

    False if it was committed before. Columns of one name must be of one type in all kinds;
    those that a kind does not have are NULL there.
    """
    rows: DataFrame | None = None
    for kind, df in outputs.items():
        own = df.withColumn(KIND, F.lit(kind))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    if rows is None:
        raise ValueError("no outputs")
    spark = rows.sparkSession
    last = last_commit(spark, path)
    if last is not None and batch_id <= last:
        return False
    rows.write.mode("overwrite").partitionBy(KIND).parquet(batch_path(f"{path}/batches", batch_id))
    put_mark(spark, f"{path}/_commits", batch_id)
    return True


def read_committed(
    spark: SparkSession, path: str, kind: str, schema: StructType, as_of: int | None = None
) -> DataFrame:
    """Rows of a kind in all committed micro-batches, up to ``as_of``.

    Folders are pruned by name, so neither other kinds nor other micro-batches are opened.
    Merged rows no longer tell their micro-batch, so ``as_of`` before the last merge is an
    error.
    """
    last = last_commit(spark, path)
    merged = marks(spark, f"{path}/_merged")
    if as_of is not None and last is not None:
        last = min(last, as_of)
    if last is None or last < 0:
        return spark.createDataFrame([], schema)
    declared = StructType([*schema.fields, StructField(KIND, StringType())])
    first = -1
    parts = []
    if merged:
        first = merged[-1]
        if first > last:
            raise ValueError(f"micro-batches up to {first} are merged, {last} cannot be told apart")
        name = read_mark(spark, f"{path}/_merged", first)
        parts.append(spark.read.schema(declared).parquet(f"{path}/merged/{name}"))
    if last > first:
        by_batch = StructType([*declared.fields, StructField(BATCH, LongType())])
        parts.append(
            spark.read.schema(by_batch)
            .parquet(f"{path}/batches")
            .where((F.col(BATCH) > first) & (F.col(BATCH) <= last))
            .drop(BATCH)
        )
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.where(F.col(KIND) == kind).drop(KIND)


def merge_batches(
    spark: SparkSession, path: str, schema: StructType, keep: int = 1, file_bytes: int = FILE_BYTES
) -> int | None:
    """Merge the committed micro-batches into files of about ``file_bytes``; the newest merged.

    ``schema`` has the columns of all kinds. The last ``keep`` micro-batches stay apart, so
    that readers can go back that far. A reader that began before goes on with the folders
    it has listed: they are deleted by the next merge, not by this one.
    """
    last = last_commit(spark, path)
    merged = marks(spark, f"{path}/_merged")
    before = merged[-1] if merged else -1
    if last is None or last - keep <= before:
        return None
    upto = last - keep
    by_batch = StructType([*schema.fields, StructField(KIND, StringType()), StructField(BATCH, LongType())])
    rows = spark.read.schema(by_batch).parquet(f"{path}/batches")
    rows = rows.where((F.col(BATCH) > before) & (F.col(BATCH) <= upto)).drop(BATCH)
    size = input_bytes(spark, *[batch_path(f"{path}/batches", i) for i in range(before + 1, upto + 1)])
    if before >= 0:
        name = read_mark(spark, f"{path}/_merged", before)
        old = f"{path}/merged/{name}"
        declared = StructType([*schema.fields, StructField(KIND, StringType())])
        rows = rows.unionByName(spark.read.schema(declared).parquet(old))
        size += input_bytes(spark, old)
    name = f"{upto}-{uuid.uuid4().hex[:8]}"
    n_files = max(1, -(-size // file_bytes))
    rows.repartition(n_files).write.partitionBy(KIND).parquet(f"{path}/merged/{name}")
    put_mark(spark, f"{path}/_merged", upto, name)
    _forget(spark, path, merged)
    return upto


def _forget(spark: SparkSession, path: str, merged: list[int]) -> None:
    """Delete what the merge before the last one had replaced already."""
    if not merged:
        return
    done = merged[-1]
    for i in [i for i in marks(spark, f"{path}/_commits") if i <= done]:
        delete(spark, batch_path(f"{path}/batches", i))
        delete(spark, f"{path}/_commits/{i}")
    for mark in merged[:-1]:
        delete(spark, f"{path}/merged/{read_mark(spark, f'{path}/_merged', mark)}")
        delete(spark, f"{path}/_merged/{mark}")
