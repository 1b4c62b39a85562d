"""Session settings, shuffle sizing and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

# Result-neutral settings the jobs rely on. The skew-join rule is forced because
# several joins feed an aggregate that would otherwise keep the join's partitioning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A micro-batch saves what it changed, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MB = 1024 * 1024
PARTITION_BYTES = 128 * MB
# Map tasks times shuffle partitions is the number of blocks a shuffle keeps track of, so
# partitions are not made without end; a session may set another bound by this setting.
MAX_PARTITIONS = 100_000
MAX_PARTITIONS_SETTING = "spark.lakejobs.maxPartitions"
MAX_SCAN_TASKS = 200_000
MAX_SCAN_BYTES = 512 * MB


def build_session(app: str = "lakejobs", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def input_bytes(spark: SparkSession, *paths: str | Sequence[str]) -> int:
    """Bytes under ``paths`` (files, folders, globs, or lists of them), asked of the file
    system; no data is read."""
    total = 0
    for path in paths:
        if not isinstance(path, str):
            total += input_bytes(spark, *path)
            continue
        fs, hpath = file_system(spark, path)
        for found in fs.globStatus(hpath) or []:
            total += fs.getContentSummary(found.getPath()).getLength()
    return total


def is_file(spark: SparkSession, path: str) -> bool:
    fs, hpath = file_system(spark, path)
    return fs.exists(hpath) and fs.getFileStatus(hpath).isFile()


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def tune(spark: SparkSession, *paths: str | Sequence[str]) -> SparkSession:
    """Apply SETTINGS to a running session and size scans and shuffles for ``paths``.

    Shuffles only start from the larger number; AQE merges small partitions again.
    """
    settings = dict(SETTINGS)
    if paths:
        n_bytes = input_bytes(spark, *paths)
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        most = int(spark.conf.get(MAX_PARTITIONS_SETTING, str(MAX_PARTITIONS)))
        initial = min(max(base, n_bytes // PARTITION_BYTES), most)
        scan = min(max(PARTITION_BYTES, n_bytes // MAX_SCAN_TASKS), MAX_SCAN_BYTES)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial)
        settings["spark.sql.files.maxPartitionBytes"] = str(scan)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started.

    On a cluster the package is installed on every machine or sent with ``--py-files``.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without one gets a fresh temporary folder. On a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="lakejobs-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared root, unique to this call."""
    return f"{work_root(spark)}/lakejobs/{name}-{uuid.uuid4().hex[:12]}"
