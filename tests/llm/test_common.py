"""Intermediate tables."""

import time

from pyspark.sql import functions as F

from lakejobs.llm.common import kept


def test_shuffles_of_kept_tables_are_deleted(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = lambda: env.blockManager().diskBlockManager().getAllFiles().mkString(" ")
    shuffled = lambda: files().count("/shuffle_")
    before = shuffled()
    table = kept(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and table.count() == 7
