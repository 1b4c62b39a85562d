"""Whole-row set operations."""

from pyspark.sql import DataFrame


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The different rows of ``left`` that are not in ``right``.

    Spark removes repeats only after the anti-join; doing it on both sides before keeps
    many copies of one row out of the join's shuffle.
    """
    return left.distinct().subtract(right.distinct())


def union_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, matched by column name; repeats are kept."""
    return left.unionByName(right)
