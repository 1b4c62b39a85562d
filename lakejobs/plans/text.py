"""Word counts and grouped maxima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.functions import tokens


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of every word. Counts are combined in each task before the shuffle."""
    return (
        lines.select(F.explode(tokens.pieces(F.col(column))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rare_words(lines: DataFrame, below: int = 100, column: str = "value") -> DataFrame:
    return word_count(lines, column).where(F.col("n") < below)


def max_with_carry(df: DataFrame, key: str, value: str, carry: str) -> DataFrame:
    """Largest ``value`` per ``key`` and the ``carry`` of that row (the larger on a tie)."""
    best = F.max(F.struct(value, carry)).alias("_best")
    return (
        df.groupBy(key)
        .agg(best)
        .select(key, F.col(f"_best.{value}").alias(f"max_{value}"), F.col(f"_best.{carry}").alias(carry))
    )
