"""Transit-stop demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_stops(stops: DataFrame, max_miles: float = 3, n: int | None = 20) -> DataFrame:
    """The most searched stops nearer than ``max_miles``; all of them with ``n=None``."""
    counted = (
        stops.where(F.col("MilesAway") < max_miles)
        .groupBy("StopID", "StopName")
        .agg(F.count("StopID").alias("count_stop_id"))
        .orderBy(F.col("count_stop_id").desc(), "StopID", "StopName")
    )
    return counted if n is None else counted.limit(n)


def max_boardings(stops: DataFrame, top: DataFrame) -> DataFrame:
    """Largest number of boardings on any search for each of the ``top`` stops.

    Boardings are reduced per stop before the join, so the join moves one row per stop
    whatever the size of ``top`` and however often one stop was searched.
    """
    per_stop = stops.groupBy("StopID").agg(F.max("NumberOfBoardings").alias("_most"))
    return (
        per_stop.join(top.select("StopID", "StopName"), "StopID")
        .groupBy("StopName")
        .agg(F.max("_most").alias("max_boardings"))
    )
