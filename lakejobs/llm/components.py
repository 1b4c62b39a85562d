"""Connected components of a graph held in Spark, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import forget, kept


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``id`` and ``component``, its smallest reachable id, of every node in ``edges``.

    In a large star all larger neighbours of a node are hung on its smallest one, in a
    small star all smaller ones; both shrink the graph to stars in a logarithmic number of
    rounds. Stars' minima are kept, so that the joins with them start from plain shuffles
    and a centre with very many neighbours is split. NULL ends and loops are left out.
    Raises if ``most_rounds`` do not suffice.
    """
    pairs = kept(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "graph",
    )
    before = None
    for _ in range(most_rounds):
        now = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before or not now[0]:
            break
        before = now
        large, above = _large_star(pairs)
        small, below = _small_star(large)
        forget(pairs, large, above, below)
        pairs = small
    else:
        raise RuntimeError(f"components have not converged after {most_rounds} rounds")
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        pairs.select("v", "v").distinct()
    )


def _large_star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new graph, and the minima it was made with."""
    both = pairs.union(pairs.select("v", "u"))
    low = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "graph-minima")
    hung = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept(hung.distinct(), "graph"), low


def _small_star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``_large_star``."""
    low = kept(pairs.groupBy("u").agg(F.min("v").alias("m")), "graph-minima")
    hung = pairs.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept(hung.union(low).distinct(), "graph"), low
