"""Hot keys: find them in one pass, and join without sending one key to one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakejobs.session import work_dir


@dataclass(frozen=True)
class Skew:
    """When a key counts as hot.

    ``target_rows``: rows one task may hold of a key; a key with more is cut.
    ``sample_every``: keys are counted on one row in this many. The sample only decides
    where to cut, never which rows take part, so a miscount costs time and not rows.
    """

    target_rows: int = 1_000_000
    sample_every: int = 64


DEFAULT = Skew()

# A table of hot keys with more rows than this carries no broadcast hint.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Hot:
    """Hot keys, stored: ``frame`` has the key, ``_n`` (its estimated rows), ``_lo`` and ``_hi``."""

    frame: DataFrame
    n_keys: int

    def hinted(self, *columns: str | Column) -> DataFrame:
        return hinted(self.frame.select(*columns), self.n_keys)


def hinted(table: DataFrame, n_rows: int) -> DataFrame:
    """``table`` with a broadcast hint if it is known to be small."""
    return F.broadcast(table) if n_rows <= BROADCAST_ROWS else table


def stored(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A small table written to the shared work folder and read back, with its row count,
    which the writing job counts itself."""
    path = work_dir(df.sparkSession, name)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), written.get["n"]


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def search(
    rows: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    skew: Skew = DEFAULT,
    ts: str | None = None,
) -> dict[str, Hot | None]:
    """The hot keys of several columns, found in one pass over ``rows``; None where none is.

    ``spread`` names columns that differ between the rows of a key. The sample is taken
    by their hash, so it is the same one in every retry. With ``ts``, rows without a time
    do not count, and ``_lo`` and ``_hi`` are a key's first and last microsecond. The result
    is stored: what uses it later does not look at ``rows`` again.
    """
    sample = rows.where(F.pmod(F.xxhash64(*spread), F.lit(skew.sample_every)) == 0)
    if ts is not None:
        sample = sample.where(F.col(ts).isNotNull())
    at = micros(ts) if ts is not None else F.lit(0).cast("long")
    pairs = [F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys]
    found = (
        sample.select(F.explode(F.array(*pairs)).alias("_p"), at.alias("_at"))
        .select("_p.k", "_p.v", "_at")
        .where("v is not null")
        .groupBy("k", "v")
        .agg(
            (F.count(F.lit(1)) * skew.sample_every).alias("_n"),
            F.min("_at").alias("_lo"),
            F.max("_at").alias("_hi"),
        )
        .where(F.col("_n") > skew.target_rows)
    )
    table, total = stored(found, "hot-keys")
    counts = {r["k"]: r["count"] for r in table.groupBy("k").count().collect()} if total else {}
    kinds = dict(rows.select(*keys).dtypes)

    def of(key: str) -> Hot | None:
        if not counts.get(key):
            return None
        own = table.where(F.col("k") == key)
        return Hot(own.select(F.col("v").cast(kinds[key]).alias(key), "_n", "_lo", "_hi"), counts[key])

    return {key: of(key) for key in keys}


def pieces_of(skew: Skew) -> Column:
    """Into how many pieces a hot key is cut."""
    return F.ceil(F.col("_n") / skew.target_rows).cast("long")


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: Sequence[str],
    skew: Skew | None = DEFAULT,
    source: DataFrame | None = None,
    found: dict[str, Hot | None] | None = None,
) -> DataFrame:
    """Left join with a lookup of one row per key, of any size.

    Rows of a hot key are dealt over its pieces and its lookup row is repeated once per
    piece. (AQE's own skew join does not act here: it needs a shuffle directly under
    both sides, and a lookup that was reduced by key has an aggregate there.)
    ``source`` may name a cheaper frame with the same rows to count the keys of, ``found``
    what ``search`` has found already; with ``skew=None`` no key is cut.
    """
    if skew is None:
        return rows.join(lookup, key, "left")
    if found is None or key not in found:
        found = search(rows if source is None else source, [key], spread, skew)
    hot_keys = found[key]
    if hot_keys is None:
        return rows.join(lookup, key, "left")
    hot = hot_keys.hinted(key, pieces_of(skew).alias("_pieces"))
    pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
    # Rows without a key match nothing; a piece of their own keeps them apart.
    piece = F.when(F.col(key).isNull(), F.xxhash64(*spread)).otherwise(
        F.pmod(F.xxhash64(*spread), pieces)
    )
    dealt = rows.join(hot, key, "left").withColumn("_piece", piece).drop("_pieces")
    repeated = (
        lookup.join(hot, key, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
        .drop("_pieces")
    )
    return dealt.join(repeated, [key, "_piece"], "left").drop("_piece")
