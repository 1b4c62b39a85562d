"""Look back over a key's timeline when one key may hold a third of all rows.

``Window.partitionBy(key)`` sends every row of a key to one task. Here the timeline of
a hot key is cut into chunks by time, windows run per (key, chunk), and each chunk is
given copies of the ``k`` rows that precede it, so the result is the same as over the
whole key. A cold key is one chunk. A chunk that is still too full (a burst, or an odd
date that stretches the timeline) is cut once more between its own first and last time.

    cuts = find_cuts(rows, "card_id", "ts", "txn_id")
    chunked = assign_chunks(rows, "card_id", "ts", "txn_id", cuts=cuts)
    ready = with_preceding(chunked, "card_id", ("ts", "txn_id"), k=5, carry=("amount",))
    w = timeline("card_id", ("ts", "txn_id")).rowsBetween(-5, -1)
    out = drop_preceding(ready.withColumn("m", F.avg("amount").over(w)))

Rows of one key with the very same time are not parted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakejobs.operators import skew as skewed
from lakejobs.operators.skew import Skew

# Chunks are equally long in time, not equally full; cutting finer evens them out.
OVERSPLIT = 8
# Numbers kept free between two chunks for the parts of the first.
PARTS = 1 << 24

_CUT = ("_lo", "_width", "_chunks")


@dataclass(frozen=True)
class Cuts:
    """Where to cut: ``keys`` by time, and their too full chunks (``_coarse``) once more.

    Both have ``_lo`` (where the time starts), ``_width`` and ``_chunks``; ``chunks`` is
    None if no chunk is too full. Both are stored, with their numbers of rows.
    """

    keys: DataFrame
    n_keys: int
    chunks: DataFrame | None
    n_chunks: int


def _step(ts: str) -> Column:
    """Which of the ``_chunks`` a row is in. The bounds come from a sample: what lies
    outside them belongs to the chunks at the ends."""
    step = F.floor((skewed.micros(ts) - F.col("_lo")) / F.col("_width")).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(step, F.col("_chunks") - 1))


def _cut(found: DataFrame, by: Sequence[str], skew: Skew) -> DataFrame:
    """``found`` (keys with ``_n``, ``_lo``, ``_hi``) as equal steps of time."""
    chunks = skewed.pieces_of(skew) * OVERSPLIT
    width = F.ceil((F.col("_hi") - F.col("_lo") + 1) / chunks).cast("long")
    return found.select(*by, "_lo", width.alias("_width"), chunks.alias("_chunks"))


def find_cuts(
    rows: DataFrame,
    key: str,
    ts: str,
    tie: str,
    skew: Skew | None = skewed.DEFAULT,
    found: dict[str, skewed.Hot | None] | None = None,
) -> Cuts | None:
    """Hot keys of ``rows`` and how to cut them; None if there are none, or ``skew=None``.

    ``found`` may hold what ``skew.search`` has found already. Only if some key is hot are
    the rows of hot keys looked at once more, for chunks that stay too full.
    """
    if skew is None:
        return None
    if found is None or key not in found:
        found = skewed.search(rows, [key], (ts, tie), skew, ts)
    hot = found[key]
    if hot is None:
        return None
    keys = _cut(hot.frame, [key], skew)
    too_full = replace(skew, target_rows=2 * skew.target_rows)
    at = skewed.micros(ts)
    coarse = (
        rows.where(F.pmod(F.xxhash64(ts, tie), F.lit(skew.sample_every)) == 0)
        .where(F.col(ts).isNotNull())
        .select(key, ts)
        .join(skewed.hinted(keys, hot.n_keys), key)
        .select(key, _step(ts).alias("_coarse"), at.alias("_at"))
        .groupBy(key, "_coarse")
        .agg(
            (F.count(F.lit(1)) * skew.sample_every).alias("_n"),
            F.min("_at").alias("_lo"),
            F.max("_at").alias("_hi"),
        )
        .where(F.col("_n") > too_full.target_rows)
    )
    chunks, n_chunks = skewed.stored(_cut(coarse, [key, "_coarse"], too_full), "full-chunks")
    return Cuts(keys, hot.n_keys, chunks if n_chunks else None, n_chunks)


def assign_chunks(
    rows: DataFrame, key: str, ts: str, tie: str, prefix: str = "", cuts: Cuts | None = None
) -> DataFrame:
    """Add ``{prefix}_chunk`` (0 for a cold key) and ``{prefix}_hot``.

    Rows without a key or a time have no timeline; they are spread by ``tie`` so they
    cannot pile up in one task either.
    """
    no_timeline = F.col(key).isNull() | F.col(ts).isNull()
    apart = F.when(no_timeline, F.xxhash64(tie))
    if cuts is None:
        return rows.withColumns(
            {f"{prefix}_chunk": apart.otherwise(0).cast("long"), f"{prefix}_hot": F.lit(False)}
        )
    cut = F.col("_lo").isNotNull()
    coarse = (
        rows.join(skewed.hinted(cuts.keys, cuts.n_keys), key, "left")
        .withColumn(f"{prefix}_hot", cut & ~no_timeline)
        .withColumn("_coarse", F.when(cut, _step(ts)).otherwise(0))
        .drop(*_CUT)
    )
    chunk = f"{prefix}_chunk"
    if cuts.chunks is None:
        return coarse.withColumn(chunk, apart.otherwise(F.col("_coarse") * PARTS)).drop("_coarse")
    part = F.when(cut, _step(ts)).otherwise(0)
    return (
        coarse.join(skewed.hinted(cuts.chunks, cuts.n_chunks), [key, "_coarse"], "left")
        .withColumn(chunk, apart.otherwise(F.col("_coarse") * PARTS + part))
        .drop("_coarse", *_CUT)
    )


def chunk_ids(cuts: Cuts, key: str, chunk: str) -> DataFrame:
    """Every chunk a row of a hot key may be in: (key, ``chunk``)."""

    def numbers(first: int) -> Column:
        return F.explode(F.sequence(F.lit(first).cast("long"), F.col("_chunks") - 1))

    coarse = cuts.keys.select(key, numbers(0).alias("_i"))
    if cuts.chunks is None:
        return coarse.select(key, (F.col("_i") * PARTS).alias(chunk))
    parts = cuts.chunks.select(key, "_coarse", numbers(1).alias("_i"))
    return coarse.select(key, (F.col("_i") * PARTS).alias(chunk)).unionByName(
        parts.select(key, (F.col("_coarse") * PARTS + F.col("_i")).alias(chunk))
    )


def timeline(key: str, order: Sequence[str], prefix: str = "") -> WindowSpec:
    return Window.partitionBy(key, f"{prefix}_chunk").orderBy(*order)


def known(key: str, order: Sequence[str], value: Column) -> Column:
    """A window result, or NULL on rows that have no key or no time."""
    return F.when(F.col(key).isNotNull() & F.col(order[0]).isNotNull(), value)


def with_preceding(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    k: int,
    carry: Sequence[str],
    prefix: str = "",
    source: DataFrame | None = None,
    cut: bool = True,
) -> DataFrame:
    """Add to each chunk of a hot key copies of the ``k`` rows before it.

    Copies hold ``key``, ``order`` and ``carry`` (other columns NULL) and ``_copy`` true.
    ``source`` may name a cheaper frame than ``rows`` to take them from; ``cut=False``
    says that no key was cut.
    """
    own = rows.withColumn("_copy", F.lit(False))
    if not cut:
        return own
    chunk, hot = f"{prefix}_chunk", f"{prefix}_hot"
    named = list(dict.fromkeys([*order, *carry]))
    newest_first = Window.partitionBy(key, chunk).orderBy(*[F.col(c).desc() for c in order])
    # At most k rows per chunk are left: small even for a key with a third of all rows.
    tails = (
        (rows if source is None else source)
        .where(F.col(hot))
        .select(key, chunk, *named)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= k)
    )
    along_key = Window.partitionBy(key).orderBy(*order)
    before = F.collect_list(F.struct(*named)).over(along_key.rowsBetween(-k, -1))
    copies = (
        tails.withColumn("_before", before)
        .withColumn("_opens", F.lag(chunk).over(along_key) != F.col(chunk))
        .where("_opens")
        .select(key, chunk, F.explode("_before").alias("_row"))
        .select(key, chunk, *[F.col(f"_row.{c}").alias(c) for c in named])
        .withColumn("_copy", F.lit(True))
    )
    return own.unionByName(copies, allowMissingColumns=True)


def drop_preceding(rows: DataFrame, prefix: str = "") -> DataFrame:
    return rows.where(~F.col("_copy")).drop("_copy", f"{prefix}_chunk", f"{prefix}_hot")
