"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson number of times whose mean is its group's target
repetition rate. The number comes from inverting the distribution at a uniform hash of
seed and document, so it is the same on every run and retry. The copies are then dealt
and ordered by a hash, which is a global shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GROUPS, MAX_RATE = 10_000, 1_000.0


@dataclass(frozen=True)
class Mixture:
    """``weights``: target share per value of the group column.

    ``rest``: share of all other values and of NULL together. Weights need not sum to
    one; groups without rows drop out and the others share theirs. ``total``: rows to
    expect of the mixture (default: as many as there are). ``seed`` picks the sample.
    """

    weights: Mapping[str, float] = field(default_factory=dict)
    rest: float = 0.0
    total: int | None = None
    seed: str = "mix"


def thresholds(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ...: at a uniform u the count is how many are at most u."""
    if not 0 <= rate <= MAX_RATE:
        raise ValueError(f"a repetition rate must be between 0 and {MAX_RATE:g}, not {rate:g}")
    out, total = [], 0.0
    for k in range(int(rate + 12 * math.sqrt(rate)) + 25):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate else float(k == 0)
        out.append(total)
    return out


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from a hash of ``seed`` and ``parts``; NULL parts count as '-'."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, mixture: Mixture, group_col: str) -> dict[int, float]:
    """Repetition rate by the number of the group: its place in ``weights``, then the rest."""
    if len(mixture.weights) > MAX_GROUPS:
        raise ValueError(f"at most {MAX_GROUPS} groups can have a weight")
    counts = {
        r[0]: r[1]
        for r in docs.groupBy(group_number(mixture, group_col).alias("g")).count().collect()
    }
    shares = dict(enumerate([*mixture.weights.values(), mixture.rest]))
    if min(shares.values()) < 0:
        raise ValueError("weights must not be negative")
    present = {g: shares[g] for g in counts}
    total = sum(present.values())
    rows = mixture.total if mixture.total is not None else sum(counts.values())
    return {g: rows * w / total / counts[g] if total else 0.0 for g, w in present.items()}


def group_number(mixture: Mixture, group_col: str) -> Column:
    names = list(mixture.weights)
    if not names:
        return F.lit(0)
    place = F.array_position(F.array(*map(F.lit, names)), F.col(group_col).cast("string"))
    return F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(len(names)).cast("int")


def mix(
    docs: DataFrame,
    mixture: Mixture,
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs`` per copy, then ``copy`` (from 0) and ``shuffle_key``.

    Rows come in the order of ``shuffle_key`` within each part of the result, and the key
    says nothing of source or content, so that every part is a random sample of the whole.
    Rows with equal id are repeated equally often. NULL ids and texts take part like any
    value; an empty table gives an empty mixture. Columns of ``docs`` named copy or
    shuffle_key are replaced.
    """
    rate = rates(docs, mixture, group_col)
    tables = F.lit(None).cast("array<double>")
    for g, r in rate.items():
        cuts = F.array(*map(F.lit, thresholds(r)))
        tables = F.when(group_number(mixture, group_col) == g, cuts).otherwise(tables)
    u = uniform(mixture.seed, F.col(id_col))
    copies = F.coalesce(F.size(F.filter(tables, lambda c: c <= u)), F.lit(0))
    out = docs.drop("copy", "shuffle_key").withColumn("__n", copies).where("__n > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    key = F.concat_ws(
        "|",
        F.lit(mixture.seed),
        F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
        F.coalesce(F.md5(F.col(text_col)), F.lit("-")),
        F.col("copy").cast("string"),
    )
    out = out.withColumn("shuffle_key", F.md5(key))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mixture_sql(mixture: Mixture, table: str = "documents") -> str:
    """DuckDB SQL for ``mix`` over a table with the columns of ``documents``."""
    names = list(mixture.weights)
    place = " ".join(f"WHEN source = '{n}' THEN {i}" for i, n in enumerate(names))
    shares = ", ".join(
        f"({i}, {w!r}::DOUBLE)" for i, w in enumerate([*mixture.weights.values(), mixture.rest])
    )
    rows = str(mixture.total) if mixture.total is not None else "(SELECT count(*) FROM numbered)"
    return f"""
WITH numbered AS (SELECT *, CASE {place} ELSE {len(names)} END AS g FROM {table}),
counts AS (SELECT g, count(*) AS n FROM numbered GROUP BY g),
shares AS (SELECT * FROM (VALUES {shares}) AS v(g, w) JOIN counts USING (g)),
rates AS (SELECT g, {rows} * w / (SELECT sum(w) FROM shares) / n AS rate FROM shares),
terms AS (SELECT g, k, CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE (k = 0)::INT END AS p
  FROM rates, range(0, 25 + (SELECT max(rate + 12 * sqrt(rate)) FROM rates)::INT) AS r(k)),
cuts AS (SELECT g, list(c ORDER BY k) AS cuts FROM (
  SELECT g, k, sum(p) OVER (PARTITION BY g ORDER BY k) AS c FROM terms) GROUP BY g),
counted AS (SELECT doc_id, text, lang, source, n_chars, len(list_filter(cuts, lambda c: c <=
  ('0x' || substr(md5('{mixture.seed}|' || coalesce(doc_id::VARCHAR, '-')), 1, 13))::BIGINT / 4503599627370496.0)) AS n
  FROM numbered JOIN cuts USING (g)),
copies AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, n))::INT AS copy FROM counted)
SELECT *, md5('{mixture.seed}|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(md5(text), '-') || '|' || copy) AS shuffle_key
FROM copies"""
