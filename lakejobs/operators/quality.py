"""Checks and repairs on ingested rows. Nothing is dropped: what fails is returned apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from lakejobs.functions import clean
from lakejobs.operators.skew import DEFAULT, Skew, join_lookup

CORRUPT = "_corrupt_record"
REASON = "reject_reason"


def split_malformed(
    raw: DataFrame, corrupt: str = CORRUPT, stored: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split a PERMISSIVE read into parsed rows and rejected records.

    Which records count as malformed depends on the columns the reader is asked for, so
    a later ``select`` or ``count`` could move rows from one side to the other. Every
    column is therefore mentioned in the filter, in a test that is always true. A
    ``stored`` read, written to a table with its corrupt-record column, needs none.
    """
    fields = [c for c in raw.columns if c != corrupt]
    parsed = F.lit(True) if stored else F.hash(*fields) >= F.lit(-(2**31))
    good = raw.where(parsed & F.col(corrupt).isNull()).drop(corrupt)
    rejected = raw.where(parsed & F.col(corrupt).isNotNull()).select(
        F.col(corrupt).alias("record"), F.lit("malformed").alias(REASON)
    )
    return good, rejected


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def empty_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns(
        {c: clean.blank_to_null(F.col(c)) for c in (string_columns(df) if cols is None else cols)}
    )


def fill_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL, blank or absent columns become the default, as text."""
    return df.withColumns(
        {
            c: clean.text_or(F.col(c), value) if c in df.columns else F.lit(str(value))
            for c, value in defaults.items()
        }
    )


def fill_strings(df: DataFrame, value: str = "") -> DataFrame:
    return df.na.fill(value)


def enrich_from_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    target: str,
    spread: Sequence[str],
    skew: Skew | None = DEFAULT,
    source: DataFrame | None = None,
) -> DataFrame:
    """Fill ``target`` where it is missing with the lookup's value for ``key``.

    The lookup is first reduced to one value per key so that no row is repeated.
    For ``spread`` and ``source`` see ``skew.join_lookup``.
    """
    one_per_key = lookup.groupBy(key).agg(F.min(target).alias("_found"))
    present = F.col(target) if target in df.columns else F.lit(None)
    found = join_lookup(df, one_per_key, key, spread, skew, source)
    return found.withColumn(target, F.coalesce(present, "_found")).drop("_found")


def tag_valid(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add ``reject_reason`` (empty on a good row) and ``valid``."""
    tagged = df.withColumn(REASON, missing_reason(required))
    return tagged.withColumn("valid", F.col(REASON) == "")


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        tagged.where(F.col("valid")).drop("valid", REASON),
        tagged.where(~F.col("valid")).drop("valid"),
    )


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column, and the others with the missing ones named."""
    return split_tagged(tag_valid(df, required))


def missing_reason(required: Sequence[str]) -> Column:
    return F.concat_ws(
        ",", *[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    )


def check_types(
    df: DataFrame, schema: StructType, ts_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to ``schema``; a value present but unreadable rejects its row.

    Returns typed rows and rejected rows (as they came, with the bad columns named).
    """
    typed = {
        f.name: clean.to_timestamp(F.col(f.name), ts_format)
        if isinstance(f.dataType, TimestampType)
        else F.col(f.name).try_cast(f.dataType)
        for f in schema.fields
    }
    bad = F.concat_ws(
        ",",
        *[
            F.when(F.col(c).isNotNull() & value.isNull(), F.lit(f"bad {c}"))
            for c, value in typed.items()
        ],
    )
    tagged = df.withColumn(REASON, bad)
    good = tagged.where(F.col(REASON) == "").drop(REASON).withColumns(typed)
    return good, tagged.where(F.col(REASON) != "")


def file_report(df: DataFrame, name_pattern: str | None = None) -> DataFrame:
    """Rows per source file of a file-backed frame, and whether its name is as expected."""
    report = (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
        )
        .groupBy("file_path", "file_name")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return report.withColumn(
        "name_ok", F.col("file_name").rlike(name_pattern) if name_pattern else F.lit(True)
    )


def require_non_empty(df: DataFrame, name: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df
