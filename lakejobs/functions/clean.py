"""Cell-level cleaning."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def text_or(value: Column, default: object) -> Column:
    """The value as text, with NULL and blank replaced by ``default``."""
    return F.coalesce(blank_to_null(value.cast("string")), F.lit(str(default)))


def to_flag(value: Column) -> Column:
    """Read '1', 'true', '0', 'false' as a boolean; anything else is NULL."""
    return value.cast("string").try_cast("boolean")


def to_timestamp(value: Column, pattern: str | None = None) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern)) if pattern else value.try_cast("timestamp")
