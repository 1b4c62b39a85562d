"""File readers. Malformed records come back as a second frame instead of vanishing.

Dropping malformed rows inside the reader is not used: what is malformed there depends on
which columns the query happens to read, so a count and a collect could disagree.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from lakejobs.operators.quality import CORRUPT, split_malformed
from lakejobs.sources.listing import folder_listing


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def _without_corrupt(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name != CORRUPT])


def csv_options(
    sep: str = ",", header: bool = True, ts_format: str | None = None, encoding: str = "UTF-8"
) -> dict[str, str]:
    options = {
        "sep": sep,
        "header": str(header).lower(),
        "encoding": encoding,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": "false",
        "nullValue": "",
        "emptyValue": "",
    }
    if ts_format:
        options["timestampFormat"] = ts_format
    return options


def read_csv_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
    header: bool = True,
    ts_format: str | None = None,
    encoding: str = "UTF-8",
    sampling: float = 1.0,
) -> DataFrame:
    """CSV or TSV files, a folder or a glob, with malformed records in one more column.

    With no schema it is inferred, which costs one more pass (over a ``sampling``
    share of the lines); declare it for large inputs.
    """
    options = csv_options(sep, header, ts_format, encoding)
    if schema is None:
        inferred = spark.read.options(**options, inferSchema="true", samplingRatio=str(sampling))
        schema = _without_corrupt(inferred.csv(path).schema)
    return spark.read.schema(_with_corrupt(schema)).options(**options).csv(path)


def read_csv_checked(
    spark: SparkSession, path: str | list[str], *args, **options
) -> tuple[DataFrame, DataFrame]:
    """``read_csv_raw`` as ``(good, rejected)``.

    Using both parses the files twice; to parse large ones once, write ``read_csv_raw``
    to a table and split that (``split_malformed(…, stored=True)``).
    """
    return split_malformed(read_csv_raw(spark, path, *args, **options))


def read_xml_raw(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str = "record",
    schema: StructType | None = None,
    ts_format: str | None = None,
) -> DataFrame:
    """The ``row_tag`` elements of XML files, with malformed ones in one more column.

    The parser that takes a file apart element by element is chosen: the other one reports
    the text of the whole file for every malformed element.
    """
    options = {
        "rowTag": row_tag,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "useLegacyXMLParser": "true",
    }
    if ts_format:
        options["timestampFormat"] = ts_format
    if schema is None:
        inferred = spark.read.options(**options, inferSchema="true")
        schema = _without_corrupt(inferred.xml(path).schema)
    return spark.read.schema(_with_corrupt(schema)).options(**options).xml(path)


def read_xml_checked(
    spark: SparkSession, path: str | list[str], *args, **options
) -> tuple[DataFrame, DataFrame]:
    """``read_xml_raw`` as ``(good, rejected)``."""
    return split_malformed(read_xml_raw(spark, path, *args, **options))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines in one ``value`` column."""
    return spark.read.text(path)


def read_csv_positional(
    spark: SparkSession,
    path: str | list[str],
    fields: Mapping[int, tuple[str, str | DataType]],
    sep: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Pick fields of headerless lines by position: ``{0: ("emp", "int"), …}``.

    A line is rejected when a picked field is missing or does not read as its type.
    """
    parts = F.split(F.col("value"), f"\\Q{sep}\\E", -1)
    picked: dict[str, Column] = {
        name: F.try_element_at(parts, F.lit(i + 1)).try_cast(kind)
        for i, (name, kind) in fields.items()
    }
    raw = read_lines(spark, path).withColumns(picked)
    complete = F.lit(True)
    for name in picked:
        complete = complete & F.col(name).isNotNull()
    rejected = raw.where(~complete).select(
        F.col("value").alias("record"), F.lit("malformed").alias("reject_reason")
    )
    return raw.where(complete).select(*picked), rejected


def list_files(
    spark: SparkSession, path: str, name_pattern: str | None = None, depth: int = 1
) -> DataFrame:
    """Name, size, emptiness and name check of every file under ``path``.

    No content is read, and the names stay in the tasks that list them: one for each folder
    ``depth`` levels below ``path``.
    """
    name = F.element_at(F.split("path", "/"), -1)
    return folder_listing(spark, path, depth).select(
        name.alias("file_name"),
        "n_bytes",
        (F.col("n_bytes") == 0).alias("is_empty"),
        (name.rlike(name_pattern) if name_pattern else F.lit(True)).alias("name_ok"),
    )


def folder_report(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """Files, empty files and bytes of every folder under ``path`` that holds a file."""
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return folder_listing(spark, path, depth).groupBy(folder).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("n_bytes") == 0).alias("n_empty"),
        F.sum("n_bytes").alias("n_bytes"),
    )
