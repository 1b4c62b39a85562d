"""The jobs from files to files: read, check, compute, write.

Each writes its results, and what it rejected on the way, as folders under ``out``. Lookup
tables are DataFrames, from ``sources.jdbc.read_table`` or anywhere else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs import schemas
from lakejobs.operators.quality import require_non_empty, split_malformed, split_tagged
from lakejobs.plans import fraud, text, transit, video
from lakejobs.session import tune
from lakejobs.sinks.files import write_key_value, write_table
from lakejobs.sources import files


def _write_all(tables: Mapping[str, DataFrame], out: str, fmt: str) -> None:
    options = {"header": "true"} if fmt == "csv" else {}
    for name, df in tables.items():
        write_table(df, f"{out}/{name}", fmt, **options)


def _stored(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table that is read more than once, and read it back."""
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def transit_job(spark: SparkSession, stops_path: str, out: str, fmt: str = "parquet") -> None:
    """Landed stop searches -> ``top_stops``, ``max_boardings``, ``rejected``.

    The landed files are parsed once, into ``ingested``.
    """
    tune(spark, stops_path)
    ingested = _stored(files.read_csv_raw(spark, stops_path, schemas.STOPS), f"{out}/ingested")
    stops, rejected = split_malformed(ingested, stored=True)
    require_non_empty(stops, "stops")
    top = transit.top_stops(stops)
    boardings = transit.max_boardings(stops, top)
    _write_all({"top_stops": top, "max_boardings": boardings, "rejected": rejected}, out, fmt)


def video_job(
    spark: SparkSession,
    csv_path: str,
    xml_path: str,
    lookups: Mapping[str, DataFrame],
    out: str,
    fmt: str = "parquet",
) -> None:
    """Plays in CSV and XML -> ``malformed``, ``cleaned`` (by ``valid``) and six reports.

    ``lookups`` holds ``user_subscn``, ``user_creator``, ``channel_geocd`` and
    ``video_creator``. The raw files are parsed once, into ``ingested``; cleaned plays are
    computed once, and the reports read the valid ones back.
    """
    tune(spark, csv_path, xml_path)
    plays, pattern = schemas.VIDEO_PLAYS, schemas.TS_FORMAT
    from_csv = files.read_csv_raw(spark, csv_path, plays, ts_format=pattern)
    from_xml = files.read_xml_raw(spark, xml_path, "record", plays, pattern)
    ingested = _stored(video.combine_sources(from_csv, from_xml), f"{out}/ingested")
    good, malformed = split_malformed(ingested, stored=True)
    for source in ("csv", "xml"):
        require_non_empty(good.where(F.col("source") == source), f"{source} plays")
    tagged = video.tag_plays(good, lookups["channel_geocd"], lookups["video_creator"])
    valid, _ = split_tagged(_stored(tagged, f"{out}/cleaned", ["valid"]))
    subscriptions = video.subscription_times(lookups["user_subscn"])
    reports = {
        "malformed": malformed,
        "popular_channels": video.popular_channels(valid),
        "duration_by_user_type": video.duration_by_user_type(valid, subscriptions),
        "connected_creators": video.connected_creators(valid, lookups["user_creator"]),
        "royalty": video.royalty(valid),
        "creator_royalty": video.creator_royalty(valid),
        "longest_unsubscribed": video.longest_unsubscribed(valid, subscriptions),
    }
    _write_all(reports, out, fmt)


def fraud_job(
    spark: SparkSession,
    transactions: DataFrame,
    merchants_path: str,
    zips_path: str,
    bureau_path: str,
    out: str,
    fmt: str = "parquet",
    transactions_path: str | Sequence[str] = (),
    more_rejected: DataFrame | None = None,
) -> None:
    """Transactions and three files -> ``decided``, ``pos_blacklist``, ``card_lost``.

    ``transactions`` has the columns of ``schemas.TRANSACTIONS`` and a ``txn_id``; its
    ``timestamp`` is the time of the transaction. ``transactions_path`` says where they are
    read from, for sizing the shuffles, and ``more_rejected`` what was rejected there. The
    decisions are written once and read back for the two lists.
    """
    tune(spark, transactions_path, merchants_path, zips_path, bureau_path)
    merchants, bad_merchants = files.read_csv_checked(spark, merchants_path, schemas.MERCHANTS)
    zips, bad_zips = files.read_csv_checked(spark, zips_path, schemas.ZIPCODES, sep="\t")
    bureau, bad_bureau = files.read_csv_checked(spark, bureau_path, schemas.BUREAU)
    for name, df in {
        "transactions": transactions,
        "merchants": merchants,
        "zip codes": zips,
        "bureau": bureau,
    }.items():
        require_non_empty(df, name)
    txns = transactions.drop("status").withColumnRenamed("timestamp", "ts")
    decided = fraud.decide(txns, fraud.merchant_geo(zips, merchants), bureau)
    written = _stored(decided, f"{out}/decided")
    rejected = bad_merchants.unionByName(bad_zips).unionByName(bad_bureau)
    if more_rejected is not None:
        rejected = rejected.unionByName(more_rejected)
    lists = {
        "pos_blacklist": fraud.pos_blacklist(written),
        "card_lost": fraud.lost_cards(written),
        "rejected": rejected,
    }
    _write_all(lists, out, fmt)


def fraud_files_job(
    spark: SparkSession,
    transactions_path: str,
    merchants_path: str,
    zips_path: str,
    bureau_path: str,
    out: str,
    fmt: str = "parquet",
    id_column: str | None = None,
) -> None:
    """``fraud_job`` from a headerless file of transactions, which is parsed once, into
    ``ingested``.

    Records have no id of their own: ``id_column`` names the field that holds one, else it is
    a hash of the record, so that repeated records are told apart by nothing.
    """
    tune(spark, transactions_path)
    raw = files.read_csv_raw(spark, transactions_path, schemas.TRANSACTIONS, header=False)
    ingested = _stored(raw, f"{out}/ingested")
    good, rejected = split_malformed(ingested, stored=True)
    own_id = F.col(id_column) if id_column else F.xxhash64(*good.columns)
    fraud_job(
        spark, good.withColumn("txn_id", own_id), merchants_path, zips_path, bureau_path, out, fmt,
        transactions_path, rejected,
    )


def words_job(spark: SparkSession, lines_path: str, out: str, below: int = 100) -> None:
    """Text lines -> the words seen less than ``below`` times, tab-separated with their count."""
    tune(spark, lines_path)
    write_key_value(text.rare_words(files.read_lines(spark, lines_path), below), out)


# Where the employee, salary and department stand in a record.
EMPLOYEE_FIELDS = {0: ("emp", "int"), 5: ("salary", "int"), 7: ("dept", "int")}


def salaries_job(spark: SparkSession, path: str, out: str) -> None:
    """Employee records -> highest salary and its department per employee.

    Records that do not parse are written beside ``out``, under its name and ``-rejected``.
    """
    tune(spark, path)
    records, rejected = files.read_csv_positional(spark, path, EMPLOYEE_FIELDS)
    write_key_value(text.max_with_carry(records, "emp", "salary", "dept"), out)
    write_table(rejected, f"{out.rstrip('/')}-rejected")
