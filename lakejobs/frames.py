"""Domain frames over the star-schema test tables.

Each function maps whole tables to the input of a job; ids and flags that the tables do
not hold are derived row by row from columns they do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is(event_type: str):
    return F.col("event_type") == event_type


def raw_plays_of(events: DataFrame) -> DataFrame:
    """Plays as ingested: text flags, some blank or missing, places and creators missing."""
    video = F.regexp_extract("props", r"\d+", 0).cast("long")
    return events.select(
        F.col("event_id").alias("play_id"),
        "user_id",
        video.alias("video_id"),
        F.floor(video / 10).alias("channel_id"),
        F.col("value").alias("minutes_played"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(_is("click"), "true")
        .when(_is("view"), "")
        .when(_is("signup"), "false")
        .alias("liked"),
        F.when(_is("error"), "true").when(_is("purchase"), " ").alias("disliked"),
        F.when(_is("purchase") | (_is("click") & (F.col("event_id") % 3 == 0)), 1)
        .otherwise(0)
        .alias("video_end_type"),
        F.when(~_is("signup"), F.concat(F.lit("G"), F.floor(video / 10))).alias("geo_cd"),
        F.when(~_is("error"), F.pmod(video, F.lit(25))).alias("creator_id"),
    )


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_plays_of(table(spark, sf_dir, "events"))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with clean flags."""
    liked = F.coalesce(F.col("liked") == "true", F.lit(False))
    return raw_plays(spark, sf_dir).withColumn("liked", liked)


def channel_geocd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as channels; a region without a place of its own is missing."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_regionkey") > 0).select(
        F.col("n_nationkey").cast("long").alias("channel_id"),
        F.concat(F.lit("G"), F.col("n_nationkey")).alias("geo_cd"),
    )


def video_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as videos; the large sizes have no creator."""
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_size") <= 40).select(
        F.col("p_partkey").alias("video_id"),
        F.pmod(F.col("p_partkey"), F.lit(25)).alias("creator_id"),
    )


def user_subscn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as subscribers with epoch dates; one market segment never subscribed."""
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "HOUSEHOLD")
    # 2024-01-15 for customers in debt, else 2024-12-31; all started on 2023-01-01.
    end = F.when(F.col("c_acctbal") < 0, 1705276800).otherwise(1735603200).cast("long")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.lit(1672531200).cast("long").alias("subscription_start_date"),
        end.alias("subscription_end_date"),
    )


def user_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("creator_id")
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("StopID"), F.col("s_name").alias("StopName")
    )
    searches = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("StopID"),
        F.round(F.col("l_discount") * 100).alias("MilesAway"),
        F.col("l_quantity").alias("NumberOfBoardings"),
    )
    return searches.join(names, "StopID")


def transaction_time():
    """An order's day, at a minute that its key gives."""
    minute = F.pmod(F.col("o_orderkey"), F.lit(1440)).cast("int")
    return F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=minute)


def transactions_of(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Orders as card transactions, spread over the minutes of their day."""
    merchants_known = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    return orders.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_custkey").alias("user_id"),
        F.pmod(F.col("o_orderkey"), merchants_known).alias("merchant_id"),
        F.col("o_totalprice").alias("amount"),
        transaction_time().alias("ts"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(spark, sf_dir, table(spark, sf_dir, "orders"))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_nationkey").cast("string").alias("postal_code"),
        F.lit("XX").alias("country_code"),
    )


def zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        n.cast("string").alias("postal_code"),
        F.lit("XX").alias("country_code"),
        (n * 5 - 60).cast("double").alias("latitude"),
        (n * 14 - 170).cast("double").alias("longitude"),
    )


def card_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of customers in debt."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return c.select(F.col("c_custkey").alias("card_id"))


def pos_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants in debt."""
    s = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)
    return s.select(F.col("s_suppkey").alias("merchant_id"))


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("credit_score")
    )


def weblog_of(events: DataFrame) -> DataFrame:
    """One access-log line per event.

    Sign-ups leave a line that is not in log format, and every 17th event one with a date
    that does not exist. Methods, statuses and referers (some quoted, with a blank) vary.
    """
    part = (
        F.when(_is("view"), "digital-cameras")
        .when(_is("click"), "Digital-Cameras")
        .otherwise(F.col("event_type"))
    )
    stamp = F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss")
    stamp = F.when(F.col("event_id") % 17 == 0, "31/Feb/2024:10:00:00").otherwise(stamp)
    status = F.when(_is("error"), "500").when(F.col("event_id") % 13 == 0, "404").otherwise("200")
    line = F.concat(
        F.lit("10.0.0."), F.col("user_id"), F.lit(" - - ["), stamp, F.lit(' +0000] "'),
        F.when(_is("purchase"), "POST").otherwise("GET"), F.lit(" /"),
        part, F.lit("/item-"), F.col("event_id"), F.lit(' HTTP/1.1" '), status, F.lit(" "),
        F.floor(F.col("value") * 100), F.lit(" "),
        F.when(_is("click"), '"http://shop/a b"').otherwise("-"), F.lit(" agent/"), F.col("props"),
    )
    broken = F.concat(F.lit("signup "), F.col("event_id"), F.lit(" "), F.col("props"))
    return events.select(F.when(_is("signup"), broken).otherwise(line).alias("value"))


def weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weblog_of(table(spark, sf_dir, "events"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("emp"),
        F.col("c_acctbal").alias("salary"),
        F.col("c_custkey").alias("dept"),
    )


def pos_lines(txns: DataFrame, places: DataFrame, *beside: str) -> DataFrame:
    """Point-of-sale stream records as comma-separated text, with the place carried.

    Fields follow ``schemas.REALTIME``; ``transDesc`` holds the transaction id. Columns
    named in ``beside`` stay beside the text.
    """
    located = txns.join(places, "merchant_id", "left")
    fields = [
        F.col("card_id"), F.col("merchant_id"), F.col("amount"), F.unix_seconds("ts"),
        F.lit("pos"), F.col("txn_id"), F.col("latitude"), F.col("longitude"),
    ]
    text = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return located.select(F.concat_ws(",", *text).alias("value"), *beside)
