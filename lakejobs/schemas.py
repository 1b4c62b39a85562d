"""Declared schemas of the job inputs.

Every id is one type across tables (long for keys that are joined as numbers, string
for the codes), so no join relies on an implicit cast.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TS_FORMAT = "dd/MM/yyyy HH:mm:ss"


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


VIDEO_PLAYS = _schema(
    ("user_id", StringType()),
    ("video_id", StringType()),
    ("channel_id", StringType()),
    ("creator_id", StringType()),
    ("geo_cd", StringType()),
    ("minutes_played", IntegerType()),
    ("timestamp", TimestampType()),
    ("liked", BooleanType()),
    ("disliked", BooleanType()),
    ("video_end_type", IntegerType()),
)

STOPS = _schema(
    ("StopID", LongType()),
    ("StopName", StringType()),
    ("MilesAway", DoubleType()),
    ("NumberOfBoardings", IntegerType()),
)

BUREAU = _schema(
    ("user_id", LongType()),
    ("credit_score", IntegerType()),
    ("timeStamp", TimestampType()),
)

MERCHANTS = _schema(
    ("mid", StringType()),
    ("merchant_id", LongType()),
    ("merchant_type", StringType()),
    ("status", StringType()),
    ("country_code", StringType()),
    ("postal_code", StringType()),
    ("joined_date", TimestampType()),
    ("updates_date", TimestampType()),
    ("acceptable_types", StringType()),
)

ZIPCODES = _schema(
    ("country_code", StringType()),
    ("postal_code", StringType()),
    ("place_name", StringType()),
    ("admin_name1", StringType()),
    ("admin_code1", StringType()),
    ("admin_name2", StringType()),
    ("admin_code2", StringType()),
    ("admin_name3", StringType()),
    ("admin_code3", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("accuracy", IntegerType()),
)

TRANSACTIONS = _schema(
    ("card_id", LongType()),
    ("user_id", LongType()),
    ("merchant_id", LongType()),
    ("amount", DoubleType()),
    ("timestamp", TimestampType()),
    ("type", StringType()),
    ("transaction_desc", StringType()),
    ("status", StringType()),
)

# One point-of-sale stream record; ``timestamp`` is epoch seconds.
REALTIME = _schema(
    ("cardId", StringType()),
    ("merchantId", StringType()),
    ("amt", DoubleType()),
    ("timestamp", LongType()),
    ("type", StringType()),
    ("transDesc", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)
