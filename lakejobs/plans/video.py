"""Video-play analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.functions import clean
from lakejobs.operators import quality, sets
from lakejobs.operators.skew import DEFAULT, Skew, join_lookup

SUBSCRIBED, UNSUBSCRIBED = "subscribed", "unsubscribed"


def combine_sources(csv_plays: DataFrame, xml_plays: DataFrame) -> DataFrame:
    """Plays of both sources, with the source named."""
    return sets.union_rows(
        csv_plays.withColumn("source", F.lit("csv")), xml_plays.withColumn("source", F.lit("xml"))
    )


def tag_plays(
    plays: DataFrame,
    channel_geocd: DataFrame,
    video_creator: DataFrame,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Cleaned plays with ``valid`` and ``reject_reason``.

    Missing likes and dislikes count as 0; a missing place is looked up by channel and a
    missing creator by video. A play still without one of them is not valid.
    """
    filled = quality.fill_default(quality.empty_to_null(plays), {"liked": 0, "disliked": 0})
    clean_flags = {c: clean.to_flag(F.col(c)) for c in ("liked", "disliked")}
    found = filled.withColumns(clean_flags)
    by = ("user_id", "timestamp")
    for lookup, key, target in (
        (channel_geocd, "channel_id", "geo_cd"),
        (video_creator, "video_id", "creator_id"),
    ):
        found = quality.enrich_from_lookup(found, lookup, key, target, by, skew, plays)
    return quality.tag_valid(found, ["geo_cd", "creator_id"])


def clean_plays(
    plays: DataFrame,
    channel_geocd: DataFrame,
    video_creator: DataFrame,
    skew: Skew | None = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """The valid plays, and the others with their reason."""
    return quality.split_tagged(tag_plays(plays, channel_geocd, video_creator, skew))


# Sketches hold 2^SKETCH_BITS registers: a relative standard error of 1.04 / 2^(bits / 2).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def channel_sketches(plays: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Per channel and day, sketches of the videos played and of the users who liked one.

    A few kilobytes each, whatever the day brings. Stored once, they are merged over any
    range of days by ``merged_channels``; users and videos need not be read again. Rows
    without a time are of no day and are left out.
    """
    likers = F.when(F.col("liked"), F.col("user_id"))
    return (
        plays.where(F.col("timestamp").isNotNull())
        .groupBy("channel_id", F.to_date("timestamp").alias("day"))
        .agg(
            F.hll_sketch_agg("video_id", bits).alias("videos"),
            F.hll_sketch_agg(likers, bits).alias("likers"),
            F.max("minutes_played").alias("max_video_played"),
        )
    )


def merged_channels(sketches: DataFrame) -> DataFrame:
    """``popular_channels`` from the sketches of some days, its counts as estimates."""
    estimate = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c, True))
    return (
        sketches.groupBy("channel_id")
        .agg(
            estimate("videos").alias("count_video"),
            estimate("likers").alias("unique_likers"),
            F.max("max_video_played").alias("max_video_played"),
        )
        .orderBy(F.col("count_video").desc(), F.col("unique_likers").desc(), "channel_id")
    )


def popular_channels(plays: DataFrame, approx: float | None = None) -> DataFrame:
    """Channels by number of different videos played, then by users who liked one.

    Counts are exact; ``approx`` is the relative error to allow where estimates will do,
    which shuffles a sketch per channel in place of every different user.
    """

    def different(column: Column) -> Column:
        return F.approx_count_distinct(column, approx) if approx else F.countDistinct(column)

    return (
        plays.groupBy("channel_id")
        .agg(
            different(F.col("video_id")).alias("count_video"),
            different(F.when(F.col("liked"), F.col("user_id"))).alias("unique_likers"),
            F.max("minutes_played").alias("max_video_played"),
        )
        .orderBy(F.col("count_video").desc(), F.col("unique_likers").desc(), "channel_id")
    )


def with_user_type(
    plays: DataFrame, subscriptions: DataFrame, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Add ``user_type``: unsubscribed without a subscription that lasts until the play.

    Subscriptions are reduced to the last end per user, so no play is repeated.
    """
    last_end = subscriptions.groupBy("user_id").agg(F.max("subscription_end").alias("_end"))
    subscribed = F.coalesce(F.col("_end") >= F.col("timestamp"), F.lit(False))
    return (
        join_lookup(plays, last_end, "user_id", ("timestamp", "video_id"), skew)
        .withColumn("user_type", F.when(subscribed, SUBSCRIBED).otherwise(UNSUBSCRIBED))
        .drop("_end")
    )


def subscription_times(subscriptions: DataFrame) -> DataFrame:
    """Read a lookup table whose dates are epoch seconds."""
    return subscriptions.select(
        "user_id",
        F.timestamp_seconds("subscription_start_date").alias("subscription_start"),
        F.timestamp_seconds("subscription_end_date").alias("subscription_end"),
    )


def _total_minutes(column: str = "minutes_played") -> Column:
    """Exact sum: doubles added in another order give another last digit."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias("duration")


def duration_by_user_type(
    plays: DataFrame, subscriptions: DataFrame, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Total minutes played by each type of user."""
    return with_user_type(plays, subscriptions, skew).groupBy("user_type").agg(_total_minutes())


def connected_creators(
    plays: DataFrame, user_creator: DataFrame, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Creators by number of different followers who watched something.

    Plays are reduced to different users before the join: a heavy viewer joins once.
    """
    watchers = plays.select("user_id").distinct().withColumn("_watched", F.lit(True))
    follows = user_creator.select("user_id", "creator_id").distinct()
    return (
        join_lookup(follows, watchers, "user_id", ("creator_id",), skew, user_creator)
        .where("_watched")
        .groupBy("creator_id")
        .agg(F.count("user_id").alias("count_user"))
        .orderBy(F.col("count_user").desc(), "creator_id")
    )


def _earning(plays: DataFrame, mode: str) -> DataFrame:
    liked, finished = F.col("liked"), F.col("video_end_type") == 1
    return plays.where(liked & finished if mode == "and" else liked | finished)


def _minutes_by(plays: DataFrame, key: str) -> DataFrame:
    return plays.groupBy(key).agg(_total_minutes()).orderBy(F.col("duration").desc(), key)


def royalty(plays: DataFrame, mode: str = "or") -> DataFrame:
    """Minutes per video over plays that were liked, finished, or both (``mode="or"``).

    ``mode="and"`` keeps only plays that were both.
    """
    return _minutes_by(_earning(plays, mode), "video_id")


def creator_royalty(plays: DataFrame, mode: str = "or") -> DataFrame:
    """The same minutes per creator."""
    return _minutes_by(_earning(plays, mode), "creator_id")


def longest_unsubscribed(
    plays: DataFrame, subscriptions: DataFrame, n: int | None = 10, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Users with the most minutes watched while unsubscribed."""
    typed = with_user_type(plays, subscriptions, skew)
    watched = _minutes_by(typed.where(F.col("user_type") == UNSUBSCRIBED), "user_id")
    return watched if n is None else watched.limit(n)
