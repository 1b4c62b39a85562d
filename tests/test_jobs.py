"""Transit, text and video jobs on hand-made frames."""

import datetime as dt
from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakejobs.plans import text, transit, video

STOPS = "StopID long, StopName string, MilesAway double, NumberOfBoardings int"


def test_top_stops_and_their_boardings(spark):
    stops = spark.createDataFrame(
        [(1, "A", 1.0, 5), (1, "A", 9.0, 50), (2, "B", 2.0, 7), (2, "B", 2.9, 1), (3, "C", 3.0, 99)],
        STOPS,
    )
    top = transit.top_stops(stops)
    assert rows(top) == [(2, "B", 2), (1, "A", 1)]
    assert rows(transit.max_boardings(stops, top), "StopName") == [("A", 50), ("B", 7)]
    assert rows(transit.top_stops(stops, n=1)) == [(2, "B", 2)]


def test_all_stops_without_a_limit(spark):
    stops = spark.createDataFrame([(i, f"s{i}", 0.0, 1) for i in range(30)], STOPS)
    assert transit.top_stops(stops).count() == 20
    assert transit.top_stops(stops, n=None).count() == 30


def test_tokens_are_lower_case_and_whole(spark):
    lines = spark.createDataFrame([("  The the\tTHE\ncat\f\rdog ",), ("",), (None,)], "value string")
    assert dict(rows(text.word_count(lines))) == {"the": 3, "cat": 1, "dog": 1}


def test_rare_words_are_below_the_limit(spark):
    lines = spark.createDataFrame([("a " * 100 + "b " * 99,)], "value string")
    assert rows(text.rare_words(lines)) == [("b", 99)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aAbB \t\n\r\f", max_size=30), min_size=1, max_size=10))
def test_word_counts_are_those_of_python(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert dict(rows(text.word_count(df))) == Counter(w for line in lines for w in line.lower().split())


def test_highest_salary_with_its_department(spark):
    df = spark.createDataFrame(
        [(1, -5, 3), (1, -9, 4), (2, 7, 1), (2, 7, 2), (2, 3, 9)], "emp int, salary int, dept int"
    )
    assert rows(text.max_with_carry(df, "emp", "salary", "dept"), "emp") == [(1, -5, 3), (2, 7, 2)]


PLAYS = (
    "user_id long, video_id long, channel_id long, creator_id long, minutes_played double, "
    "timestamp timestamp, liked boolean, video_end_type int"
)
NOON = dt.datetime(2024, 1, 10, 12)


def plays(spark, *some):
    return spark.createDataFrame(
        [(u, v, v // 10, v % 2, m, NOON, liked, end) for u, v, m, liked, end in some], PLAYS
    )


def test_popular_channels(spark):
    df = plays(spark, (1, 1, 5.0, True, 0), (2, 1, 9.0, True, 0), (2, 2, 1.0, False, 0), (3, 11, 2.0, True, 1))
    assert rows(video.popular_channels(df)) == [(0, 2, 2, 9.0), (1, 1, 1, 2.0)]
    assert rows(video.popular_channels(df, approx=0.01)) == [(0, 2, 2, 9.0), (1, 1, 1, 2.0)]


def test_user_types_at_the_boundary(spark):
    df = plays(spark, *[(u, 1, 1.5, False, 0) for u in (1, 2, 3, 4)])
    ends = [
        (1, NOON),
        (2, NOON - dt.timedelta(seconds=1)),
        (4, NOON - dt.timedelta(days=9)),
        (4, NOON + dt.timedelta(days=9)),
    ]
    subs = spark.createDataFrame(ends, "user_id long, subscription_end timestamp")
    typed = video.with_user_type(df, subs)
    assert rows(typed.select("user_id", "user_type"), "user_id") == [
        (1, "subscribed"),
        (2, "unsubscribed"),
        (3, "unsubscribed"),
        (4, "subscribed"),
    ]
    assert rows(video.duration_by_user_type(df, subs), "user_type") == [
        ("subscribed", 3.0),
        ("unsubscribed", 3.0),
    ]
    assert rows(video.longest_unsubscribed(df, subs, n=1)) == [(2, 1.5)]
    assert video.longest_unsubscribed(df, subs, n=None).count() == 2


def test_subscription_dates_are_epoch_seconds(spark):
    df = spark.createDataFrame(
        [(1, 0, 86400)], "user_id long, subscription_start_date long, subscription_end_date long"
    )
    assert rows(video.subscription_times(df)) == [
        (1, dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2))
    ]


def test_creators_by_followers_who_watched(spark):
    df = plays(spark, (1, 1, 1.0, False, 0), (1, 2, 1.0, False, 0), (2, 1, 1.0, False, 0))
    follows = spark.createDataFrame(
        [(1, 100), (1, 100), (2, 100), (2, 200), (9, 300)], "user_id long, creator_id long"
    )
    assert rows(video.connected_creators(df, follows)) == [(100, 2), (200, 1)]


def test_royalty_for_liked_finished_or_both(spark):
    df = plays(
        spark, (1, 1, 1.0, True, 0), (1, 2, 2.0, False, 1), (1, 2, 0.5, True, 1), (1, 3, 9.0, False, 0)
    )
    assert rows(video.royalty(df)) == [(2, 2.5), (1, 1.0)]
    assert rows(video.royalty(df, mode="and")) == [(2, 0.5)]
    assert rows(video.creator_royalty(df)) == [(0, 2.5), (1, 1.0)]
