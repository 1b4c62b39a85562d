import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakejobs.functions.geo import distance_km, speed
from lakejobs.plans import fraud

START = dt.datetime(2024, 5, 1)
TXN = "txn_id long, card_id long, user_id long, merchant_id long, amount double, ts timestamp"
GEO = "merchant_id long, latitude double, longitude double"


def txns(spark, *some):
    """(card, merchant, amount, minute) in order of id; the user is the card."""
    return spark.createDataFrame(
        [
            (i, card, card, shop, float(amount), START + dt.timedelta(minutes=minute))
            for i, (card, shop, amount, minute) in enumerate(some)
        ],
        TXN,
    )


@pytest.fixture
def geo(spark):
    return spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 90.0), (3, 0.0, 0.1)], GEO)


@pytest.fixture
def bureau(spark):
    return spark.createDataFrame([(1, 700), (2, 100), (2, 800)], "user_id long, credit_score int")


def distance(spark, *point):
    df = spark.createDataFrame([point], "a double, b double, c double, d double")
    return df.select(distance_km(*[F.col(c) for c in "abcd"])).first()[0]


def test_distances(spark):
    assert distance(spark, 0.0, 0.0, 0.0, 180.0) == pytest.approx(6371 * 3.14159265, rel=1e-6)
    assert distance(spark, 52.3, 13.4, 52.3, 13.4) == 0.0
    assert distance(spark, 52.3, 13.4, None, 13.4) is None
    assert distance(spark, None, 13.4, None, 13.4) is None


coordinate = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(coordinate, coordinate)
def test_distance_is_symmetric_and_at_most_half_way_round(spark, a, b):
    there, back = distance(spark, *a, *b), distance(spark, *b, *a)
    assert there == pytest.approx(back, abs=1e-3)
    assert 0 <= there <= 6371 * 3.1416


@pytest.mark.parametrize(
    "km, minutes, want",
    [
        (26.0, 2.0, 13.0),
        (0.0, 0.0, 0.0),
        (1.0, 0.0, float("inf")),
        (None, 0.0, None),
        (1.0, None, None),
    ],
)
def test_speed(spark, km, minutes, want):
    df = spark.createDataFrame([(km, minutes)], "km double, m double")
    assert df.select(speed(F.col("km"), F.col("m"))).first()[0] == want


def test_merchants_are_placed_by_both_codes(spark):
    zips = spark.createDataFrame(
        [("1", "DE", 1.0, 2.0), ("1", "FR", 3.0, 4.0)],
        "postal_code string, country_code string, latitude double, longitude double",
    )
    shops = spark.createDataFrame(
        [(7, "1", "FR"), (8, "2", "FR")], "merchant_id long, postal_code string, country_code string"
    )
    assert rows(fraud.merchant_geo(zips, shops)) == [(3.0, 4.0, 7)]


def test_a_merchant_placed_twice_repeats_no_transaction(spark, geo, bureau):
    twice = geo.unionByName(geo.withColumn("latitude", F.lit(50.0)))
    decided = fraud.decide(txns(spark, (1, 1, 5, 0), (1, 2, 5, 9)), twice, bureau)
    assert decided.count() == 2


def test_the_previous_transaction_is_that_of_the_card(spark, geo):
    df = txns(spark, (1, 1, 5, 0), (2, 2, 5, 1), (1, 3, 5, 10), (2, 9, 5, 11))
    last = fraud.last_transaction(df, geo).select("txn_id", "last_txn_id", "last_longitude")
    assert rows(last, "txn_id") == [(0, None, None), (1, None, None), (2, 0, 0.0), (3, 1, 90.0)]
    dot = fraud.distance_over_time(df, geo)
    got = rows(dot.select("txn_id", F.round("distance", 2), "minutes", F.round("speed", 3)), "txn_id")
    assert got == [(0, None, None, None), (1, None, None, None), (2, 11.12, 10.0, 1.112), (3, None, 10.0, None)]


def test_a_score_below_the_limit(spark):
    bureau = spark.createDataFrame([(1, 250), (2, 249)], "user_id long, credit_score int")
    df = txns(spark, (1, 1, 5, 0), (2, 1, 5, 1), (2, 1, 6, 2), (3, 1, 5, 3))
    assert rows(fraud.low_score(df, bureau), "txn_id") == [(1, 2, 249), (2, 2, 249)]


def test_limits_use_five_earlier_amounts(spark):
    df = txns(spark, *[(1, 1, a, i) for i, a in enumerate([1000, 10, 10, 10, 10, 10, 10])])
    got = rows(fraud.amount_limits(df).select("txn_id", "utl", "ctl"), "txn_id")
    assert got[0][1:] == got[1][1:] == (None, None)
    assert got[6][1:] == (20.0, 50.0)
    assert got[5][1] > 400


@pytest.mark.parametrize(
    "amount, status",
    [(20, "Approved"), (20.01, "Approval Pending"), (50, "Approval Pending"), (50.01, "Suspicious")],
)
def test_amounts_at_the_limits(spark, geo, bureau, amount, status):
    df = txns(spark, *[(1, 1, a, i) for i, a in enumerate([10, 10, 10, amount])])
    assert fraud.decide(df, geo, bureau).where("txn_id = 3").first().status == status


def test_too_fast_and_no_time_between(spark, geo, bureau):
    df = txns(spark, (1, 1, 5, 0), (1, 2, 5, 1), (1, 2, 5, 1), (1, 3, 5, 1))
    decided = fraud.decide(df, geo, bureau)
    got = rows(decided.select("speed", "status"), "txn_id")
    assert [r[1] for r in got] == ["Approved", "Suspicious", "Approved", "Suspicious"]
    assert got[2][0] == 0.0 and got[3][0] == float("inf")


def test_the_lowest_score_counts_once(spark, geo, bureau):
    decided = fraud.decide(txns(spark, (2, 1, 5, 0), (3, 1, 5, 0)), geo, bureau)
    assert rows(decided.select("txn_id", "credit_score", "status"), "txn_id") == [
        (0, 100, "Suspicious"),
        (1, None, "Approved"),
    ]


def test_both_decisions_agree(spark, geo, bureau):
    df = txns(spark, *[(i % 3, i % 4, (i * 37) % 100, i * 7) for i in range(60)])
    scores = bureau.withColumnRenamed("user_id", "card_id")
    a = fraud.decide(df, geo, bureau).select("txn_id", "speed", "utl", "ctl", "status")
    b = fraud.decide_by_card(fraud.locate(df, geo), scores).select(a.columns)
    assert rows(a, "txn_id") == rows(b, "txn_id")


cell = st.one_of(st.none(), st.floats(-1e6, 1e6))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([True, False, None]), st.sampled_from([True, False, None]), cell, cell, cell), min_size=1, max_size=10))
def test_every_row_has_one_status(spark, cells):
    df = spark.createDataFrame(cells, "fast boolean, low boolean, amount double, utl double, ctl double")
    status = fraud.verdict(*[F.col(c) for c in ("fast", "low", "amount", "utl", "ctl")])
    for fast, low, amount, utl, ctl, got in rows(df.withColumn("status", status)):
        over_ctl = amount is not None and ctl is not None and amount > ctl
        over_utl = amount is not None and utl is not None and amount > utl
        want = "Suspicious" if fast or low or over_ctl else "Approval Pending" if over_utl else "Approved"
        assert got == want


DECIDED = "txn_id long, card_id long, merchant_id long, ts timestamp, status string"


def decided(spark, *some):
    return spark.createDataFrame(
        [(i, c, m, START + dt.timedelta(minutes=i), s) for i, (c, m, s) in enumerate(some)], DECIDED
    )


def test_three_strikes(spark):
    s, a = "Suspicious", "Approved"
    df = decided(spark, (1, 9, s), (1, 9, s), (1, 9, a), (2, 9, s), (1, 8, s), (1, 8, s), (2, 8, s))
    assert rows(fraud.pos_blacklist(df), "merchant_id") == [(8, 3), (9, 3)]
    assert rows(fraud.lost_cards(df)) == [(1, START + dt.timedelta(minutes=4))]
    assert rows(fraud.lost_cards(df, strikes=2), "card_id") == [
        (1, START + dt.timedelta(minutes=1)),
        (2, START + dt.timedelta(minutes=6)),
    ]


def test_blacklists_keep_repeats_out(spark):
    df = txns(spark, (1, 1, 5, 0), (2, 1, 5, 0), (None, 1, 5, 0))
    blacklist = spark.createDataFrame([(1,), (1,), (None,)], "card_id long")
    assert rows(fraud.blacklist_hits(df, blacklist, "card_id").select("txn_id")) == [(0,)]


def test_stream_records(spark):
    lines = spark.createDataFrame(
        [("c1,m1,9.5,60,pos,t1,1.5,2.5",), ("c1,m1,much,60,pos,t2,1,2",), ("c1,m1",), ("c2,,1,0,pos,t3,,",)],
        "value string",
    )
    records, rejected = fraud.parse_stream(lines)
    assert rows(records, "txn_id") == [
        ("c1", "m1", 9.5, dt.datetime(1970, 1, 1, 0, 1), "pos", "t1", 1.5, 2.5),
        ("c2", None, 1.0, dt.datetime(1970, 1, 1), "pos", "t3", None, None),
    ]
    assert sorted(r[0] for r in rows(rejected)) == ["c1,m1", "c1,m1,much,60,pos,t2,1,2"]


def test_incomplete_records_are_rejected(spark):
    values = [None, "", ",,5,,,,,", "c,m,5,60,pos,,1,2", "c,m,5,60,pos,t,1,2"]
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    records, rejected = fraud.parse_stream(lines)
    assert [r["txn_id"] for r in records.collect()] == ["t"]
    assert rejected.count() + records.count() == len(values)
    assert {r["reject_reason"] for r in rejected.collect()} <= {"malformed", "incomplete"}
