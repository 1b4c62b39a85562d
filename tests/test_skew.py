"""A key with a third of the rows gives the same result, in bounded pieces."""

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakejobs import frames
from lakejobs.operators import ordered, skew
from lakejobs.operators.skew import Skew
from lakejobs.plans import fraud, video

TINY = Skew(target_rows=20, sample_every=1)
ORDER = ("ts", "txn_id")


@pytest.fixture(scope="module")
def txns(spark):
    """Orders with a third on one card, some without a card, some without a time."""
    from conftest import SF

    n = F.col("txn_id")
    return (
        frames.transactions(spark, SF)
        .withColumn("card_id", F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(F.col("card_id")))
        .withColumn("user_id", F.when(n % 3 == 1, 9).otherwise(F.col("user_id")))
        .withColumn("merchant_id", F.when(n % 3 == 2, 1).otherwise(F.col("merchant_id")))
        .withColumn("ts", F.when(n % 97 != 5, F.col("ts")))
    )


@pytest.fixture(scope="module")
def geo(spark):
    from conftest import SF

    return fraud.merchant_geo(frames.zips(spark, SF), frames.merchants(spark, SF))


def test_hot_keys_are_the_large_ones(txns):
    found = skew.search(txns, ["card_id", "user_id"], ("txn_id",), Skew(200, 1))
    assert rows(found["card_id"].frame.select("card_id", skew.pieces_of(Skew(200, 1)))) == [(7, 3)]
    assert found["card_id"].n_keys == 1
    assert 9 in [r[0] for r in rows(found["user_id"].frame)]


def test_hot_keys_from_a_sample(txns):
    assert 7 in [r[0] for r in rows(skew.search(txns, ["card_id"], ("txn_id",), Skew(200, 4))["card_id"].frame)]


def test_no_key_is_hot_below_the_target(txns):
    assert skew.search(txns, ["card_id", "user_id"], ("txn_id",)) == {"card_id": None, "user_id": None}
    assert ordered.find_cuts(txns, "card_id", *ORDER) is None


def test_many_hot_keys_are_joined_without_a_hint(spark, txns, monkeypatch, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    lookup = txns.groupBy("card_id").agg(F.max("amount").alias("most"))
    hinted = skew.join_lookup(txns, lookup, "card_id", ("txn_id",), TINY)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    plain = skew.join_lookup(txns, lookup, "card_id", ("txn_id",), TINY)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(plain, "txn_id") == rows(hinted, "txn_id")


def test_chunks_are_bounded_and_in_time_order(txns):
    cuts = ordered.find_cuts(txns, "card_id", *ORDER, TINY)
    chunked = ordered.assign_chunks(txns, "card_id", *ORDER, cuts=cuts)
    sizes = chunked.groupBy("card_id", "_chunk").agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")
    )
    assert sizes.agg(F.max("n")).first()[0] <= 3 * TINY.target_rows
    bounds = rows(sizes.where("card_id = 7 and lo is not null").select("_chunk", "lo", "hi"), "_chunk")
    assert len(bounds) > 20
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


@pytest.fixture(scope="module")
def uneven(txns):
    """The hot card's time stretched by odd dates, and most of it within one day."""
    hot, n = F.col("card_id") == 7, F.col("txn_id")
    return txns.where("ts is not null").withColumn(
        "ts",
        F.when(hot & (n == 0), F.timestamp_seconds(F.lit(-60_000_000_000)))
        .when(hot & (n == 3), F.timestamp_seconds(F.lit(250_000_000_000)))
        .when(hot & (n % 2 == 0), F.timestamp_seconds(F.lit(1_700_000_000) + n * 5))
        .otherwise(F.col("ts")),
    )


def test_a_burst_on_a_stretched_timeline_is_cut_again(uneven):
    cuts = ordered.find_cuts(uneven, "card_id", *ORDER, TINY)
    assert not cuts.chunks.isEmpty()
    chunked = ordered.assign_chunks(uneven, "card_id", *ORDER, cuts=cuts)
    hot = chunked.where("card_id = 7")
    sizes = hot.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    found = rows(sizes.select("_chunk", "lo", "hi", "n"), "_chunk")
    assert all(a[2] < b[1] for a, b in zip(found, found[1:]))
    assert max(r[3] for r in found) <= 3 * TINY.target_rows
    ids = ordered.chunk_ids(cuts, "card_id", "_chunk")
    assert ids.count() == ids.distinct().count()
    assert chunked.where("_hot").join(ids, ["card_id", "_chunk"], "left_anti").isEmpty()


def test_decisions_on_a_stretched_timeline(spark, sf, uneven, geo):
    bureau = frames.bureau(spark, sf)
    uneven = uneven.withColumn("user_id", F.col("card_id"))

    def decided(settings):
        found = fraud.decide(uneven, geo, bureau, skew=settings)
        return rows(found.select("txn_id", F.round("speed", 6), "credit_score", "status"), "txn_id")

    assert decided(TINY) == decided(None)


def test_rows_without_a_key_are_spread(txns):
    cuts = ordered.find_cuts(txns, "card_id", *ORDER, TINY)
    chunked = ordered.assign_chunks(txns, "card_id", *ORDER, cuts=cuts)
    assert chunked.where("card_id is null").groupBy("_chunk").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("sample_every", [1, 3, 1000])
@pytest.mark.parametrize("k", [1, 5])
def test_windows_over_chunks_equal_windows_over_keys(txns, k, sample_every):
    settings = Skew(20, sample_every)
    cuts = ordered.find_cuts(txns, "card_id", *ORDER, settings)
    chunked = ordered.assign_chunks(txns, "card_id", *ORDER, cuts=cuts)
    ready = ordered.with_preceding(chunked, "card_id", ORDER, k, ("amount",))

    def measures(window):
        over = window.rowsBetween(-k, -1)
        return {
            "before": F.lag("txn_id", k).over(window),
            "ids": F.collect_list("txn_id").over(over),
            "high": F.max("amount").over(over),
        }

    got = ordered.drop_preceding(ready.withColumns(measures(ordered.timeline("card_id", ORDER))))
    timed = "card_id is not null and ts is not null"
    want = txns.where(timed).withColumns(measures(Window.partitionBy("card_id").orderBy(*ORDER)))
    columns = ["txn_id", "before", "ids", "high"]
    assert rows(got.where(timed).select(columns), "txn_id") == rows(want.select(columns), "txn_id")
    assert got.count() == txns.count()


def test_windows_keep_every_column_and_row(txns, geo):
    hot = fraud.last_transaction(txns, geo, TINY)
    assert hot.count() == txns.count() == hot.select("txn_id").distinct().count()


@pytest.mark.parametrize("job", ["last_transaction", "distance_over_time"])
def test_travel_is_the_same_with_and_without_cutting(txns, geo, job):
    run = getattr(fraud, job)
    assert rows(run(txns, geo, TINY), "txn_id") == rows(run(txns, geo, None), "txn_id")


def test_limits_are_the_same_with_and_without_cutting(txns):
    def limits(settings):
        found = fraud.amount_limits(txns, skew=settings)
        return rows(found.withColumns({c: F.round(c, 6) for c in ("utl", "ctl")}), "txn_id")

    assert limits(TINY) == limits(None)


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_decisions_are_the_same_with_and_without_cutting(spark, sf, conf, txns, geo, broadcast):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": broadcast})
    conf(**{"spark__sql__adaptive__autoBroadcastJoinThreshold": broadcast})
    bureau = frames.bureau(spark, sf)

    def decided(settings):
        columns = ("txn_id", "speed", "credit_score", "status", "merchant_id", "amount")
        found = fraud.decide(txns, geo, bureau, skew=settings)
        return rows(found.withColumn("speed", F.round("speed", 6)).select(*columns), "txn_id")

    assert decided(TINY) == decided(None)


def test_by_card_decisions_are_the_same_with_and_without_cutting(spark, sf, txns, geo):
    scores = frames.bureau(spark, sf).withColumnRenamed("user_id", "card_id")
    records = fraud.locate(txns, geo)

    def decided(settings):
        found = fraud.decide_by_card(records, scores, skew=settings)
        return rows(found.select("txn_id", F.round("speed", 6), "status"), "txn_id")

    assert decided(TINY) == decided(None)


def test_lookup_join_repeats_and_loses_nothing(spark, txns):
    lookup = txns.groupBy("merchant_id").agg(F.max("txn_id").alias("newest"))
    lookup = lookup.where("merchant_id <> 3")
    got = skew.join_lookup(txns, lookup, "merchant_id", ("txn_id",), TINY)
    want = txns.join(lookup, "merchant_id", "left")
    columns = ["txn_id", "merchant_id", "newest"]
    assert rows(got.select(columns), "txn_id") == rows(want.select(columns), "txn_id")


def test_lookup_join_deals_a_hot_key_over_tasks(conf, txns):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    conf(**{"spark__sql__adaptive__coalescePartitions__enabled": "false"})
    lookup = txns.groupBy("card_id").agg(F.max("txn_id").alias("newest"))

    def tasks(settings):
        joined = skew.join_lookup(txns, lookup, "card_id", ("txn_id",), settings)
        return joined.where("card_id = 7").select(F.spark_partition_id()).distinct().count()

    assert tasks(None) == 1
    assert tasks(TINY) > 4


def test_user_types_are_the_same_with_and_without_cutting(spark, sf):
    plays = frames.plays(spark, sf).withColumn(
        "user_id", F.when(F.col("play_id") % 3 == 0, 5).otherwise(F.col("user_id"))
    )
    subs = video.subscription_times(frames.user_subscn(spark, sf))
    for job in (video.duration_by_user_type, video.longest_unsubscribed):
        assert rows(job(plays, subs, skew=TINY)) == rows(job(plays, subs, skew=None))


def test_cleaning_is_the_same_with_and_without_cutting(spark, sf):
    def cleaned(settings):
        parts = video.clean_plays(
            frames.raw_plays(spark, sf),
            frames.channel_geocd(spark, sf),
            frames.video_creator(spark, sf),
            settings,
        )
        return [rows(p.select("play_id", "geo_cd", "creator_id"), "play_id") for p in parts]

    assert cleaned(TINY) == cleaned(None)


@pytest.mark.parametrize("job", ["low_score", "blacklist_hits"])
def test_joins_of_two_sources_are_split_by_adaptive_execution(spark, conf, job):
    conf(
        **{
            "spark__sql__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
            "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
            "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        }
    )
    n = F.col("id")
    many = spark.range(0, 120_000, 1, 8).select(
        n.alias("txn_id"), F.when(n % 3 == 0, 7).otherwise(n % 5000).alias("user_id"), n.alias("amount")
    )
    few = spark.range(5000).select(n.alias("user_id"), (n % 300).alias("credit_score"))
    if job == "low_score":
        df, want = fraud.low_score(many, few), many.where("user_id % 300 < 250").count()
    else:
        df, want = fraud.blacklist_hits(many, few.where("user_id % 2 = 1"), "user_id"), 80_000
    grouped = df.groupBy("user_id").count()
    total = sum(r["count"] for r in grouped.collect())
    assert total == want
    assert "skew=true" in grouped._jdf.queryExecution().executedPlan().toString()
