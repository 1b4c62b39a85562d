"""What the plans look like: pruned, pushed down, partly aggregated, free of Python."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from lakejobs import frames
from lakejobs.operators.skew import DEFAULT, Skew
from lakejobs.plans import fraud, text, transit, video
from lakejobs.queries import QUERIES
from lakejobs.session import MAX_PARTITIONS, input_bytes, tune, work_dir, work_root

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text_plan = plan(QUERIES[name](spark, SF))
    for word in ("Python", "CartesianProduct", "NestedLoop", "Exchange SinglePartition, REPARTITION"):
        assert word not in text_plan


def test_scans_read_only_what_is_used(spark):
    p = plan(text.max_with_carry(frames.salaries(spark, SF), "emp", "salary", "dept"))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>" in p
    p = plan(video.royalty(frames.plays(spark, SF)))
    assert "user_id" not in p.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark):
    p = plan(fraud.low_score(frames.transactions(spark, SF), frames.bureau(spark, SF)))
    assert "LessThan(c_acctbal,250.0)" in p


def test_top_stops_is_a_top_k_over_partial_counts(spark):
    p = plan(transit.top_stops(frames.stops(spark, SF)))
    assert "TakeOrderedAndProject(limit=20" in p and "partial_count" in p


def test_strikes_are_ranked_before_the_shuffle(spark):
    geo = fraud.merchant_geo(frames.zips(spark, SF), frames.merchants(spark, SF))
    decided = fraud.decide(frames.transactions(spark, SF), geo, frames.bureau(spark, SF))
    p = plan(fraud.lost_cards(decided))
    assert "WindowGroupLimit [card_id" in p and ", 3, Partial" in p


def exchanges_of(p, column):
    return [line for line in p.splitlines() if "Exchange hashpartitioning" in line and column in line]


def test_large_sides_are_not_broadcast_and_scores_join_in_place(spark, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    geo = fraud.merchant_geo(frames.zips(spark, SF), frames.merchants(spark, SF))
    txns, bureau = frames.transactions(spark, SF), frames.bureau(spark, SF)
    p = plan(fraud.decide(txns, geo, bureau, skew=Skew(4, 1)))
    # The only broadcasts are the stored tables of hot keys and of their too full chunks.
    lines = p.splitlines()
    broadcasts = [i for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert broadcasts
    for i in broadcasts:
        below = "".join(lines[i + 1 : i + 5])
        assert "hot-keys" in below or "full-chunks" in below
    # Transactions (with the copies for cut keys) move once per (user, chunk); the scores
    # meet them there.
    assert len(exchanges_of(p, "user_chunk")) == 3


def rows_read_per_row(spark, table, run):
    """Rows that all tasks read from the files of ``table``, over its rows."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total = 0
    for execution in list(_each(store.executionsList()))[before:]:
        graph = store.planGraph(execution.executionId())
        values = store.executionMetrics(execution.executionId())
        for node in _each(graph.allNodes()):
            if node.name().startswith("Scan parquet") and f"{table}.parquet" in node.desc():
                for metric in _each(node.metrics()):
                    found = values.get(metric.accumulatorId())
                    if metric.name() == "number of output rows" and found.isDefined():
                        total += int(found.get().replace(",", ""))
    return total / spark.read.parquet(f"{SF}/{table}.parquet").count()


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


@pytest.mark.parametrize("skew, passes", [(DEFAULT, 2), (Skew(4, 1), 6)])
def test_passes_over_the_transactions(spark, monkeypatch, skew, passes):
    monkeypatch.setattr("lakejobs.queries.SKEW", skew)
    run = lambda: QUERIES["fraud_decision"](spark, SF).collect()
    assert 1 < rows_read_per_row(spark, "orders", run) <= passes


def test_scans_and_shuffles_follow_the_input(spark, conf, monkeypatch):
    shuffle = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    scan = "spark.sql.files.maxPartitionBytes"
    conf(**{name.replace(".", "__"): spark.conf.get(name, "8") for name in (shuffle, scan)})
    for n_bytes, partitions, megabytes in ((1, 8, 128), (10**12, 7450, 128), (10**14, MAX_PARTITIONS, 476)):
        monkeypatch.setattr("lakejobs.session.input_bytes", lambda *_: n_bytes)
        tune(spark, "x")
        assert int(spark.conf.get(shuffle)) == partitions
        assert int(spark.conf.get(scan)) // 2**20 == megabytes


class Elsewhere:
    """A session on a cluster, with or without a shared folder."""

    def __init__(self, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": "spark://m:7077"})()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(Elsewhere())
    assert work_root(Elsewhere("s3a://shared/cp/")) == "s3a://shared/cp"


def test_without_hot_keys_nothing_is_cut(spark):
    txns = frames.transactions(spark, SF)
    limits = fraud.amount_limits(txns, skew=DEFAULT)
    limits.collect()
    final = plan(limits).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert "Union" not in final and final.count("FileScan") == 1


def test_input_bytes_are_those_of_the_files(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    assert input_bytes(spark, str(tmp_path), f"{tmp_path}/missing") == 5
    assert input_bytes(spark, f"{tmp_path}/*", [f"{tmp_path}/a"], []) == 10


def test_work_folders_are_new_and_under_the_shared_root(spark):
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b
    assert a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_merged_sketches_are_close_to_exact_counts(spark):
    ids = spark.range(60_000)
    plays = ids.select(
        (F.col("id") % 3).alias("channel_id"),
        (F.col("id") % 20_000).alias("video_id"),
        (F.col("id") % 5_000).alias("user_id"),
        (F.col("id") % 2 == 0).alias("liked"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        F.lit(1.0).alias("minutes_played"),
    )
    sketches = video.channel_sketches(plays)
    assert sketches.count() == 3 * 42
    exact = {r.channel_id: r for r in video.popular_channels(plays).collect()}
    for r in video.merged_channels(sketches).collect():
        for column in ("count_video", "unique_likers"):
            count = exact[r.channel_id][column]
            assert abs(r[column] - count) <= 3 * video.SKETCH_ERROR * count
    # Half of the days: the sketches of a range are merged alone.
    part = sketches.where("day < '1970-01-22'")
    assert video.merged_channels(part).count() == 3
    nobody = video.channel_sketches(plays.withColumn("liked", F.lit(False)))
    assert {r.unique_likers for r in video.merged_channels(nobody).collect()} == {0}
