"""A stream gives the batch answer, however it is cut into micro-batches."""

import datetime as dt
import os

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from lakejobs import frames
from lakejobs.operators.skew import Skew
from lakejobs.plans import clicks, fraud
from lakejobs.sinks.batches import latest
from lakejobs.streaming import clicks as click_streams
from lakejobs.streaming import fraud as fraud_streams
from lakejobs.streaming import jobs
from lakejobs.streaming.sources import file_stream, in_files, stream_source


def write_lines(folder, name, lines):
    """Write a file; the stream takes files by age, so they age in the order written."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(f"{line}\n" for line in lines))
    age = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(path, (age, age))


def lines_of(spark, folder, **options):
    return stream_source(spark, "text", path=str(folder), **options)


def run(query):
    assert query.awaitTermination(240)
    assert query.exception() is None


@pytest.fixture(scope="module")
def log_lines(spark):
    """Log lines in time order."""
    events = frames.table(spark, SF, "events").orderBy("ts")
    return [r.value for r in frames.weblog_of(events).collect()]


@pytest.fixture(scope="module")
def pos_lines(spark):
    """Point-of-sale records in time order."""
    txns = frames.transactions(spark, SF).orderBy("ts", "txn_id")
    geo = fraud.merchant_geo(frames.zips(spark, SF), frames.merchants(spark, SF))
    found = frames.pos_lines(txns, geo).select("value").collect()
    return sorted((r.value for r in found), key=lambda v: (int(v.split(",")[3]), int(v.split(",")[5])))


def parts(items, n):
    size = -(-len(items) // n)
    return [items[i : i + size] for i in range(0, len(items), size)]


@pytest.mark.parametrize("pieces", [1, 4])
def test_landing_keeps_every_line(spark, tmp_path, log_lines, pieces):
    for i, part in enumerate(parts(log_lines, pieces)):
        write_lines(tmp_path / "in", f"{i}.txt", part)
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    run(jobs.land_raw(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    landed = spark.read.text(str(tmp_path / "out"))
    assert sorted(r.value for r in landed.select("value").collect()) == sorted(log_lines)
    assert landed.select("batch_id").distinct().count() == pieces


def test_landing_skips_an_empty_batch(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", [])
    write_lines(tmp_path / "in", "1.txt", ["a"])
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    run(jobs.land_raw(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert len(list((tmp_path / "out").iterdir())) == 1


def test_one_parquet_file_is_a_stream(spark, tmp_path):
    path = f"{SF}/nation.parquet"
    nations = file_stream(spark, path, spark.read.parquet(path).schema)
    run(jobs.start(nations, jobs.into_batches(str(tmp_path / "out")), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25


def test_a_large_stream_file_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("value"), "id")
    in_files(lines, path, "id", 1)
    seen = []

    def look(batch, batch_id):
        # Rows in each task that reads the file: a task can get a range of it without rows.
        seen.append(batch.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())

    stream = file_stream(spark, path, lines.schema, maxFilesPerTrigger="1")
    run(jobs.start(stream, look, str(tmp_path / "checkpoint")))
    assert [sum(tasks) for tasks in seen] == [300_000]
    assert len([n for n in seen[0] if n]) > 1


@pytest.mark.parametrize("pieces", [1, 4])
def test_status_windows_equal_the_batch(spark, tmp_path, log_lines, pieces):
    for i, part in enumerate(parts(log_lines, pieces)):
        write_lines(tmp_path / "in", f"{i}.txt", part)
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    run(click_streams.status_windows(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = latest(spark.read.parquet(str(tmp_path / "out")), ["window_start"])
    parsed, _ = clicks.parse_log(frames.weblog(spark, SF))
    want = clicks.windowed_status(parsed)
    assert rows(got, "window_start") == rows(want, "window_start")


def test_a_restart_goes_on_from_the_checkpoint(spark, tmp_path, log_lines):
    first, second = parts(log_lines, 2)
    for name, part in (("0.txt", first), ("1.txt", second)):
        write_lines(tmp_path / "in", name, part)
        lines = lines_of(spark, tmp_path / "in")
        run(click_streams.status_windows(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = latest(spark.read.parquet(str(tmp_path / "out")), ["window_start"])
    parsed, _ = clicks.parse_log(frames.weblog(spark, SF))
    assert rows(got, "window_start") == rows(clicks.windowed_status(parsed), "window_start")


def hit(second, n=1, status=200):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
    line = f'1.1.1.1 - - [{at:%d/%b/%Y:%H:%M:%S} +0000] "GET /a HTTP/1.1" {status} 1 - x'
    return [line] * n


def test_an_alert_counts_over_micro_batches(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", hit(0, 60) + hit(1, 100))
    write_lines(tmp_path / "in", "1.txt", hit(0, 60) + hit(2, 3))
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    run(click_streams.rate_alerts(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    found = latest(spark.read.parquet(str(tmp_path / "out")), ["window_start"])
    assert rows(found.select("n_requests", "alert")) == [(120, "n_requests > 100")]


def test_failure_alerts(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", hit(0, 300, 500) + hit(299, 201, 404) + hit(300, 500, 500))
    lines = lines_of(spark, tmp_path / "in")
    run(click_streams.failure_alerts(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.select("failures", "alert")) == [(501, "failures > 500")]


def test_the_monitor_runs_every_query(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", hit(0, 101) + hit(7, 501, 503))
    root = str(tmp_path / "out")
    for query in click_streams.monitor(lines_of(spark, tmp_path / "in"), root):
        run(query)
    assert rows(spark.read.parquet(f"{root}/rate_alerts").select("observed"), "observed") == [(101,), (501,)]
    assert rows(spark.read.parquet(f"{root}/failure_alerts").select("observed")) == [(501,)]
    assert rows(spark.read.parquet(f"{root}/status_windows").select("successes")) == [(101,)]


def test_a_stream_runs_at_an_interval_until_stopped(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", ["a"])
    out = tmp_path / "out"
    query = jobs.land_raw(lines_of(spark, tmp_path / "in"), str(out), str(tmp_path / "cp"), "1 second")
    try:
        query.processAllAvailable()
        write_lines(tmp_path / "in", "1.txt", ["b"])
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert sorted(r.value for r in spark.read.text(str(out)).collect()) == ["a", "b"]


def scores(spark):
    return frames.bureau(spark, SF).select(
        F.col("user_id").cast("string").alias("card_id"), "credit_score"
    )


@pytest.mark.parametrize("pieces, skew", [(1, None), (5, None), (3, Skew(5, 1))])
def test_stream_decisions_equal_the_batch(spark, tmp_path, pos_lines, pieces, skew):
    for i, part in enumerate(parts(pos_lines, pieces)):
        write_lines(tmp_path / "in", f"{i}.txt", part)
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    run(fraud_streams.decide_stream(lines, scores(spark), out, str(tmp_path / "cp"), skew=skew))
    geo = fraud.merchant_geo(frames.zips(spark, SF), frames.merchants(spark, SF))
    want = fraud.decide(frames.transactions(spark, SF), geo, frames.bureau(spark, SF), skew=None)
    got = spark.read.parquet(f"{out}/decided")
    columns = [F.col("txn_id").cast("long"), F.round("speed", 6), "status"]
    assert sorted(rows(got.select(columns))) == sorted(rows(want.select(columns)))
    assert spark.read.parquet(f"{out}/late").isEmpty()
    assert len(list((tmp_path / "out" / "memory").iterdir())) == min(pieces, 2)


def pos(card, second, amount, name):
    return f"{card},m1,{amount},{second},pos,{name},1.0,1.0"


def test_records_before_the_last_decided_are_set_apart(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", [pos("a", 100, 5, "t1"), pos("b", 50, 5, "t2")])
    write_lines(tmp_path / "in", "1.txt", [pos("a", 90, 5, "t3"), pos("b", 60, 5, "t4"), pos("c", 1, 5, "t5")])
    lines = lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    run(fraud_streams.decide_stream(lines, scores(spark), out, str(tmp_path / "cp")))
    ids = lambda name: sorted(r[0] for r in rows(spark.read.parquet(f"{out}/{name}").select("txn_id")))
    assert ids("decided") == ["t1", "t2", "t4", "t5"]
    assert ids("late") == ["t3"]


def test_memory_is_the_last_records_of_a_card(spark):
    rows_in = [("a", dt.datetime(2024, 1, 1, 0, i), f"t{i}", 0.0, 0.0, float(i)) for i in range(8)]
    schema = "card_id string, ts timestamp, txn_id string, latitude double, longitude double, amount double"
    df = spark.createDataFrame([*rows_in, (None, *rows_in[0][1:])], schema)
    kept = fraud_streams.remember(df)
    assert sorted(r.txn_id for r in kept.collect()) == ["t3", "t4", "t5", "t6", "t7"]


def test_blacklists_are_read_again_for_every_batch(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", [pos("a", 1, 5, "t1"), pos("b", 2, 5, "t2")])
    write_lines(tmp_path / "in", "1.txt", [pos("a", 3, 5, "t3"), pos("b", 4, 5, "t4")])
    cards = spark.createDataFrame([("a",), ("b",)], "card_id string")
    reads = []

    def read_cards():
        reads.append(1)
        return cards if len(reads) > 1 else cards.where("card_id = 'a'")

    run(
        fraud_streams.blacklist_query(
            lines_of(spark, tmp_path / "in", maxFilesPerTrigger="1"),
            read_cards,
            lambda: spark.createDataFrame([("m9",)], "merchant_id string"),
            jobs.into_batches(str(tmp_path / "out")),
            str(tmp_path / "cp"),
        )
    )
    hits = spark.read.parquet(str(tmp_path / "out"))
    assert rows(hits.select("txn_id", "matched_on"), "txn_id") == [
        ("t1", "card_id"),
        ("t3", "card_id"),
        ("t4", "card_id"),
    ]


def test_a_record_on_both_lists_is_written_for_each(spark, tmp_path):
    write_lines(tmp_path / "in", "0.txt", [pos("a", 1, 5, "t1")])
    run(
        fraud_streams.blacklist_query(
            lines_of(spark, tmp_path / "in"),
            lambda: spark.createDataFrame([("a",)], "card_id string"),
            lambda: spark.createDataFrame([("m1",)], "merchant_id string"),
            jobs.into_batches(str(tmp_path / "out")),
            str(tmp_path / "cp"),
        )
    )
    hits = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.matched_on for r in hits.collect()) == ["card_id", "merchant_id"]


def test_strikes_count_over_micro_batches(spark, tmp_path):
    def decided(name, *merchants):
        df = spark.createDataFrame([(m, "Suspicious") for m in merchants], "merchant_id string, status string")
        df.coalesce(1).write.parquet(str(tmp_path / "in" / name))

    schema = "merchant_id string, status string"
    for name, merchants in (("batch_id=0", "mmn"), ("batch_id=1", "mnx")):
        decided(name, *merchants)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        run(fraud_streams.strike_counts(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    found = latest(spark.read.parquet(str(tmp_path / "out")), ["merchant_id"])
    assert rows(found) == [("m", 3)]
