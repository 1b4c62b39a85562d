from conftest import rows
from test_sources import CONNECTION, Recorder

from lakejobs.sinks import batches, files, jdbc, topics


def test_a_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_table(spark.range(5), path, "csv")
    files.write_table(spark.range(2), path, "csv")
    assert sorted(r[0] for r in rows(spark.read.csv(path))) == ["0", "1"]


def test_a_table_is_appended_and_partitioned(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(4).selectExpr("id", "id % 2 AS part")
    files.write_table(df, path, partition_by=["part"])
    files.write_table(df, path, mode="append", partition_by=["part"])
    assert spark.read.parquet(path).count() == 8
    assert (tmp_path / "out" / "part=1").is_dir()


def test_key_value_text(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_key_value(spark.createDataFrame([("word", 3)], "w string, n int"), path)
    assert rows(spark.read.text(path)) == [("word\t3",)]


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "out")
    batches.write_batch(spark.range(3), 0, path)
    batches.write_batch(spark.range(3), 0, path)
    batches.write_batch(spark.range(2), 1, path)
    got = batches.read_batches(spark, path, spark.range(1).schema)
    assert rows(got, "batch_id", "id") == [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1)]


def test_latest_row_of_every_key(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 5, 2), ("b", 9, 1)], "k string, v int, batch_id long")
    assert rows(batches.latest(df, ["k"]), "k") == [("a", 5), ("b", 9)]


def test_a_repeated_batch_appends_only_what_is_missing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "txn_id int, v string")
    written = spark.createDataFrame([(1, 7), (3, 6)], "txn_id int, batch_id long")
    todo = jdbc.unwritten(df, written, ["txn_id"], 7)
    assert rows(todo.select("txn_id", "v", "batch_id"), "txn_id") == [(2, "y", 7), (3, "z", 7)]


def test_jdbc_append_options():
    sink = Recorder()
    sink.mode = lambda mode: sink.option("mode", mode)
    sink.save = lambda: None
    jdbc.append_table(sink, CONNECTION, "card_lost")
    assert sink.kind == "jdbc"
    assert sink.seen == CONNECTION | {"mode": "append", "dbtable": "card_lost", "batchsize": "10000"}


def test_topic_records(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert rows(topics.as_records(df.select("v"))) == [("a",)]
    assert rows(topics.as_records(df)) == [('{"id":1,"v":"a"}',)]
    assert rows(topics.as_records(df, key="id")) == [("1", "a")]
