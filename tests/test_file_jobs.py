"""The jobs from files to files."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs import jobs, schemas
from lakejobs.sources import files


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_transit(spark, tmp_path):
    landing = put(tmp_path / "in", "a.csv", "StopID,StopName,MilesAway,NumberOfBoardings\n1,A,1,5\n")
    put(tmp_path / "in", "b.csv", "StopID,StopName,MilesAway,NumberOfBoardings\n1,A,9,50\nx,B,1,1\n")
    out = str(tmp_path / "out")
    jobs.transit_job(spark, f"{landing}/*", out)
    assert rows(spark.read.parquet(f"{out}/top_stops")) == [(1, "A", 1)]
    assert rows(spark.read.parquet(f"{out}/max_boardings")) == [("A", 50)]
    assert rows(spark.read.parquet(f"{out}/rejected")) == [("x,B,1,1", "malformed")]


def test_an_empty_landing_folder_is_refused(spark, tmp_path):
    landing = put(tmp_path / "in", "a.csv", "StopID,StopName,MilesAway,NumberOfBoardings\n")
    with pytest.raises(ValueError, match="stops is empty"):
        jobs.transit_job(spark, landing, str(tmp_path / "out"))


def test_video(spark, tmp_path):
    header = ",".join(f.name for f in schemas.VIDEO_PLAYS)
    csv = put(
        tmp_path / "csv",
        "plays.csv",
        f"{header}\n"
        "u1,v1,c1,k1,G1,10,01/02/2024 10:00:00,true,,1\n"
        "u2,v1,c1,,,20,01/02/2024 10:00:00,,,0\n"
        "u3,v9,c9,,,30,01/02/2024 10:00:00,,,0\n"
        "u3,v9,c9,,,many,01/02/2024 10:00:00,,,0\n",
    )
    xml = put(
        tmp_path / "xml",
        "plays.xml",
        "<plays><record><user_id>u2</user_id><video_id>v2</video_id><channel_id>c1</channel_id>"
        "<creator_id>k2</creator_id><geo_cd>G1</geo_cd><minutes_played>5</minutes_played>"
        "<timestamp>02/02/2024 10:00:00</timestamp><video_end_type>1</video_end_type></record></plays>",
    )
    lookups = {
        "channel_geocd": spark.createDataFrame([("c1", "G1")], "channel_id string, geo_cd string"),
        "video_creator": spark.createDataFrame([("v1", "k1")], "video_id string, creator_id string"),
        "user_creator": spark.createDataFrame([("u1", "k1"), ("u2", "k1")], "user_id string, creator_id string"),
        "user_subscn": spark.createDataFrame(
            [("u1", 0, 4102444800)],
            "user_id string, subscription_start_date long, subscription_end_date long",
        ),
    }
    out = str(tmp_path / "out")
    jobs.video_job(spark, csv, xml, lookups, out)

    def read(name):
        return spark.read.parquet(f"{out}/{name}")

    processed = read("cleaned").where("valid = 'true'").select("user_id", "video_id", "geo_cd", "creator_id", "liked", "disliked", "source")
    assert rows(processed, "user_id", "video_id") == [
        ("u1", "v1", "G1", "k1", True, False, "csv"),
        ("u2", "v1", "G1", "k1", False, False, "csv"),
        ("u2", "v2", "G1", "k2", False, False, "xml"),
    ]
    invalid = read("cleaned").where("valid = 'false'").select("user_id", "reject_reason")
    assert rows(invalid) == [("u3", "missing geo_cd,missing creator_id")]
    assert read("malformed").count() == 1
    assert rows(read("popular_channels")) == [("c1", 2, 1, 20)]
    assert rows(read("duration_by_user_type"), "user_type") == [("subscribed", 10.0), ("unsubscribed", 25.0)]
    assert rows(read("connected_creators")) == [("k1", 2)]
    assert rows(read("royalty"), "video_id") == [("v1", 10.0), ("v2", 5.0)]
    assert rows(read("creator_royalty"), "creator_id") == [("k1", 10.0), ("k2", 5.0)]
    assert rows(read("longest_unsubscribed")) == [("u2", 25.0)]


def test_fraud(spark, tmp_path):
    merchants = put(
        tmp_path / "m",
        "m.csv",
        ",".join(f.name for f in schemas.MERCHANTS)
        + "\nm1,1,shop,open,DE,10115,2020-01-01 00:00:00,2020-01-01 00:00:00,visa"
        + "\nm2,2,shop,open,US,10001,2020-01-01 00:00:00,2020-01-01 00:00:00,visa\n",
    )
    place = ["", "", "", "", "", "", ""]
    zips = put(
        tmp_path / "z",
        "z.txt",
        "\t".join(f.name for f in schemas.ZIPCODES)
        + "\n"
        + "\t".join(["DE", "10115", *place, "52.5", "13.4", "4"])
        + "\n"
        + "\t".join(["US", "10001", *place, "40.7", "-74.0", "4"])
        + "\n",
    )
    bureau = put(tmp_path / "b", "b.csv", "user_id,credit_score,timeStamp\n1,700,2024-01-01 00:00:00\n")
    times = ["10:00:00", "10:05:00", "10:10:00", "10:15:00"]
    t = put(
        tmp_path / "t",
        "t.csv",
        "".join(f"1,1,{1 + i % 2},50,2024-01-01 {at},pos,item,new\n" for i, at in enumerate(times)),
    )
    txns, _ = files.read_csv_checked(spark, t, schemas.TRANSACTIONS, header=False)
    txns = txns.withColumn("txn_id", F.unix_seconds("timestamp"))
    out = str(tmp_path / "out")
    jobs.fraud_job(spark, txns, merchants, zips, bureau, out)
    decided = spark.read.parquet(f"{out}/decided").orderBy("ts")
    assert [r.status for r in decided.collect()] == ["Approved"] + ["Suspicious"] * 3
    lost = spark.read.parquet(f"{out}/card_lost")
    assert [(r.card_id, str(r.lost_date)) for r in lost.collect()] == [(1, "2024-01-01 10:15:00")]
    assert spark.read.parquet(f"{out}/pos_blacklist").isEmpty()
    assert spark.read.parquet(f"{out}/rejected").isEmpty()


def test_words(spark, tmp_path):
    lines = put(tmp_path / "in", "l.txt", "a b A\n")
    jobs.words_job(spark, lines, str(tmp_path / "out"), below=2)
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("b\t1",)]


def test_salaries(spark, tmp_path):
    path = put(tmp_path / "in", "e.csv", "7,a,b,c,d,100,e,3\n7,a,b,c,d,90,e,4\n")
    jobs.salaries_job(spark, path, str(tmp_path / "out"))
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("7\t100\t3",)]


def test_fraud_from_a_headerless_file(spark, tmp_path):
    good = "".join(f"1,1,10,{a},2024-01-01 10:{m}:00,pos,d,new\n" for a, m in ((5, "00"), (6, "05")))
    t = put(tmp_path / "t", "t.csv", good + "broken\n1,x,10,5,2024-01-01 10:00:00,pos,d,new\n")
    names = lambda schema, sep=",": sep.join(f.name for f in schema)
    shop = "\nm1,10,shop,open,DE,10115,2020-01-01 00:00:00,2020-01-01 00:00:00,visa\n"
    merchants = put(tmp_path / "m", "m.csv", names(schemas.MERCHANTS) + shop)
    place = "\t".join(["DE", "10115", *[""] * 7, "52.5", "13.4", "4"])
    zips = put(tmp_path / "z", "z.txt", names(schemas.ZIPCODES, "\t") + f"\n{place}\n")
    bureau = put(tmp_path / "b", "b.csv", "user_id,credit_score,timeStamp\n1,700,2024-01-01 00:00:00\n")
    out = str(tmp_path / "out")
    jobs.fraud_files_job(spark, t, merchants, zips, bureau, out)
    decided = spark.read.parquet(f"{out}/decided")
    assert sorted((r.amount, r.status) for r in decided.collect()) == [(5.0, "Approved"), (6.0, "Approved")]
    assert decided.select("txn_id").distinct().count() == 2
    assert sorted(r.record for r in spark.read.parquet(f"{out}/rejected").collect())[1] == "broken"
