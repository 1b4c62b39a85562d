import pytest
from conftest import rows
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from lakejobs import schemas
from lakejobs.operators import quality
from lakejobs.sources import files, jdbc, topics
from lakejobs.sources.listing import folder_listing

PLAYS = StructType(
    [
        StructField("id", LongType()),
        StructField("minutes", IntegerType()),
        StructField("at", TimestampType()),
    ]
)
GOOD = "1,10,01/02/2024 10:00:00"
BAD = ["2,ten,01/02/2024 10:00:00", "3,5", "4,6,2024-02-01", "5,7,02/02/2024 11:00:00,extra"]


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["id,minutes,at", GOOD, *BAD]) + "\n")
    (tmp_path / "b.csv").write_text("id,minutes,at\n6,,03/02/2024 23:59:59\n")
    return str(tmp_path)


def test_good_and_rejected_make_up_the_file(spark, csv_dir):
    good, rejected = files.read_csv_checked(spark, csv_dir, PLAYS, ts_format=schemas.TS_FORMAT)
    assert [r[:2] for r in rows(good, "id")] == [(1, 10), (6, None)]
    assert sorted(r[0] for r in rows(rejected)) == sorted(BAD)


def test_the_split_does_not_depend_on_the_columns_read(spark, csv_dir):
    good, rejected = files.read_csv_checked(spark, csv_dir, PLAYS, ts_format=schemas.TS_FORMAT)
    assert good.count() == good.select("id").count() == len(good.select("minutes").collect()) == 2
    assert rejected.count() == len(rejected.select("record").collect()) == 4
    assert rejected.select("reject_reason").distinct().count() == 1


def test_a_glob_reads_a_landing_folder(spark, csv_dir):
    good, _ = files.read_csv_checked(spark, f"{csv_dir}/*", PLAYS, ts_format=schemas.TS_FORMAT)
    assert good.count() == 2


def test_an_inferred_schema(spark, tmp_path):
    (tmp_path / "s.csv").write_text("StopID,StopName,MilesAway\n1,A,0.5\n2,B,2\n")
    good, rejected = files.read_csv_checked(spark, str(tmp_path))
    assert dict(good.dtypes) == {"StopID": "int", "StopName": "string", "MilesAway": "double"}
    assert (good.count(), rejected.count()) == (2, 0)


def test_tabs_and_utf8(spark, tmp_path):
    line = ["DE", "80331", "München"] + [""] * 6 + ["48.1", "11.5", "4"]
    names = [f.name for f in schemas.ZIPCODES]
    (tmp_path / "z.txt").write_text("\t".join(names) + "\n" + "\t".join(line) + "\n", "utf-8")
    good, rejected = files.read_csv_checked(spark, str(tmp_path), schemas.ZIPCODES, sep="\t")
    row = good.first()
    assert (row.place_name, row.latitude, row.admin_name1) == ("München", 48.1, None)
    assert rejected.isEmpty()


def test_no_header_keeps_the_first_line(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "1,1,5,120,2024-01-01 10:00:00,pos,coffee,new\n2,1,5,9.5,2024-01-01 11:00:00,pos,tea,new\n"
    )
    good, rejected = files.read_csv_checked(spark, str(tmp_path), schemas.TRANSACTIONS, header=False)
    assert [r.amount for r in good.orderBy("card_id").collect()] == [120.0, 9.5]
    assert rejected.isEmpty()


XML = """<plays>
<record><user_id>u1</user_id><minutes>3</minutes></record>
<record><user_id>u2</user_id><minutes>many</minutes></record>
<record><user_id>u3</user_id></record>
</plays>"""


def test_xml_rows(spark, tmp_path):
    (tmp_path / "p.xml").write_text(XML)
    schema = StructType([StructField("user_id", StringType()), StructField("minutes", IntegerType())])
    good, rejected = files.read_xml_checked(spark, str(tmp_path), "record", schema)
    assert rows(good, "user_id") == [("u1", 3), ("u3", None)]
    assert good.count() == 2 and rejected.count() == 1
    assert "many" in rejected.first().record


def test_a_malformed_xml_record_is_reported_alone(spark, tmp_path):
    record = "<record><id>{}</id><minutes>{}</minutes></record>"
    text = "".join(record.format(i, "ten" if i % 4 == 0 else i) for i in range(1, 9))
    (tmp_path / "p.xml").write_text(f"<records>{text}</records>")
    good, rejected = files.read_xml_checked(spark, str(tmp_path), "record", PLAYS)
    assert [r[0] for r in rows(good, "id")] == [1, 2, 3, 5, 6, 7]
    told = [r[0].replace("\n", "").replace(" ", "") for r in rows(rejected, "record")]
    assert told == [record.format(4, "ten"), record.format(8, "ten")]


def test_xml_inferred(spark, tmp_path):
    (tmp_path / "p.xml").write_text(XML.replace("many", "7"))
    good, rejected = files.read_xml_checked(spark, str(tmp_path))
    assert rows(good.select("user_id", "minutes"), "user_id") == [("u1", 3), ("u2", 7), ("u3", None)]
    assert rejected.count() == 0


def test_positional_fields(spark, tmp_path):
    (tmp_path / "e.csv").write_text("7,a,b,c,d,100,e,3\n8,a,b,c,d,-5,e,4\n9,a\n7,a,b,c,d,x,e,1\n")
    fields = {0: ("emp", "int"), 5: ("sal", "int"), 7: ("dept", "int")}
    good, rejected = files.read_csv_positional(spark, str(tmp_path), fields)
    assert rows(good, "emp") == [(7, 100, 3), (8, -5, 4)]
    assert sorted(r[0] for r in rows(rejected)) == ["7,a,b,c,d,x,e,1", "9,a"]


def test_positional_fields_with_a_pattern_character_between(spark, tmp_path):
    (tmp_path / "e.csv").write_text("7|9\n")
    good, _ = files.read_csv_positional(spark, str(tmp_path), {1: ("v", "int")}, sep="|")
    assert rows(good) == [(9,)]


def test_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a b\n\nc\n")
    assert [r[0] for r in rows(files.read_lines(spark, str(tmp_path)))] == ["a b", "", "c"]


def test_file_list_names_empty_and_misnamed_files(spark, tmp_path):
    (tmp_path / "plays_1.csv").write_text("x\n")
    (tmp_path / "plays_2.csv").write_text("")
    (tmp_path / "other.txt").write_text("y")
    listed = files.list_files(spark, str(tmp_path), r"^plays_\d+\.csv$")
    assert rows(listed, "file_name") == [
        ("other.txt", 1, False, False),
        ("plays_1.csv", 2, False, True),
        ("plays_2.csv", 0, True, True),
    ]


@pytest.mark.parametrize("depth", [0, 1, 2, 5])
def test_every_file_is_listed_once_at_any_depth(spark, tmp_path, depth):
    for name in ("a.csv", "d=1/b.csv", "d=1/e=2/c c.csv", "d=3/e=2/%41.csv", "_tmp/x.csv", "d=1/.x.crc", "_k=1/z"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("xy")
    (tmp_path / "nothing").mkdir()
    listed = rows(folder_listing(spark, str(tmp_path), depth), "path")
    names = ("_k=1/z", "a.csv", "d=1/b.csv", "d=1/e=2/c c.csv", "d=3/e=2/%41.csv")
    assert listed == [(f"{tmp_path}/{name}", 2) for name in names]


def test_folders_are_reported_with_their_empty_files(spark, tmp_path):
    for name, text in (("k=1/a", "xyz"), ("k=1/b", ""), ("k=2/c", ""), ("top", "x")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "k=3").mkdir()
    report = rows(files.folder_report(spark, str(tmp_path)), "folder")
    assert report == [(str(tmp_path), 1, 0, 1), (f"{tmp_path}/k=1", 2, 1, 3), (f"{tmp_path}/k=2", 1, 1, 0)]


def test_an_empty_folder_has_no_files(spark, tmp_path):
    assert files.list_files(spark, str(tmp_path)).count() == 0


def test_file_report_counts_rows(spark, csv_dir):
    raw = spark.read.schema(PLAYS).option("header", True).csv(csv_dir)
    report = quality.file_report(raw, r"^a").drop("file_path")
    assert rows(report, "file_name") == [("a.csv", 5, True), ("b.csv", 1, False)]


class Recorder:
    """Stands in for a reader or writer and its session; keeps what it is told."""

    def __init__(self):
        self.read = self.readStream = self.write = self.writeStream = self
        self.kind, self.seen = None, {}

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen |= more
        return self

    def load(self):
        return self

    columns = ["key", "value", "partition", "offset", "topic", "timestamp"]

    def selectExpr(self, *expressions):
        self.expressions = expressions
        return self

    def select(self, *names):
        self.selected = names
        return self


CONNECTION = {"url": "jdbc:x://host/db", "user": "u", "password": "p", "driver": "d"}


def test_jdbc_scan_options():
    spark = Recorder()
    jdbc.read_table(spark, CONNECTION, "user_subscn", jdbc.Partition("user_id", 0, 1000, 16))
    assert spark.kind == "jdbc"
    assert spark.seen == CONNECTION | {
        "fetchsize": "10000",
        "dbtable": "user_subscn",
        "partitionColumn": "user_id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "16",
    }


def test_jdbc_lookup_is_one_task():
    spark = Recorder()
    jdbc.read_table(spark, CONNECTION, "card_blacklist")
    assert "numPartitions" not in spark.seen


def test_topic_dump_reads_from_the_start_to_now():
    spark = Recorder()
    dump = topics.kafka_dump(spark, "b:9092", "t")
    assert spark.kind == "kafka"
    assert spark.seen["startingOffsets"] == "earliest" and spark.seen["endingOffsets"] == "latest"
    assert dump.selected == ("key", "value", "partition", "offset", "topic")
    assert dump.expressions[:2] == ("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def test_topic_stream_reads_new_records():
    spark = Recorder()
    topics.kafka_stream(spark, "b:9092", "web", maxOffsetsPerTrigger="1000")
    assert spark.seen == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "web",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
