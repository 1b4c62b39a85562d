import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from lakejobs import schemas
from lakejobs.operators import quality, sets
from lakejobs.plans import video


def test_blank_becomes_null(spark):
    df = spark.createDataFrame([("", 1), ("  ", 2), (" a ", 3), (None, 4)], "s string, n int")
    assert rows(quality.empty_to_null(df), "n") == [(None, 1), (None, 2), ("a", 3), (None, 4)]


def test_defaults_for_null_blank_and_absent(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "true")], "id int, liked string")
    got = quality.fill_default(df, {"liked": 0, "disliked": 0})
    assert rows(got, "id") == [(1, "0", "0"), (2, "0", "0"), (3, "true", "0")]


def test_strings_only_are_filled(spark):
    df = spark.createDataFrame([(None, None)], "s string, n int")
    assert rows(quality.fill_strings(df)) == [("", None)]


def test_lookup_fills_only_what_is_missing(spark):
    df = spark.createDataFrame([("c1", "X"), ("c1", None), ("c2", None)], "ch string, geo string")
    lookup = spark.createDataFrame([("c1", "A"), ("c1", "B")], "ch string, geo string")
    got = quality.enrich_from_lookup(df, lookup, "ch", "geo", ("ch",))
    assert sorted(rows(got.select("ch", "geo")), key=str) == [("c1", "A"), ("c1", "X"), ("c2", None)]


def test_lookup_adds_an_absent_column(spark):
    df = spark.createDataFrame([("c1",)], "ch string")
    lookup = spark.createDataFrame([("c1", "A")], "ch string, geo string")
    got = quality.enrich_from_lookup(df, lookup, "ch", "geo", ("ch",), None)
    assert got.first().asDict() == {"ch": "c1", "geo": "A"}


def test_rows_missing_something_are_rejected_with_the_reason(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, None, 3), (3, None, None)], "id int, g string, c int")
    valid, rejected = quality.split_valid(df, ["g", "c"])
    assert rows(valid) == [(1, "a", 2)]
    assert rows(rejected.select("id", quality.REASON), "id") == [
        (2, "missing g"),
        (3, "missing g,missing c"),
    ]


def test_type_checks(spark):
    df = spark.createDataFrame(
        [("1", "01/02/2024 03:04:05"), ("x", "2024"), (None, None)], "n string, at string"
    )
    schema = StructType([StructField("n", IntegerType()), StructField("at", TimestampType())])
    good, rejected = quality.check_types(df, schema, schemas.TS_FORMAT)
    assert sorted(rows(good), key=str) == [(1, dt.datetime(2024, 2, 1, 3, 4, 5)), (None, None)]
    assert rows(rejected) == [("x", "2024", "bad n,bad at")]


def test_an_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="plays is empty"):
        quality.require_non_empty(spark.range(0), "plays")
    assert quality.require_non_empty(spark.range(1)).count() == 1


def test_set_operations(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(2,), (3,)], "a int")
    assert rows(sets.except_rows(left, right), "a") == [(1,)]
    assert rows(sets.union_rows(left, right), "a") == [(1,), (1,), (2,), (2,), (3,)]
    assert rows(sets.distinct_rows(left), "a") == [(1,), (2,)]


def test_two_sources_of_plays(spark):
    plays = spark.createDataFrame([(1,)], "play_id int")
    both = video.combine_sources(plays, plays)
    assert rows(both, "source") == [(1, "csv"), (1, "xml")]


text = st.one_of(st.none(), st.text(alphabet=" \ta01tf", max_size=4))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(text, text), min_size=1, max_size=20))
def test_cleaning_twice_changes_nothing(spark, cells):
    df = spark.createDataFrame(cells, "liked string, disliked string")
    once = quality.fill_default(quality.empty_to_null(df), {"liked": 0, "disliked": 0})
    twice = quality.fill_default(quality.empty_to_null(once), {"liked": 0, "disliked": 0})
    assert sorted(rows(once)) == sorted(rows(twice))
    assert all(v is not None and v.strip(" ") for r in rows(once) for v in r)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789x-", max_size=5), min_size=1, max_size=20))
def test_good_and_rejected_are_everything(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    good, rejected = quality.check_types(df, StructType([StructField("v", LongType())]))
    ids = [r[0] for r in rows(good.select("id"))] + [r[0] for r in rows(rejected.select("id"))]
    assert sorted(ids) == list(range(len(values)))
