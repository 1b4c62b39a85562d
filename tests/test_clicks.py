import datetime as dt

import pytest
from conftest import rows

from lakejobs.plans import clicks

LINE = (
    '10.0.0.1 - bob [05/Mar/2024:10:00:01 +0000] "GET /digital-cameras/a/b?x=1 HTTP/1.1" '
    '200 512 http://r/ Mozilla 5.0 (X11)'
)


def parse(spark, *lines):
    return clicks.parse_log(spark.createDataFrame([(v,) for v in lines], "value string"))


def test_every_field(spark):
    parsed, rejected = parse(spark, LINE)
    assert rows(parsed) == [
        (
            "10.0.0.1",
            dt.datetime(2024, 3, 5, 10, 0, 1),
            "GET",
            "digital-cameras/a/b?x=1",
            200,
            512,
            "http://r/",
            "Mozilla 5.0 (X11)",
        )
    ]
    assert rejected.isEmpty()


@pytest.mark.parametrize(
    "old, new, column, want",
    [
        (" HTTP/1.1", "", "path", "digital-cameras/a/b?x=1"),
        ("/digital-cameras/a/b?x=1", "/", "path", ""),
        ("512", "-", "bytes", None),
        ("+0000", "+0200", "ts", dt.datetime(2024, 3, 5, 8, 0, 1)),
        ("Mozilla 5.0 (X11)", "", "agent", ""),
        ("Mozilla", "Moz$1\\illa", "agent", "Moz$1\\illa 5.0 (X11)"),
    ],
)
def test_variants(spark, old, new, column, want):
    parsed, rejected = parse(spark, LINE.replace(old, new))
    assert rows(parsed.select(column)) == [(want,)]
    assert rejected.isEmpty()


@pytest.mark.parametrize(
    "line",
    ["", "hello", LINE.replace("200", "20"), LINE.replace('"', ""), LINE + "\x01", "\x01" * 8, None],
)
def test_other_lines_are_rejected_whole(spark, line):
    parsed, rejected = parse(spark, line)
    assert parsed.isEmpty()
    assert rows(rejected) == [(line, "malformed")]


@pytest.mark.parametrize("date", ["45/Mar/2024", "31/Feb/2024"])
def test_times_that_no_calendar_has_are_rejected(spark, date):
    line = LINE.replace("05/Mar/2024", date)
    parsed, rejected = parse(spark, line)
    assert parsed.isEmpty()
    assert rows(rejected) == [(line, "impossible time")]


def test_a_quoted_referer_may_hold_blanks(spark):
    line = '1.2.3.4 - - [05/Mar/2024:10:00:01 +0000] "GET /a HTTP/1.1" 200 5 "http://x/y z" "Mozilla/5.0"'
    parsed, _ = parse(spark, line)
    assert rows(parsed.select("referer", "agent")) == [('"http://x/y z"', '"Mozilla/5.0"')]


def at(second, status=200, path="digital-cameras/1", ip="a"):
    return (ip, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second), path, status)


PARSED = "ip string, ts timestamp, path string, status int"


def test_request_rate_and_alerts(spark):
    hits = [at(0.1)] * 3 + [at(0.9, ip="b")] + [at(1.0)] * 2
    rate = clicks.request_rate(spark.createDataFrame(hits, PARSED))
    assert [r[1] for r in rows(rate, "window_start")] == [4, 2]
    found = clicks.alerts(rate, "n_requests", 3)
    assert [tuple(r)[1:] for r in found.collect()] == [(4, "n_requests > 3", 4)]
    by_ip = clicks.request_rate(spark.createDataFrame(hits, PARSED), by=["ip"])
    assert sorted(r["n_requests"] for r in by_ip.collect()) == [1, 2, 3]


def test_exactly_the_limit_is_no_alert(spark):
    rate = clicks.request_rate(spark.createDataFrame([at(0)] * 100, PARSED))
    assert clicks.alerts(rate, "n_requests").isEmpty()


def test_status_windows_and_category(spark):
    hits = [
        at(0),
        at(299, 404, "DIGITAL-cameras/2"),
        at(299, 500, "digital-camerasx/2"),
        at(300, 200, "books/1"),
    ]
    df = spark.createDataFrame(hits, PARSED)
    start = dt.datetime(2024, 1, 1)
    later = start + dt.timedelta(minutes=5)
    assert rows(clicks.windowed_status(df), "window_start") == [(start, 2, 1, 2), (later, 0, 1, 0)]
    assert rows(clicks.category_counts(df)) == [(start, 2)]
    assert clicks.category_counts(df, "Books").first().category_hits == 1


@pytest.mark.parametrize("buckets", [1, 2, 65_536])
@pytest.mark.parametrize("limit", [0, 2, 99])
def test_heavy_clients_are_counted_exactly_whoever_shares_their_bucket(spark, buckets, limit):
    line = '{} - - [05/Mar/2024:10:0{}:{:02} +0000] "GET /a HTTP/1.1" 200 1 - x'
    asked = [(f"10.0.0.{c}", m, s) for c in range(6) for m in range(3) for s in range((c * m) % 5)]
    parsed, _ = parse(spark, *[line.format(*a) for a in asked])
    want = {}
    for client, minute, _ in asked:
        want[client, minute] = want.get((client, minute), 0) + 1
    heavy = clicks.heavy_clients(parsed, limit, "1 minute", buckets=buckets)
    got = {(r["ip"], r["window_start"].minute): r["n_requests"] for r in heavy.collect()}
    assert got == {k: n for k, n in want.items() if n > limit}


def test_buckets_found_several_times_do_not_count_twice(spark):
    parsed, _ = parse(spark, LINE, LINE)
    crowded = clicks.crowded_buckets(parsed, 1)
    heavy = clicks.heavy_clients(parsed, 1, crowded=crowded.union(crowded))
    assert [r["n_requests"] for r in heavy.collect()] == [2]
