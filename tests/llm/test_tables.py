"""Url filters, mixing, WARC archives, fingerprints and the pipeline."""

import hashlib
import io
import math
import re
from collections import Counter, defaultdict

import pytest
from odd import none, odd_docs
from oracle_check import connect, normal
from pyspark.sql import functions as F

from lakejobs.llm import fingerprints, mixing, queries, url_filters, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    want = connect(SF).sql(queries.ORACLES[name])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(want.columns, want.fetchall())


URLS = [
    ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1"),
    ("https://example.net/de/", "example.net", "/de/"),
    ("ftp://other.net", "other.net", ""),
    ("http://b.example.com/de/x", "b.example.com", "/de/x"),
    ("http://b.example.com/fr/x", "b.example.com", "/fr/x"),
    ("http://c.example.org/fr/", "c.example.org", "/fr/"),
    ("http://c.example.org?q=://z", "c.example.org", ""),
    ("http://c.example.org#frag/fr/", "c.example.org", ""),
    ("no scheme", "", ""),
    (None, "", ""),
    ("://x/", "x", "/"),
    ("http://notexample.net/en/", "notexample.net", "/en/"),
]


def brute_rule(host, path):
    fits = []
    for rule in queries.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            fits.append((len(rule.pattern), rule.pattern, rule.verdict))
    return max(fits)[1:] if fits else (None, None)


def brute_verdicts(rows, settings=url_filters.Settings()):
    """Dense power iteration over (host, path, html) rows; verdicts in order."""
    edges, nodes = Counter(), {h for h, _, _ in rows if h}
    for host, _, html in rows:
        if host:
            for to in {m.lower() for m in re.findall(url_filters.LINKS, html or "")}:
                if to != host:
                    edges[host, to] += 1
                    nodes.add(to)
    tree = set()
    for node in list(nodes):
        labels = node.split(".")
        for i in range(max(0, len(labels) - 2)):
            a, b = ".".join(labels[i:]), ".".join(labels[i + 1 :])
            tree |= {(a, b), (b, a)}
    for e in tree:
        edges[e] += 1
    pages, seeds = Counter(), {"allow": Counter(), "block": Counter()}
    for host, path, _ in rows:
        pages[host] += 1
        verdict = brute_rule(host, path)[1]
        if verdict and host:
            seeds[verdict][host] += 1
    ranks = {}
    for kind, seed in seeds.items():
        moves = [((a, b) if kind == "allow" else (b, a), n) for (a, b), n in edges.items()]
        out = Counter()
        for (a, _), n in moves:
            out[a] += n
        rank = dict(seed)
        for _ in range(settings.rounds):
            new = defaultdict(float, {h: v * (1 - settings.damping) for h, v in seed.items()})
            for (a, b), n in moves:
                if a in rank:
                    new[b] += settings.damping * rank[a] * n / out[a]
            rank = new
        ranks[kind] = rank
    verdicts = []
    for host, path, _ in rows:
        ruled = brute_rule(host, path)[1]
        per = lambda k: ranks[k].get(host, 0) / pages[host] / (1 - settings.damping)
        far = per("block") - per("allow") > settings.margin if host else False
        verdicts.append(ruled or ("block" if far else "allow"))
    return verdicts


def test_urls_and_rules(spark):
    html = {
        0: '<a href="http://b.example.com/x">x</a> <IMG SRC=//Cdn.Example.org/y>',
        3: "<a href='https://spam.example.info/'>s</a>" * 3,
        5: None,
        6: "",
        8: '<a href="http://z.example.com/">',
    }
    rows = [(i, u, html.get(i, "<p>"), "x", 1) for i, (u, _, _) in enumerate(URLS)]
    rows += [(50 + i, f"http://spam.example.info/{i}", "<a href=//b.example.com>", "x", 1) for i in range(3)]
    rows += [(60, "http://b.example.com/de/2", "", "x", 1), (60, "http://b.example.com/de/2", "", "x", 1), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, trust int")
    got = url_filters.judge(pages, queries.RULES).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, (_, host, path) in enumerate(URLS):
        assert (by_id[i]["host"], by_id[i]["path"]) == (host, path)
        assert by_id[i]["rule"] == brute_rule(host, path)[0]
    plain = [(by_id[r[0]]["host"], by_id[r[0]]["path"], r[2]) for r in rows]
    want = brute_verdicts(plain)
    assert [by_id[r[0]]["verdict"] for r in rows] == want
    assert {"allow", "block"} == set(want)
    empty = spark.createDataFrame([], pages.schema)
    assert url_filters.judge(empty, queries.RULES).count() == 0


def test_distrust_reaches_hosts_far_from_a_seed(spark):
    html = lambda to: f'<a href="http://{to}/">'
    rows = [(i, f"http://h{i}.zz/", html(f"h{i + 1}.zz")) for i in range(11)]
    rows += [(100 + i, "http://h11.zz/bad/", "") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filters.judge(pages, [url_filters.Rule(url_filters.BLOCK, "h11.zz/")]).collect()}
    for i in range(11):
        assert got[i]["distrust"] == pytest.approx(60 * 0.85 ** (11 - i), rel=0.01)
        assert got[i]["verdict"] == "block"


def test_query_verdicts_over_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    got = {r["page_id"]: r for r in queries.op4_url_filters(spark, SF).collect()}
    rows = [(got[p]["host"], got[p]["path"], h) for p, h in zip(pages.page_id, pages.html)]
    assert [got[p]["verdict"] for p in pages.page_id] == brute_verdicts(rows)


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 7.5, 200.0])
def test_thresholds_are_the_poisson_distribution(rate):
    cuts = mixing.thresholds(rate)
    assert cuts[0] == pytest.approx(math.exp(-rate))
    assert cuts[-1] == pytest.approx(1)
    mean = sum(k * (b - a) for k, (a, b) in enumerate(zip([0, *cuts], cuts)))
    assert mean == pytest.approx(rate, abs=1e-6)


def test_mixture_meets_its_weights(spark):
    docs = spark.range(20_000).selectExpr(
        "id doc_id", "'t' || id text", "if(id % 3 = 0, 'big', if(id % 2 = 0, 'a', null)) source", "'x' copy"
    )
    mixture = mixing.Mixture({"big": 1.0, "a": 2.0}, rest=1.0, total=40_000)
    got = mixing.mix(docs, mixture)
    shares = {r[0]: r[1] / 40_000 for r in got.groupBy("source").count().collect()}
    assert shares["big"] == pytest.approx(0.25, abs=0.02)
    assert shares["a"] == pytest.approx(0.5, abs=0.02)
    assert shares[None] == pytest.approx(0.25, abs=0.02)
    again = mixing.mix(docs.repartition(3), mixture)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    place = [r["doc_id"] for r in got.coalesce(1).limit(4000).collect()]
    assert abs(sum(place) / len(place) - 10_000) < 800


def test_mixture_over_odd_rows(spark):
    docs = odd_docs(spark)
    mixture = mixing.Mixture({"s0": 1.0, "absent": 5.0}, rest=1.0)
    got = mixing.mix(docs, mixture)
    assert got.columns == [c for c in docs.columns if c != "copy"] + ["copy", "shuffle_key"]
    per = Counter((r["doc_id"], r["text"], r["copy"]) for r in got.collect())
    assert all(per[7, t, c] == 2 for i, t, c in per if i == 7)
    assert mixing.mix(none(spark), mixture).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, mixing.Mixture({"s0": -1.0}, rest=1.0))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_round_trip(spark, tmp_path, compression):
    big, small = "é" * 600, "x" * 999
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nb", big), (2, None, big), (3, "u", small), (4, "u", small), (5, "", None),
         (6, "u", "WARC/1.1\r\n\r\n" * 300_00), (9, "u", big), (9, "u", big), (None, "u", big), (7, "u", "")],
        "page_id long, url string, html string",
    ).withColumn("payload", F.lit("clash"))
    path = str(tmp_path / compression)
    warc.write_warc(warc.with_revisits(pages), path, compression)
    got = [tuple(r) for r in warc.archived(warc.read_warc(spark, path)).collect()]
    want = []
    for i, _, html in pages.select("page_id", "url", "html").collect():
        data = (html or "").encode()
        revisit = html == big and i in (1, 2)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # Payloads come back byte for byte; pushed-down predicates select by header.
    records = warc.read_warc(spark, path)
    payloads = {bytes(r["payload"]) for r in records.where("record_type = 'response'").collect()}
    assert payloads == {(r["html"] or "").encode() for r in pages.collect()}
    few = warc.read_warc(spark, path, "record_id string, payload_digest string, record_type string")
    one = few.where("record_id in ('<urn:page:1>', '<urn:page:6>') and record_type = 'revisit'")
    assert [r["record_id"] for r in one.collect()] == ["<urn:page:1>"]
    empty = str(tmp_path / "empty")
    warc.write_warc(warc.with_revisits(pages.limit(0)), empty, compression)
    assert warc.read_warc(spark, empty).count() == 0


def test_unwanted_payloads_are_not_decoded(tmp_path):
    rows = [
        {"record_id": f"<urn:page:{i}>", "record_type": "response", "target_uri": "u", "payload_digest": None,
         "refers_to": None, "payload_length": None, "payload": b"p" * 5_000_000}
        for i in range(3)
    ]
    path = tmp_path / "x.warc"
    path.write_bytes(b"".join(map(warc.record_bytes, rows)))

    class Counting:
        def __init__(self):
            self.file, self.bytes = path.open("rb"), 0

        def read(self, n):
            data = self.file.read(n)
            self.bytes += len(data)
            return data

        def seek(self, at):
            return self.file.seek(at)

        def tell(self):
            return self.file.tell()

    source = Counting()
    found = list(warc.read_records(source, False, {"record_id": {"<urn:page:1>"}}, True))
    assert [len(r["payload"]) for r in found] == [5_000_000]
    assert source.bytes < 7_000_000
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(path.read_bytes()[:-100]), False, {}, True))


def brute_edited(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][1], len(text) // 2
        out[i] = text[: len(text) - half] + nxt[:half]
    return out


def brute_print(text, masks, settings):
    words = sorted({w for w in re.split(r"[\W_]+", text.lower()) if w in masks})
    if not words:
        return None
    parts = [[w for w in words if masks[w] >> k & 1] for k in range(settings.parts)]
    return "-".join(hashlib.md5(" ".join(p).encode()).hexdigest()[:8] if p else "" for p in parts)


def test_fingerprints_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    settings = fingerprints.Settings()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    masks = {r["term"]: r["mask"] for r in fingerprints.lexicon(docs, settings).collect()}
    counts = Counter(w for _, t in rows for w in set(re.split(r"[\W_]+", t.lower())) if w)
    low, high = max(2, math.ceil(settings.low * len(rows))), math.floor(settings.high * len(rows))
    assert masks and all(low <= counts[w] <= high for w in masks)
    changed, texts = brute_edited(rows), dict(rows)
    for r in fingerprints.compare_edited(docs, settings).collect():
        i = r["doc_id"]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(changed[i].encode()).hexdigest()
        own = brute_print(texts[i], masks, settings)
        assert r["fingerprint"] == own or own is None and r["fingerprint"].startswith("x")
        other = brute_print(changed[i], masks, settings)
        assert r["edited_fingerprint"] == other or other is None
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_fingerprints_over_odd_rows(spark):
    docs = odd_docs(spark)
    settings = fingerprints.Settings(low=0.1, high=0.9, one_in=2)
    got = fingerprints.compare_edited(docs, settings).collect()
    assert len(got) == docs.count()
    same = defaultdict(set)
    texts = defaultdict(list)
    for i, t in docs.select("doc_id", "text").collect():
        texts[i].append(t or "")
    for r in got:
        if r["doc_id"] is not None:
            same[texts[r["doc_id"]][0]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    assert Counter(r["doc_id"] for r in got)[7] == 2
    assert fingerprints.compare_edited(none(spark), settings).count() == 0


def test_ranges_do_not_change_what_comes_next(spark):
    docs = spark.range(300).selectExpr("id * 7 doc_id", "repeat('t' || id, 3) text")
    for size in (7, 1000):
        got = fingerprints.with_next(docs, "doc_id", "text", size).collect()
        assert len(got) == 300
        for r in got:
            at = r["doc_id"] // 7
            assert r["next_text"] == f"t{at - 1 if at else 299}" * 3


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) < set(out.columns)
    leaks = queries.op5_decontamination(spark, SF).select("doc_id")
    assert out.join(leaks, "doc_id").count() == 0
    ids = {r[0] for r in docs.select("doc_id").collect()}
    assert {r[0] for r in out.select("doc_id").collect()} <= ids


def test_pipeline_stages_over_odd_rows(spark):
    import corpus_pipeline

    for docs in (odd_docs(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    kept = corpus_pipeline.dedup_documents(spark, odd_docs(spark), SF)
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0]) == [1, 4, 5, 6, 7, 7, 8, 9, 10]


def test_near_duplicates_are_decided_per_row(spark):
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, long + " more"), (2, "quite another text of its own"), (None, long), (None, "no id a b c"), (None, "no id a b c")]
    rows += [(3, long), (3, long + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.dedup_documents(spark, docs, SF)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, long), (2, "quite another text of its own"), (None, "no id a b c")], key=repr
    )
