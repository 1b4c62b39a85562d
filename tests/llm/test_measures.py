"""Filter audit, periodic runs and the quality model."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from odd import none, odd_docs
from pyspark.sql import functions as F

from lakejobs.llm import filter_audit, periodic_runs, quality_model
from lakejobs.llm.common import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    return (
        len(words),
        len(set(words)),
        len(re.findall("[A-Z]", text)),
        len(text),
        len(re.findall(r"[#$%&*|]", text)),
    )


@pytest.mark.parametrize("seed", range(20))
def test_transducer_counts_what_patterns_count(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(filter_audit, "BUFFER", rng.choice([1, 50, 1 << 20]))
    signs = ["a", "B", "é", "Ü", "中", "😀", "#", "|", " ", "\n", "\x0b", "\x1f", "\x85", " ", "\0"]
    word = lambda: "".join(rng.choice(signs) for _ in range(rng.choice([1, 3, 9, 80])))
    some = [word() for _ in range(20)]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts += ["", "x" * 5000, ("ab" * 40 + " ") * 50 + "ab" * 39 + "ac", " "]
    got = filter_audit.counts(texts)
    for i, text in enumerate(texts):
        assert tuple(got[m][i] for m in filter_audit.MEASURES) == plain_counts(text), text
    assert all(len(v) == 0 for v in filter_audit.counts([]).values())


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit.Spans, "_hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    texts = ["a b a c", "a a", "", "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y"]
    assert filter_audit.counts(texts)["n_distinct"].tolist() == [3, 1, 0, 2]


def plain_audit(docs, labels):
    texts, label = {}, {}
    for i, text, _ in docs:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    for i, good, toxic in labels:
        was = label.get(i, (0, 0))
        label[i] = (max(was[0], int(good == 1)), max(was[1], int(toxic == 1)))
    rows = {}
    for i, text, part in docs:
        text, part = text or "", part or ""
        words, distinct, capitals, points, symbols = plain_counts(text)
        fails = {
            "A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * points,
            "D": symbols > 0, "E": i is not None and texts[text] < i,
        }
        good, toxic = label.get(i, (0, 0)) if i is not None else (0, 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                out = rows.setdefault((part, order, step), [0] * 6)
                now = fails[letter] and not gone
                out[1] += now
                out[2] += fails[letter] and gone
                out[3] += [f for f in fails if fails[f]] == [letter]
                out[4] += now * good
                out[5] += now * toxic
                gone = gone or now
                out[0] += not gone
    shapley = {}
    for (part, order, step), out in rows.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + out[1]
    return sorted((p, o, s, *out, shapley[p, o[s - 1]]) for (p, o, s), out in rows.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_over_odd_rows(spark):
    docs = odd_docs(spark, more=[(11, "THE | AND", "en"), (12, "THE | AND", "en"), (None, "THE | AND", "en")])
    given = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (12, 1, None), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, filter_audit.audit(docs, labels).select(*COLUMNS).collect()))
    want = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], given)
    assert got == want
    assert filter_audit.audit(none(spark), labels).count() == 0
    assert len(filter_audit.audit(docs, labels.limit(0)).collect()) == len(want)


def test_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b c", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = {"x": lambda: F.col("n_words") > 2, "y": lambda: F.col("n_words") > 1}
    got = filter_audit.audit(docs, labels, filters).select("filter_order", "step", "kept", "removed", "redundant", "shapley")
    assert sorted(map(tuple, got.collect())) == [
        ("xy", 1, 1, 1, 0, 1), ("xy", 2, 0, 1, 1, 3), ("yx", 1, 0, 2, 0, 3), ("yx", 2, 0, 0, 1, 1),
    ]
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, {})


def plain_runs(words, least, powers):
    n, out = len(words), []
    for q in range(1, n // powers + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            run = words[i : i + size]
            if j > i and size >= max(least, powers * q):
                if not any(run[:-d] == run[d:] for d in range(1, q)):
                    out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_a_search_by_period(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 3, 6])
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 12)
            words = [w if i < a else words[a + (i - a) % p if a + (i - a) % p < n else a] for i, w in enumerate(words)]
        for settings in (periodic_runs.Settings(), periodic_runs.Settings(2, 2), periodic_runs.Settings(5, 3)):
            want = plain_runs(words, settings.least_words, settings.least_powers)
            assert periodic_runs.runs_of(words, settings) == want
            assert periodic_runs.find(words, settings) == want


def test_long_repeats_are_searched_in_little_time():
    words = [i % 7 for i in range(60_000)] + [i % 5000 for i in range(60_000)]
    assert [r[2] for r in periodic_runs.find(words)] == [7, 5000]
    with pytest.raises(ValueError):
        periodic_runs.Settings(6, 1)


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest_of(doc_id, text):
    words = planted(WORD.findall(text or ""), doc_id)
    runs = plain_runs(words, 6, 4)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, size, p in runs for i in range(s + p, s + size)}
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join("%d,%d,%d\n" % r for r in runs)), sha(left),
    )


DIGEST = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def runs_query(docs):
    found = periodic_runs.periodic_runs(periodic_runs.with_period(docs))
    return sorted(map(tuple, periodic_runs.digests(found).select(*DIGEST).collect()), key=repr)


def test_run_digests_over_odd_rows(spark):
    repeats = [(i, " ".join(["x", "y", "z"][: i % 3 + 1] * 9) + " end", "en") for i in range(20, 60)]
    repeats += [(77, "a b " * 6, "en"), (78, "é\x85 " * 7, "en")]
    docs = odd_docs(spark, more=repeats).where("n_chars < 20000")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    assert runs_query(docs) == sorted((digest_of(*r) for r in rows), key=repr)
    assert runs_query(none(spark)) == []
    assert len(runs_query(odd_docs(spark))) == odd_docs(spark).count()


def test_run_digests_of_the_documents(spark):
    docs = table(spark, SF, "documents").where("n_chars < 4000 and doc_id < 300")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = runs_query(docs)
    assert got == sorted((digest_of(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 15


def quality_of(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_model.train(docs, labels)
    rows = quality_model.score(docs, model).join(labels, "doc_id").select("doc_id", "quality", "predicted", "score").collect()
    return [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]


def test_quality_of_documents_that_are_held_out(spark):
    rows = quality_of(spark, "/root/testdata/sf0.1")
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert np.mean([r["predicted"] for r in good]) > 0.97
    assert np.mean([1 - r["predicted"] for r in bad]) > 0.85
    p = np.array([r["score"] for r in rows])
    assert abs(p.mean() - np.mean([r["quality"] for r in rows])) < 0.05


def test_word_vectors_are_neighbour_sums(spark):
    settings = quality_model.Settings(rows=64, size=8, signs=2)
    texts = ["a b a c", "b b", None, "", "UP 12 && a_b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    places, signs = quality_model.index_vectors(settings)
    index = np.zeros((64, 8))
    for row in range(64):
        index[row, places[row]] = signs[row]
    row = lambda t: zlib.crc32(t.encode()) % 64
    want = np.zeros((64, 8))
    for tokens in (["a", "b", "a", "c"], ["b", "b"], ["^", "0", "&&", "a", "_", "b"]):
        for i, t in enumerate(tokens):
            for j in range(max(0, i - 2), min(len(tokens), i + 3)):
                if i != j:
                    want[row(t)] += index[row(tokens[j])]
    want = np.sign(want) * np.sqrt(np.abs(want))
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality_model.word_vectors(docs, settings), want, atol=1e-6)


def test_pooling_is_that_of_each_text_alone():
    settings = quality_model.Settings()
    vectors = np.random.default_rng(1).normal(size=(settings.rows, settings.size)).astype(np.float32)
    texts = ["one two two", "", None, "?", "three " * 50, "x"]
    got = quality_model.pooled(texts, vectors, settings)
    for i, text in enumerate(texts):
        assert np.allclose(got[i], quality_model.pooled([text], vectors, settings)[0], atol=1e-5)
    assert not got[1].any() and not got[2].any()
    assert np.isclose(got[0][2 * settings.size + 2], 0.5)


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    net = quality_model.fit(x, y, np.ones(2000), quality_model.Settings(epochs=60))
    assert np.mean((net.probabilities(x) > 0.5) == y) > 0.95
    assert 2 < quality_model.temperature(np.array([9.0, -9.0, 9.0, -9.0]), np.array([1, 0, 0, 0]), np.ones(4))


def test_quality_over_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (7, None)], "doc_id long, quality int")
    for some in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = quality_model.train(docs, some)
        rows = quality_model.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert quality_model.train(docs, labels.limit(0)).share == 0.5
    assert quality_model.score(none(spark), quality_model.train(none(spark), labels)).count() == 0
