"""Token counts, toxicity and language identification."""

import base64
import random

import numpy as np
import pytest
from odd import none, odd_docs
from pyspark.sql import functions as F

from lakejobs.llm import language_id, token_counts, toxicity
from lakejobs.llm.common import held_out

SF = "/root/testdata/sf0.01"


def greedy(word, initial, inner):
    """Longest match first, piece by piece; None without a spelling."""
    at, n = 0, 0
    while at < len(word):
        pieces = initial if at == 0 else inner
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return None
        at, n = end, n + 1
    return n


@pytest.mark.parametrize("seed", range(20))
def test_automaton_counts_what_greedy_matching_builds(seed):
    rng = random.Random(seed)
    piece = lambda: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5)))
    initial = {b" " + piece() for _ in range(12)} | ({b" "} if seed % 2 else set())
    inner = {piece() for _ in range(12)} | ({b"a", b"b"} if seed % 3 else set())
    automaton = token_counts.Automaton(initial, inner)
    for _ in range(200):
        word = b" " + bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        want = greedy(word, initial, inner)
        assert automaton.count(word) == (token_counts.UNKNOWN if want is None else want), word


def test_token_counts_over_odd_rows(spark, tmp_path):
    pieces = [bytes([b]) for b in range(256)] + [b" w", b" w1", b"23", b" One", b"line"]
    path = tmp_path / "v.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces)))
    docs = odd_docs(spark)
    got = token_counts.token_counts(docs, str(path)).collect()
    assert len(got) == docs.count()
    initial, inner = {p for p in pieces if p[:1] == b" "}, {p for p in pieces if p[:1] != b" "}
    want = []
    for i, text in docs.select("doc_id", "text").collect():
        words = (text or "").split()
        n = sum(greedy(b" " + w.encode(), initial, inner) for w in words)
        want.append((i, len(words), n))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(none(spark), str(path)).count() == 0


def test_fold_undoes_disguises():
    assert toxicity.fold("1D10T, ѕtupid!") == " idiot stupid "
    assert toxicity.fold("call 555 10 times") == " call times "
    assert toxicity.fold("ｂａｄ s​cum") == " bad scum "
    assert toxicity.fold("") == "  "


def test_exceptions_cancel_matches_inside_them():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " clo": 2.0}, ("trash can",))
    automaton = lexicon.automaton()
    assert toxicity.measure("the trash can", automaton)[:2] == (0.0, 0)
    assert toxicity.measure("trash, trash can", automaton)[:2] == (3.0, 1)
    assert toxicity.measure("a clown", automaton)[:2] == (2.0, 1)
    assert toxicity.measure(None, automaton) == (0.0, 0, 0)
    assert toxicity.measure("trash", toxicity.Lexicon().automaton()) == (0.0, 0, 1)


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = toxicity.score(docs, toxicity.train(docs, labels))
    rows = found.join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    right = np.mean([r["predicted"] == r["toxic"] for r in rows])
    assert right >= 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_over_odd_rows(spark):
    docs = odd_docs(spark, [(20 + i, f"nasty word {i}", "en") for i in range(40)])
    labels = spark.createDataFrame(
        [(20 + i, 1) for i in range(40)] + [(1, 0), (2, 0), (None, 1), (3, None)],
        "doc_id long, toxic int",
    )
    lexicon = toxicity.train(docs, labels, toxicity.Settings(least_evidence=1.0))
    got = toxicity.score(docs, lexicon).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["predicted"] == by_id[5]["predicted"] == 0
    assert by_id[4]["score"] == by_id[5]["score"] <= min(r["score"] for r in got) + 1e-12
    assert by_id[20]["score"] > by_id[1]["score"]
    untaught = toxicity.train(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, untaught).collect()} == {0}
    assert toxicity.score(none(spark), lexicon).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    assert (model.weights == 0).mean() > 0.5
    found = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    assert language_id.keep_identified(docs, model).count() >= 0.98 * docs.count()


def test_slices_have_the_same_ngrams(monkeypatch):
    text = "Ein  kleiner Text, mit -- Zeichen und\nZeilen. " * 20
    whole = np.concatenate(list(language_id._grams(text)))
    monkeypatch.setattr(language_id, "SLICE", 17)
    parts = np.concatenate(list(language_id._grams(text)))
    assert sorted(whole.tolist()) == sorted(parts.tolist())


def test_language_over_odd_rows(spark):
    docs = odd_docs(spark)
    model = language_id.train(docs)
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    for i in (4, 5, 6, 8):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[1]["lang_pred"] in model.languages
    assert language_id.identify(docs, model).count() == docs.count()
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert not {4, 5, 6, 8} & {r["doc_id"] for r in kept.collect()}
    empty = language_id.train(none(spark))
    assert empty.languages == []
    assert {r["lang_pred"] for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert language_id.keep_identified(docs, empty).count() == 0
