"""Jaccard join, components, line deduplication and decontamination against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from odd import none, odd_docs
from pyspark.sql import functions as F

from lakejobs.llm import decontamination, jaccard_join, line_dedup
from lakejobs.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(200, x) for x in range(201, 240)]
    want = Groups({x for e in edges for x in e})
    for a, b in edges:
        want.link(a, b)
    frame = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(frame).collect()}
    loops = {x for x in want.up if all(a == b for a, b in edges if x in (a, b))}
    assert got == {x: want.find(x) for x in want.up if x not in loops}


def test_components_say_when_they_have_not_converged(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="not converged"):
        components(chain, most_rounds=1)


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_jaccard(rows):
    sets = [shingle_set(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            groups.link(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            root = groups.find(k)
            least[root] = min(i, least.get(root, i))
    return sorted(
        ((i, len(sets[k]), least.get(groups.find(k))) for k, (i, _) in enumerate(rows)), key=repr
    )


def family(seed, copies, words, edits):
    """Copies of one text, each with a few words changed, and some unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(text))
    for _ in range(copies):
        own = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 80)))
        out.append(f"{own} {passage}" if rng.random() < 0.7 else own)
    return out


@pytest.mark.parametrize("common, cell", [(64, 500_000), (3, 1500)])
def test_jaccard_join_is_exact(spark, common, cell):
    rows = list(enumerate(family(3, 60, 70, 5) + family(4, 20, 9, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs, jaccard_join.Settings(common=common, cell=cell))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_jaccard(rows)


def test_jaccard_join_over_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_join.jaccard_components(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_jaccard(rows)
    assert jaccard_join.jaccard_components(none(spark)).count() == 0


def test_forest_spans_the_links():
    rng = np.random.default_rng(1)
    for k in (2, 3, 40):
        pool = rng.integers(0, 2**62, 60, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(30, 60))) for _ in range(k)]
        block = np.arange(k) % 2
        for mixed in (False, True):
            want, got = Groups(range(k)), Groups(range(k))
            for a, b in combinations(range(k), 2):
                common = len(np.intersect1d(sets[a], sets[b]))
                if jaccard_join.linked(common, len(sets[a]), len(sets[b])) and not (mixed and block[a] == block[b]):
                    want.link(a, b)
            pairs = jaccard_join.forest(sets, block, mixed)
            for a, b in pairs:
                got.link(a, b)
            assert [got.find(x) for x in range(k)] == [want.find(x) for x in range(k)]
            assert len(pairs) < k


def line_words(line):
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, sims, settings):
    """Expected texts: groups by equal words, or near SimHash and edit similarity."""
    found = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = tuple(line_words(line))
            if words:
                found.setdefault(words, []).append(((i is None, i or 0, k), (i, text, k)))
    groups = Groups(found)
    for a, b in combinations(found, 2):
        if bin((sims[a] ^ sims[b]) & (2**64 - 1)).count("1") <= settings.distance:
            x, y = " ".join(a), " ".join(b)
            if edit_distance(x, y) <= int((1 - settings.similarity) * max(len(x), len(y)) + 1e-9):
                groups.link(a, b)
    stays = {}
    for words, at in found.items():
        root = groups.find(words)
        stays[root] = min([*at, stays.get(root, at[0])], key=lambda x: x[0])
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None))
            continue
        lines = text.split("\n")
        keep = [
            line
            for k, line in enumerate(lines)
            if not line_words(line) or stays[groups.find(tuple(line_words(line)))][1] == (i, text, k)
        ]
        out.append((i, "\n".join(keep)))
    return sorted(out, key=repr)


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(80)]
    stock = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice((1, 5, 30, 150)))) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(stock).split()
            if rng.random() < 0.5 and len(words) > 20:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words).capitalize() + rng.choice((".", "!", "")))
        rows.append((i, "\n".join(lines) + rng.choice(("", "\n", "\n---"))))
    docs = odd_docs(spark, [(i + 100, t, "en") for i, t in rows])
    settings = line_dedup.Settings()
    hashed = line_dedup.simhashes(line_dedup.lines(docs, "doc_id", "text"))
    by_hash = {r["h"]: r["sim"] for r in hashed.collect()}
    named = {tuple(r["words"]): r["h"] for r in line_dedup.lines(docs, "doc_id", "text").collect()}
    sims = {w: by_hash[h] for w, h in named.items()}
    got = line_dedup.dedup_lines(docs, settings)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "emptied"]
    source = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    have = sorted((tuple(r) for r in got.select("doc_id", "text").collect()), key=repr)
    assert have == brute_lines(source, sims, settings)
    assert got.where("emptied").count() > 0
    assert line_dedup.dedup_lines(none(spark)).count() == 0


def changed(rng, words, share, vocabulary):
    out = list(words)
    for k in rng.sample(range(len(out)), int(share * len(out))):
        out[k] = rng.choice(vocabulary)
    return out


def test_lines_meet_by_edit_similarity_alone(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    pairs = []
    for n in (3, 5, 8, 12, 30, 60):
        for share in (0.1, 0.2, 0.2, 0.5):
            for _ in range(8):
                base = [rng.choice(vocabulary) for _ in range(n)]
                other = changed(rng, base, share, vocabulary)
                if other == base:
                    word = other[n // 2]
                    other[n // 2] = "q" + word[1:]
                pairs.append((" ".join(base), " ".join(other)))
    # A line of more than one piece, in whose short last one all is different.
    long = [rng.choice(vocabulary) for _ in range(line_dedup.PIECE + 20)]
    pairs.append((" ".join(long), " ".join(long[: line_dedup.PIECE] + ["other"] * 20)))
    pairs += [("word12", "word13"), ("abcdefgh", "abcdfgh")]
    rows = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    gone = {r["doc_id"] for r in got.where("emptied").collect()}
    near = {
        2 * i + 1
        for i, (x, y) in enumerate(pairs)
        if x == y
        or len(x) > 10_000
        or edit_distance(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)
    }
    assert len(near) > 120
    assert gone <= near
    assert len(gone) >= 0.97 * len(near)
    assert {2 * i + 1 for i, p in enumerate(pairs[-3:], len(pairs) - 3)} <= gone


def test_simhash_is_the_majority_of_word_hashes(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g\nlong " + "x y z " * 7000)], "doc_id long, text string")
    found = line_dedup.lines(docs, "doc_id", "text")
    words = found.selectExpr("line_no", "transform(words, w -> xxhash64(w)) w").collect()
    got = {}
    for r in line_dedup.simhashes(found).collect():
        got[r["line_no"]] = min(r["sim"], got.get(r["line_no"], r["sim"]))
    for r in words:
        pieces = [r["w"][k : k + line_dedup.PIECE] for k in range(0, len(r["w"]), line_dedup.PIECE)]
        sims = []
        for piece in pieces:
            bits = sum(1 << b for b in range(64) if 2 * sum(w >> b & 1 for w in piece) > len(piece))
            sims.append(bits - 2**64 if bits >> 63 else bits)
        assert got[r["line_no"]] == min(sims)


def brute_tiles(doc, item, least):
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = 0
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and free_d[d + k] and free_i[i + k]:
                    k += 1
                best = max(best, k)
        if best < least:
            return out
        d = 0
        while d + best <= len(doc):
            for i in range(len(item) - best + 1):
                if all(doc[d + k] == item[i + k] and free_d[d + k] and free_i[i + k] for k in range(best)):
                    out.append((d, i, best))
                    for k in range(best):
                        free_d[d + k] = free_i[i + k] = False
                    break
            d += 1


@pytest.mark.parametrize("seed", range(40))
def test_tiles(seed):
    rng = random.Random(seed)
    item = [rng.randrange(1, 5) for _ in range(rng.randint(3, 25))]
    doc = [rng.randrange(1, 5) for _ in range(rng.randint(3, 40))]
    doc += item[len(item) // 2 :] + doc[:3] + item[: len(item) // 2]
    assert decontamination.tile(np.array(doc), np.array(item), 3) == brute_tiles(doc, item, 3)


def test_decontamination_finds_reordered_passages(spark):
    rng = random.Random(9)
    word = lambda: f"k{rng.randrange(500)}"
    items = {i: [word() for _ in range(rng.randint(15, 50))] for i in range(30)}
    rows, want = [], {}
    for i in range(90):
        own = [word() for _ in range(rng.randint(0, 200))]
        item = items[i % 30]
        half = len(item) // 2
        text = own + (item[half:] + ["between"] + item[:half] if i % 3 == 0 else item[:half] if i % 3 == 1 else [])
        rows.append((i + 100, " ".join(text).capitalize() + ".", "en"))
        if i % 3 == 0:
            want[i + 100] = i % 30
    docs = odd_docs(spark, rows)
    bench = spark.createDataFrame(
        [(i, " ".join(t)) for i, t in items.items()] + [(77, None), (78, "too short"), (None, "")],
        "item_id long, text string",
    )
    for block_tokens in (1_000_000, 100):
        settings = decontamination.Settings(block_tokens=block_tokens)
        found = decontamination.contaminated(docs, bench, settings).collect()
        assert {r["doc_id"]: r["item_id"] for r in found} == want
        for r in found:
            tokens = decontamination.tokens(dict((i, t) for i, t, _ in rows)[r["doc_id"]])
            tiles = brute_tiles(tokens, items[r["item_id"]], 5)
            assert r["coverage"] == pytest.approx(sum(t[2] for t in tiles) / len(items[r["item_id"]]))
        clean = decontamination.clean(docs, bench, settings)
        assert clean.columns == docs.columns
        assert clean.count() == docs.count() - len(want)
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == docs.count()
    assert decontamination.contaminated(none(spark), bench).count() == 0


def test_crowded_shingles_are_dealt_over_tasks(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none_common = np.zeros(0, np.uint64)
    settings = jaccard_join.Settings(crowd=20)
    found = jaccard_join.regions(docs, "text", none_common, settings)
    found = found.select("s", "set_id", F.spark_partition_id().alias("task"))
    at = found.groupBy("s").agg(F.countDistinct("task").alias("tasks"), F.countDistinct("set_id").alias("sets"))
    top = at.orderBy(F.col("sets").desc()).first()
    assert top["sets"] >= 50 and top["tasks"] > 1
    got = jaccard_join.jaccard_components(docs, settings)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_jaccard(rows)


def test_copies_are_fetched_once(spark):
    docs = spark.createDataFrame([(i, "one two three four five six") for i in range(40)], "doc_id long, text string")
    wanted = docs.select(F.xxhash64("text").alias("text_hash")).distinct()
    assert jaccard_join.fetched(docs, wanted, "text", jaccard_join.Settings()).count() == 1
