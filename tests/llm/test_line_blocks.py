import random
import struct
from itertools import combinations

import pytest
import xxhash
from odd import none, odd_docs
from pyspark.sql import functions as F
from test_pairs import Groups, edit_distance, line_words

from lakejobs.llm import line_blocks as lb

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def signed(x):
    return x - 2**64 if x >> 63 else x


def simhash(words):
    """Four lanes of one line, by counting every bit."""
    norm = " ".join(words)
    tokens = words if len(words) > lb.FEW_WORDS else [f" {norm} "[k : k + 3] for k in range(len(norm))]
    counts, total = [[0] * 64 for _ in range(lb.LANES)], 0
    for token in tokens:
        weight = 1 if len(token) < lb.LONGER else 2 if len(token) < lb.LONGEST else 3
        total += weight
        first = xxhash.xxh64(token.encode(), seed=42).intdigest()
        base = xxhash.xxh64(struct.pack("<Q", first), seed=42).intdigest()
        for lane in range(lb.LANES):
            h = first if lane == 0 else xxhash.xxh64(struct.pack("<i", lane), seed=base).intdigest()
            for b in range(64):
                counts[lane][b] += weight * (h >> b & 1)
    return tuple(sum(1 << b for b in range(64) if lane[b] > total // 2) for lane in counts)


def keys(sim, turns=lb.Settings.turns):
    mask = (1 << lb.WINDOW) - 1
    return {
        (t, i, tuple(sim[x] >> lb.WINDOW * ((i + t * x) % lb.WINDOWS) & mask for x in range(lb.LANES)))
        for t in range(turns)
        for i in range(lb.WINDOWS)
    }


def brute(rows, settings=lb.Settings()):
    found = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if line_words(line):
                found.setdefault(tuple(line_words(line)), []).append(((i is None, i or 0, k), (i, text, k)))
    sims = {w: simhash(list(w)) for w in found}
    blocks = {w: keys(s) for w, s in sims.items()}
    groups, links = Groups(found), 0
    for a, b in combinations(found, 2):
        far = sum((x ^ y).bit_count() for x, y in zip(sims[a], sims[b]))
        if blocks[a] & blocks[b] and far <= settings.distance:
            x, y = " ".join(a), " ".join(b)
            if edit_distance(x, y) <= int((1 - settings.similarity) * max(len(x), len(y)) + 1e-9):
                groups.link(a, b)
                links += 1
    stays = {}
    for words, at in found.items():
        root = groups.find(words)
        stays[root] = min([*at, stays.get(root, at[0])], key=lambda x: x[0])
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0))
            continue
        lines = text.split("\n")
        keep = [
            x
            for k, x in enumerate(lines)
            if not line_words(x) or stays[groups.find(tuple(line_words(x)))][1] == (i, text, k)
        ]
        out.append((i, "\n".join(keep), len(lines) - len(keep)))
    return sorted(out, key=repr), links


def vocabulary(rng, n):
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n)]


def edited(rng, words, share, of, stock):
    """A copy of a line with a share of its words, or of its letters, changed."""
    if of == "words":
        out = list(words)
        for k in rng.sample(range(len(out)), max(1, round(share * len(out)))):
            out[k] = rng.choice(stock)
        return out
    line = list(" ".join(words))
    places = [k for k, c in enumerate(line) if c != " "]
    for k in rng.sample(places, max(1, round(share * len(places)))):
        line[k] = rng.choice(LETTERS)
    return "".join(line).split(" ")


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    stock = vocabulary(rng, 80)
    base = [[rng.choice(stock) for _ in range(rng.choice((1, 2, 5, 10, 11, 30, 60, 90)))] for _ in range(24)]
    rows = []
    for i in range(45):
        lines = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(base)
            if rng.random() < 0.6:
                words = edited(rng, words, rng.choice((0.01, 0.02, 0.1)), rng.choice(("words", "letters")), stock)
            lines.append(" ".join(words).capitalize() + rng.choice((".", "!", "")))
        rows.append((i + 100, "\n".join(lines) + rng.choice(("", "\n", "\n---"))))
    docs = odd_docs(spark, [(i, t, "en") for i, t in rows]).where("doc_id is null or doc_id != 9")
    got = lb.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "emptied"]
    want, links = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert links > 20
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_removed").collect()), key=repr) == want
    assert got.where("emptied").count() > 0


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark).withColumn("n_lines", F.lit("clash")).withColumn("size", F.lit(1)).withColumn("key", F.lit(2))
    got = {(r["doc_id"], r["text"]): r for r in lb.dedup_lines(docs).collect()}
    assert sum(r["n_removed"] for r in got.values()) > 0
    assert got[4, None]["n_lines"] == 0 and not got[5, ""]["emptied"] and not got[8, "?!"]["emptied"]
    assert got[7, "One line.\nOther line here"]["n_removed"] == 1
    assert got[2, ""]["emptied"] and got[None, ""]["emptied"]
    assert lb.dedup_lines(none(spark)).count() == 0
    assert lb.line_groups(none(spark)).count() == 0


def test_simhash_counts_every_token(spark):
    lines = ["a bc", "one two three four five six seven eight nine ten eleven", "x y zz " * (lb.PIECE // 3 - 3)]
    texts = spark.createDataFrame([(i, i, t.strip()) for i, t in enumerate(lines)], "h long, g long, norm string")
    for r in lb.simhashes(texts).collect():
        assert [r[f"a{i}"] for i in range(lb.LANES)] == [signed(x) for x in simhash(lines[r["h"]].split())]


def test_simhash_of_several_pieces(spark):
    rng = random.Random(3)
    stock = vocabulary(rng, 50)
    words = [rng.choice(stock) for _ in range(3 * lb.PIECE + 17)]
    changed = words[: 3 * lb.PIECE] + ["other"] * 17
    texts = spark.createDataFrame([(0, 0, " ".join(words)), (1, 1, " ".join(changed))], "h long, g long, norm string")
    got = [[r[f"a{i}"] for i in range(lb.LANES)] for r in lb.simhashes(texts).orderBy("h").collect()]
    far = lambda x, y: sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(x, y))
    assert far(got[0], simhash(words)) <= 4
    assert far(got[1], simhash(changed)) <= 4


def test_blocks_of_two_turns_share_at_most_a_window():
    taken = [
        {(x, (i + t * x) % lb.WINDOWS) for x in range(lb.LANES)}
        for t in range(lb.Settings.turns)
        for i in range(lb.WINDOWS)
    ]
    assert all(len(a & b) <= 1 for a, b in combinations(taken, 2))


def test_groups_name_the_line_that_stays(spark):
    rows = [(5, "Alpha beta gamma.\nsomething else"), (3, "x\nalpha, BETA gamma"), (None, "alpha beta gamma")]
    got = lb.line_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["id"], r["line_no"], r["stay_id"], r["stay_no"]) for r in got.collect()} == {
        (5, 0, 3, 1), (3, 1, 3, 1), (None, 0, 3, 1)
    }


def test_unlike_lines_stay(spark):
    rng = random.Random(4)
    stock = vocabulary(rng, 2000)
    rows = [(i, " ".join(rng.choice(stock) for _ in range(rng.choice((3, 8, 20, 80))))) for i in range(400)]
    assert lb.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").count() == 0


@pytest.mark.parametrize("share, of, n, least", [
    (0.03, "words", 30, 0.85), (0.03, "words", 100, 0.9), (0.03, "words", 300, 0.9), (0.002, "letters", 100, 0.9),
])
def test_share_of_similar_lines_that_share_a_block(share, of, n, least):
    rng = random.Random(6)
    stock = vocabulary(rng, 3000)
    hits = 0
    for _ in range(60):
        words = [rng.choice(stock) for _ in range(n)]
        hits += bool(keys(simhash(words)) & keys(simhash(edited(rng, words, share, of, stock))))
    assert hits >= least * 60


def test_copies_meet_the_central_line_of_their_block(spark):
    # Line 0 is the hub, but unlike the others; 1 to 6 are copies of line 9, each with its
    # own bits changed. Each copy is compared with 9 alone, not with all the others.
    sims = {0: -1, 9: 0, **{i: 0b111 << (3 * i) for i in range(1, 7)}}
    distinct = spark.createDataFrame(
        [(n, 100, s, -1 if n == 0 else 0, 0, 0) for n, s in sims.items()],
        "n long, size int, a0 long, a1 long, a2 long, a3 long",
    )
    met = spark.createDataFrame([(7, n, 0) for n in sims], "key long, n long, hub long")
    pairs = {tuple(r) for r in lb.central_pairs(met, distinct, lb.Settings()).collect()}
    assert pairs == {(n, 9) for n in range(1, 7)}


def test_a_block_pairs_only_lines_that_may_be_linked(spark):
    # Block 1: lines 0, 1 and 2 are alike, 3 is there by chance, 4 is alike but far longer.
    # Block 2 is crowded: its lines meet the hub alone.
    sims = {0: 0, 1: 0b1, 2: 0b11, 3: -1, 4: 0}
    met = [(1, n, 200 if n == 4 else 100, s, s, s, s, 0, 5) for n, s in sims.items()]
    met += [(2, n, 100, 0, 0, 0, 0, 10, lb.CROWD + 1) for n in range(10, 11 + lb.CROWD)]
    names = "key long, n long, size int, a0 long, a1 long, a2 long, a3 long, hub long, m long"
    pairs = {tuple(r) for r in lb.block_pairs(spark.createDataFrame(met, names), lb.Settings()).collect()}
    assert pairs == {(1, 0), (2, 0), (2, 1)} | {(n, 10) for n in range(11, 11 + lb.CROWD)}


def test_pairs_are_the_same_however_many_blocks_are_met_at_once(spark, monkeypatch):
    rng = random.Random(8)
    sims = {}
    for n in range(60):
        flips = [sum(1 << b for b in rng.sample(range(64), rng.choice((0, 1, 3)))) for _ in range(lb.LANES)]
        base = [rng.getrandbits(64) for _ in range(lb.LANES)] if n % 6 == 0 else sims[n - 1]
        sims[n] = tuple(x ^ y for x, y in zip(base, flips))
    distinct = spark.createDataFrame(
        [(n, 100, *map(signed, sim)) for n, sim in sims.items()], "n long, size int, a0 long, a1 long, a2 long, a3 long"
    )
    far = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(sims[a], sims[b]))
    want = {(b, a) for a, b in combinations(sims, 2) if keys(sims[a]) & keys(sims[b]) and far(a, b) <= 64}
    assert len(want) > 60
    for at_once in (27, 14):
        monkeypatch.setattr(lb, "AT_ONCE", at_once)
        pairs, crowds = lb.meet(distinct, lb.Settings())
        assert {tuple(r) for table in pairs for r in table.collect()} == want
        assert all(table.isEmpty() for table in crowds)
