"""Fuzzy line deduplication. DataFrame functions only.

Lines with equal words are grouped. Distinct lines meet by keys of three MinHashes each, in
several tables: of their words, longer words weighing more as in an edit distance; short
lines of character grams, and the shortest of themselves with one character left out. Of
the lines of a key one is its hub: the others are compared with it, and among themselves
only if they are not connected yet and their lengths allow it. Meetings are verified by
edit similarity, and of each connected group of lines one occurrence stays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import forget, kept
from lakejobs.llm.components import components

BITS = 64
SEPARATOR = r"[^\p{L}\p{N}]+"
# Words of a line whose bits are counted together; see ``simhashes``.
PIECE = (1 << 14) - 1
FILTER_BITS = 1 << 23
# Lines of so many words or more meet by words, those of so many or fewer by grams as well.
LEAST_WORDS, MOST_WORDS = 6, 10
# Gram sizes, with the least and most characters of the lines they are taken of.
GRAMS = ((3, 8, 24), (4, 20, 1 << 30))
# Lines in which one edit is all that the default similarity allows.
ONE_EDIT = (5, 9)


@dataclass(frozen=True)
class Settings:
    """``similarity``: one minus edit distance over the longer length. ``distance``: bits in
    which SimHashes of the words may differ; see EDITS. ``word_tables`` and
    ``gram_tables``: keys of a line; more of them find more of the similar pairs.
    """

    distance: int = 3
    similarity: float = 0.8
    word_tables: int = 20
    gram_tables: int = 32


# By edit similarity alone, whatever the SimHashes.
EDITS = Settings(distance=BITS)


def words(line: Column) -> Column:
    """Lower-cased words of a line, without punctuation."""
    return F.array_remove(F.split(F.lower(line), SEPARATOR), "")


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``id``, ``line_no``, ``h`` and ``words`` of every line with a word.

    ``row`` names id and text, ``h`` the words of the line.
    """
    split = F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")
    return (
        docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("id"), split)
        .select("row", "id", "line_no", words(F.col("line")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("h", F.xxhash64("words"))
    )


def simhashes(found: DataFrame) -> DataFrame:
    """``row``, ``id``, ``line_no``, ``h`` and ``sim`` of every line (or piece of one).

    Bit b of the SimHash tells whether more than half of the words have bit b in their
    hash; four bits are counted in each of 16 sums, 16 binary places apart. A line of more
    than PIECE words, which could overflow these, gives a row per piece; the least SimHash
    of its pieces is then the line's.
    """
    lanes = 0x0001000100010001
    keys = ["row", "id", "line_no", "h"]
    hashed = found.select(*keys, F.posexplode("words").alias("at", "word")).select(
        *keys, F.expr(f"at div {PIECE}").alias("piece"), F.xxhash64("word").alias("w")
    )
    sums = [
        F.sum(F.shiftrightunsigned("w", k).bitwiseAND(F.lit(lanes))).alias(f"s{k}") for k in range(16)
    ]
    counted = hashed.groupBy(*keys, "piece").agg(F.count(F.lit(1)).alias("n"), *sums)
    # Adding this to a count sets bit 14 of its lane if it is more than half the words.
    lift = (F.lit(0x3FFF).cast("long") - F.expr("n div 2")) * F.lit(lanes)
    sim = F.lit(0).cast("long")
    for k in range(16):
        top = F.shiftrightunsigned(F.col(f"s{k}") + lift, 14).bitwiseAND(F.lit(lanes))
        sim = sim.bitwiseOR(F.shiftleft(top, k))
    return counted.select(*keys, sim.alias("sim"))


def table_keys(tokens: DataFrame, tables: int, tag: int) -> DataFrame:
    """``h`` and ``key``: in each table, the hash of three of a line's MinHashes.

    ``tokens``: h, token, weight. No two tables have more than one MinHash in common. A
    token is the least with a chance of about its share of the weight.
    """
    drawn = []
    for i in range(0, tables, 2):
        both = F.xxhash64("token", F.lit(i))
        drawn += [F.shiftrightunsigned(both, 33), both.bitwiseAND(F.lit((1 << 31) - 1))]
    least = [F.min((d.cast("int") / F.col("weight")).cast("int")).alias(f"m{i}") for i, d in enumerate(drawn[:tables])]
    found = tokens.groupBy("h").agg(*least)
    keys = [
        F.xxhash64(F.lit(tag), F.lit(i), *[f"m{(i + step) % tables}" for step in (0, 1, 5)])
        for i in range(tables)
    ]
    return found.select("h", F.explode(F.array(*keys)).alias("key"))


def line_keys(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """``h``, ``key`` and ``size`` (characters) of every distinct line, a row per table.

    Lines are not shuffled but their MinHashes, which copies have in common.
    """
    found = lines(docs, id_col, text_col).select("h", "words", F.array_join("words", " ").alias("norm"))
    found = found.withColumn("size", F.length("norm"))
    word = F.explode("words").alias("token")
    weight = F.pow(F.least(F.length("token"), F.lit(10)), 2).cast("int").alias("weight")
    wordy = found.where(F.size("words") >= LEAST_WORDS).select("h", word).select("h", "token", weight)
    keys = table_keys(wordy, settings.word_tables, 0)
    short = found.where(F.size("words") <= MOST_WORDS)
    for k, low, high in GRAMS:
        padded = F.concat(F.lit(" "), "norm", F.lit(" "))
        at = F.sequence(F.lit(1), F.col("size") + 3 - k)
        grams = F.transform(at, lambda i: F.substring(padded, i, F.lit(k)))  # noqa: B023
        tokens = short.where(F.col("size").between(low, high)).select(
            "h", F.explode(grams).alias("token"), F.lit(1).alias("weight")
        )
        keys = keys.union(table_keys(tokens, settings.gram_tables, k))
    without = F.transform(
        F.sequence(F.lit(0), F.col("size")),
        lambda i: F.xxhash64(
            F.concat(F.substring("norm", F.lit(1), i - 1), F.when(i > 0, F.substring("norm", i + 1, "size")).otherwise(F.col("norm")))
        ),
    )
    tiny = found.where(F.col("size").between(*ONE_EDIT)).dropDuplicates(["h"])
    return keys.union(tiny.select("h", F.explode(without).alias("key"))).distinct()


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def similar(a: Column, b: Column, similarity: float) -> Column:
    """Whether the edit similarity of two strings is at least ``similarity``.

    Most pairs that get here differ in a few words, so a cheap upper bound of the distance is
    tried first. The distance itself is worked out only as far as is allowed: -1 beyond.
    """
    longest = F.greatest(F.length(a), F.length(b))
    allowed = F.floor((1 - similarity) * longest + 1e-9).cast("int")
    within = F.call_function("levenshtein", a, b, allowed) >= 0
    close = F.when(F.abs(F.length(a) - F.length(b)) > allowed, False).when(replaced(a, b) <= allowed, True)
    return (a == b) | close.otherwise(within)


def replaced(a: Column, b: Column) -> Column:
    """An edit distance that is enough, if not the least: word by word, the longer length
    of each two words that differ, and of words that have no partner with their blank."""
    x, y = F.split(a, " "), F.split(b, " ")
    costs = F.zip_with(
        x,
        y,
        lambda p, q: F.when(p == q, 0).otherwise(
            F.greatest(F.coalesce(F.length(p), F.lit(0)), F.coalesce(F.length(q), F.lit(0)))
            + F.when(p.isNull() | q.isNull(), 1).otherwise(0)
        ),
    )
    return F.reduce(costs, F.lit(0), lambda total, c: total + F.coalesce(c, F.lit(0)))


def meetings(keys: DataFrame, distinct: DataFrame) -> DataFrame:
    """``key``, ``h``, ``size``, ``sim`` and ``hub`` of lines in keys of several lines."""
    hubs = (
        keys.groupBy("key")
        .agg(F.min("h").alias("hub"), F.max("h").alias("last"))
        .where("hub != last")
        .select("key", "hub")
    )
    known = distinct.select("h", "size", "sim")
    return keys.join(kept(hubs, "line-hubs"), "key").join(known, "h").select("key", "h", "size", "sim", "hub")


def may_link(settings: Settings) -> Column:
    """Whether the lengths and SimHashes of lines a and b allow a link."""
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    fits = high - low <= F.floor((1 - settings.similarity) * high + 1e-9)
    if settings.distance >= BITS:
        return fits
    return fits & (apart(F.col("sim_a"), F.col("sim_b")) <= settings.distance)


def hub_pairs(met: DataFrame, distinct: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of a line and the hub of one of its keys."""
    pairs = met.where("h != hub").select(
        F.col("h").alias("a"), F.col("size").alias("size_a"), F.col("sim").alias("sim_a"), F.col("hub").alias("b")
    ).distinct()
    hubs = distinct.select(F.col("h").alias("b"), F.col("size").alias("size_b"), F.col("sim").alias("sim_b"))
    return pairs.join(hubs, "b").where(may_link(settings)).select("a", "b")


def open_pairs(met: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of lines of a key that may be linked, in different classes so far.

    Similar lines are about as long: they meet in rings of one ratio of lengths, each line
    copied to the next ring.
    """
    known = classes.select(F.col("id").alias("h"), F.col("component").alias("class"))
    ratio = -math.log(max(settings.similarity, 0.01)) + 1e-6
    rows = met.join(known, "h", "left").select(
        "key", "h", "size", "sim", F.coalesce("class", "h").alias("class"),
        F.floor(F.log("size") / max(ratio, 0.01)).cast("int").alias("ring"),
    )
    rows = kept(rows, "line-rings")
    several = (
        rows.groupBy("key")
        .agg(F.min("class").alias("x"), F.max("class").alias("y"))
        .where("x != y")
        .select("key")
    )
    rows = kept(rows.join(kept(several, "open-keys"), "key"), "open-lines")
    near = F.explode(F.array(F.col("ring"), F.col("ring") + 1)).alias("ring")
    of = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("h", "size", "sim", "class")]
    own = rows.select("key", "ring", F.col("ring").alias("home"), *of("a"))
    both = own.join(rows.select("key", F.col("ring").alias("from"), near, *of("b")), ["key", "ring"])
    return (
        both.where("class_a != class_b and (from < home or h_a < h_b)")
        .where(may_link(settings))
        .select(F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b"))
        .distinct()
    )


def fetched(
    docs: DataFrame, wanted: DataFrame, distinct: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """``h`` and ``norm`` (words joined by blanks) of the lines in ``wanted``, and few others.

    They are looked up where they occur first. A filter of fixed size is tested on every
    place, so that no text but theirs is taken apart or shuffled.
    """
    places = wanted.join(distinct, "h").select(F.xxhash64("at.row", "at.line_no").alias("place"))
    bits = FILTER_BITS
    bit = lambda i: F.pmod(F.xxhash64("place", F.lit(i)), F.lit(bits))
    marks = (
        places.select(F.explode(F.array(*[bit(i) for i in range(3)])).alias("p"))
        .groupBy(F.expr("p div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    )
    spark = docs.sparkSession
    # All words of the filter in one row: FILTER_BITS / 8 bytes.
    empty = spark.range(bits // 64).withColumnRenamed("id", "word").withColumn("bits", F.lit(0).cast("long"))
    table = (
        marks.union(empty)
        .groupBy("word")
        .agg(F.expr("bit_or(bits)").alias("bits"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("t"))
        .select(F.col("t.bits").alias("t"))
    )
    table = kept(table, "line-filter").scalar()
    ok = F.lit(True)
    for i in range(3):
        word = F.get(table, F.expr(f"cast(pmod(xxhash64(place, {i}), {bits}L) div 64 as int)"))
        ok &= F.getbit(word, F.expr(f"cast(pmod(xxhash64(place, {i}), {bits}L) % 64 as int)")) == 1
    split = F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")
    return (
        docs.select(F.xxhash64(id_col, text_col).alias("row"), split)
        .withColumn("place", F.xxhash64("row", "line_no"))
        .where(ok)
        .select(words(F.col("line")).alias("words"))
        .select(F.xxhash64("words").alias("h"), F.array_join("words", " ").alias("norm"))
        .dropDuplicates(["h"])
    )


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    of = lambda s: texts.select(F.col("h").alias(s), F.col("norm").alias(f"norm_{s}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.where(similar(F.col("norm_a"), F.col("norm_b"), settings.similarity)).select("a", "b")


def line_classes(
    docs: DataFrame, distinct: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """``id`` and ``component`` of the distinct lines that are linked with others."""
    keys = kept(line_keys(docs, settings, id_col, text_col), "line-keys")
    met = kept(meetings(keys, distinct), "line-meetings")
    forget(keys)
    pairs = kept(hub_pairs(met, distinct, settings), "hub-pairs")
    ends = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    texts = kept(fetched(docs, kept(ends, "wanted-lines"), distinct, id_col, text_col), "line-texts")
    # One hub per line first: with most lines connected by that, few pairs are left.
    first = pairs.groupBy("a").agg(F.min("b").alias("b"))
    links = kept(verified(first, texts, settings), "line-links")
    classes = kept(components(links), "line-classes")
    left = kept(_apart(pairs, classes), "open-pairs")
    links = links.union(kept(verified(left, texts, settings), "line-links"))
    classes = kept(components(links), "line-classes")
    forget(texts)
    # Lines that are not both similar to their hub may still be similar to each other.
    rest = open_pairs(met, classes, settings).join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    rest = kept(rest, "rest-pairs")
    ends = rest.select(F.col("a").alias("h")).union(rest.select("b")).distinct()
    texts = kept(fetched(docs, kept(ends, "wanted-lines"), distinct, id_col, text_col), "line-texts")
    more = kept(verified(rest, texts, settings), "more-links")
    forget(met, pairs, rest, texts)
    return components(links.union(more)) if more.limit(1).count() else classes


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one class."""
    of = lambda s: classes.select(F.col("id").alias(s), F.col("component").alias(f"c_{s}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where("c_a is null or c_b is null or c_a != c_b").select("a", "b")


def repeated_lines(
    docs: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """``row`` and ``line_nos``: the lines to remove, by the row they are in."""
    split = lines(docs, id_col, text_col)
    size = F.length(F.array_join("words", " ")).alias("size")
    found = kept(split.select("row", "id", "line_no", "h", size), "lines")
    at = F.struct(F.col("id").isNull().alias("z"), "id", "line_no", "row")
    distinct = found.groupBy("h").agg(F.min("size").alias("size"), F.min(at).alias("at"), F.max(at).alias("last"))
    if settings.distance < BITS:
        sims = kept(simhashes(split).groupBy("h").agg(F.min("sim").alias("sim")), "line-sims")
        distinct = distinct.join(sims, "h")
    else:
        distinct = distinct.withColumn("sim", F.lit(0).cast("long"))
    distinct = kept(distinct, "distinct-lines")
    classes = line_classes(docs, distinct, settings, id_col, text_col)
    classes = classes.select(F.col("id").alias("h"), "component")
    grouped = kept(
        distinct.join(classes, "h", "left").where("component is not null or at != last"), "line-groups"
    )
    grouped = grouped.withColumn("component", F.coalesce("component", "h"))
    first = kept(grouped.groupBy("component").agg(F.min("at").alias("stays")), "first-lines")
    stays = kept(
        grouped.select("h", "component")
        .join(first, "component")
        .select("h", F.col("stays.row").alias("stay_row"), F.col("stays.line_no").alias("stay_no")),
        "kept-lines",
    )
    return (
        found.join(stays, "h")
        .where("row != stay_row or line_no != stay_no")
        .groupBy("row")
        .agg(F.collect_set("line_no").alias("line_nos"))
    )


def dedup_lines(
    docs: DataFrame,
    settings: Settings = EDITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts, and three more columns.

    ``n_lines`` counts the lines that have a word, ``n_removed`` those taken out, and
    ``emptied`` tells that none of them is left. Of every group of equal or similar lines
    the one in the smallest id, and there the first, stays; ids that are NULL come last.
    Lines without a word are structure and always stay. NULL and empty texts pass as they
    are. Rows repeated with id and text are edited alike. Other columns pass unchanged, but
    for ones named like the new columns, which are replaced.
    """
    drops = kept(repeated_lines(docs, settings, id_col, text_col), "removed-lines")
    drops = drops.select(F.col("row").alias("__row"), F.col("line_nos").alias("__nos"))
    out = docs.drop("n_lines", "n_removed", "emptied")
    out = out.withColumn("__row", F.xxhash64(id_col, text_col)).join(drops, "__row", "left")
    split = F.split(F.col(text_col), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__nos"))
    text = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    worded = F.size(F.filter(split, lambda x: F.rlike(x, F.lit(r"[\p{L}\p{N}]"))))
    removed = F.coalesce(F.size("__nos"), F.lit(0))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(worded).alias("n_lines")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "emptied")]
    edited = F.when(F.col("__nos").isNotNull(), text).otherwise(F.col(text_col))
    return out.select(
        *[edited.alias(c) if c == text_col else F.col(c) for c in names],
        total,
        removed.alias("n_removed"),
        ((removed > 0) & (removed == total)).alias("emptied"),
    )
