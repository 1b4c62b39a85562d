"""Fuzzy line deduplication by SimHash blocks. DataFrame functions only.

Lines are normalised to lower-cased words; lines of equal words are one. Every distinct line
gets a SimHash of 256 bits, which is cut into blocks. Lines that share a block meet: in a block of
many all with its smallest and its central line, and among themselves only those that are not
connected yet.
SimHashes far apart part the unrelated, edit similarity decides about the others, and of
every connected group of lines one occurrence stays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import forget, kept
from lakejobs.llm.components import components
from lakejobs.llm.line_dedup import fetched, lines, similar

LANES = 4  # of 64 bits each
# A lane has nine windows of seven bits; a block is one window of each lane.
WINDOW, WINDOWS = 7, 9
# Lines of so many words or fewer are hashed by runs of three letters.
FEW_WORDS = 10
# Words weigh one, from so many letters on two, and three: about the root of their length,
# with which the angle between two lines follows their edit similarity.
LONGER, LONGEST = 4, 9
# Tokens whose bits are counted together: each counts up to three times, in 14 bits.
PIECE = ((1 << 14) - 1) // 3
# Up to so many lines of a block all meet at once.
CROWD = 32
# Blocks of a line that are shuffled at a time.
AT_ONCE = 3
ONES = 0x0001000100010001


@dataclass(frozen=True)
class Settings:
    """``similarity``: one minus edit distance over the longer length. ``distance``: bits in
    which two SimHashes may differ (a quarter of the 256; unrelated lines do in about half). ``turns``:
    nine blocks each; more of them find more of the similar pairs.
    """

    similarity: float = 0.8
    distance: int = 64
    turns: int = 3


def tokens(norm: Column) -> Column:
    """Words of a line; of a line of few words its runs of three letters, blanks included."""
    words = F.split(norm, " ")
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    runs = F.transform(F.sequence(F.lit(1), F.length(norm)), lambda i: F.substring(padded, i, 3))
    return F.when(F.size(words) <= FEW_WORDS, runs).otherwise(words)


def simhashes(texts: DataFrame) -> DataFrame:
    """``h``, ``g`` and lanes ``a0`` to ``a3`` of distinct lines ``h``, ``g``, ``norm``.

    Bit b tells whether the tokens whose hash has it make up more than half of the weight.
    Four bits of a lane are counted in each of 16 sums, 16 binary places apart. Lines of
    more than PIECE tokens are counted in pieces, and the counts added up without as many of
    their lowest places as could overflow. ``texts`` is partitioned by ``h`` and ``g``
    already: nothing is shuffled here.
    """
    keys = ["h", "g"]
    each = texts.select(*keys, tokens(F.col("norm")).alias("tokens"))
    pieces = F.ceil(F.size("tokens") / F.lit(PIECE))
    each = each.select(
        *keys,
        F.ceil(F.log2(pieces)).cast("int").alias("halved"),
        F.posexplode("tokens").alias("at", "token"),
    )
    letters = F.length("token")
    weight = F.when(letters < LONGER, 1).when(letters < LONGEST, 2).otherwise(3).cast("long").alias("weight")
    piece = F.expr(f"at div {PIECE}").alias("piece")
    each = each.select(*keys, "halved", piece, weight, F.xxhash64("token").alias("t0"))
    each = each.select("*", *[F.xxhash64("t0", F.lit(i)).alias(f"t{i}") for i in range(1, LANES)])
    names = [(i, k, f"s{i}_{k}") for i in range(LANES) for k in range(16)]
    bits = lambda i, k: F.shiftrightunsigned(f"t{i}", k).bitwiseAND(F.lit(ONES))
    counted = each.groupBy(*keys, "halved", "piece").agg(
        F.sum("weight").alias("n"), *[F.sum(bits(i, k) * F.col("weight")).alias(s) for i, k, s in names]
    )
    mask = F.lit(ONES) * F.expr("shiftright(65535, halved)").cast("long")
    # With nothing halved, the mask has all bits set; as a product it would overflow.
    mask = F.when(F.col("halved") == 0, F.lit(-1).cast("long")).otherwise(mask)
    part = lambda s: F.expr(f"shiftrightunsigned({s}, halved)").bitwiseAND(mask)
    whole = counted.groupBy(*keys).agg(
        F.sum(F.expr("shiftright(n, halved)")).alias("n"), *[F.sum(part(s)).alias(s) for _, _, s in names]
    )
    # Adding this to a count sets bit 14 of it if it is more than half of n.
    lift = (F.lit(0x3FFF).cast("long") - F.expr("n div 2")) * F.lit(ONES)
    top = lambda s: F.shiftrightunsigned(F.col(s) + lift, 14).bitwiseAND(F.lit(ONES))
    lane = lambda i: reduce(
        Column.bitwiseOR, [F.shiftleft(top(s), k) for j, k, s in names if j == i]
    )
    return whole.select(*keys, *[lane(i).alias(f"a{i}") for i in range(LANES)])


def blocks(turns: int) -> list[Column]:
    """Blocks of a SimHash, each a number that names the block and holds its bits.

    Block i of turn t takes window i + t * lane of every lane: those of a turn have no bit
    in common, those of two turns at most one window.
    """
    out = []
    for number in range(turns * WINDOWS):
        turn, i = divmod(number, WINDOWS)
        key = F.lit(number).cast("long")
        for lane in range(LANES):
            at = WINDOW * ((i + turn * lane) % WINDOWS)
            window = F.shiftrightunsigned(f"a{lane}", at).bitwiseAND(F.lit((1 << WINDOW) - 1))
            key = F.shiftleft(key, WINDOW).bitwiseOR(window)
        out.append(key)
    return out


def distinct_lines(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All lines, and the distinct ones with a number, their SimHash and first place."""
    split = lines(docs, id_col, text_col).withColumn("g", F.xxhash64(F.lit(1), "words"))
    norm = F.array_join("words", " ").alias("norm")
    found = kept(split.select("row", "id", "line_no", "h", "g", F.length(norm).alias("size")), "lines")
    sims = kept(simhashes(split.select("h", "g", norm).groupBy("h", "g").agg(F.first("norm").alias("norm"))), "line-sims")
    at = F.struct(F.col("id").isNull().alias("z"), "id", "line_no", "row")
    places = found.groupBy("h", "g").agg(F.min("size").alias("size"), F.min(at).alias("at"), F.max(at).alias("last"))
    numbered = places.join(sims, ["h", "g"]).withColumn("n", F.monotonically_increasing_id())
    distinct = kept(numbered, "distinct-lines")
    forget(sims)
    return found, distinct


def meetings(distinct: DataFrame, keys: list[Column]) -> DataFrame:
    """``key``, ``n``, ``size``, SimHash, and ``hub`` (the smallest line) and ``m`` (how many
    there are) of all lines in blocks of several, of those blocks that ``keys`` name.

    Rows are shuffled by ``key`` only.
    """
    named = ["n", "size", *[f"a{i}" for i in range(LANES)]]
    rows = distinct.select(*named, F.explode(F.array(*keys)).alias("key")).repartition("key")
    hubs = rows.groupBy("key").agg(F.min("n").alias("hub"), F.max("n").alias("last"), F.count(F.lit(1)).alias("m"))
    return rows.join(hubs.where("hub != last").select("key", "hub", "m").hint("shuffle_hash"), "key")


def ends(distinct: DataFrame, side: str) -> DataFrame:
    named = ["n", "size", *[f"a{i}" for i in range(LANES)]]
    return distinct.select(*[F.col(c).alias(side if c == "n" else f"{c}_{side}") for c in named])


def may_link(settings: Settings) -> Column:
    """Whether the lengths and SimHashes of lines a and b allow a link."""
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    bits = [F.bit_count(F.col(f"a{i}_a").bitwiseXOR(F.col(f"a{i}_b"))) for i in range(LANES)]
    fits = high - low <= F.floor((1 - settings.similarity) * high + 1e-9)
    return fits & (reduce(Column.__add__, bits) <= settings.distance)


def block_pairs(met: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of a line and a smaller one of its block that may be linked.

    In a block of up to CROWD lines those are all the smaller ones, in a larger one only the
    hub: the lines of such a block meet in ``central_pairs`` and ``open_pairs``. Lines that
    came into a block by chance are parted here, where they are, and shuffled no further.
    """
    lanes = [f"a{i}" for i in range(LANES)]
    of = lambda s: [F.col(c).alias(s if c == "n" else f"{c}_{s}") for c in ("n", "size", *lanes)]
    own = met.where("n != hub").select("key", *of("a"))
    other = met.where((F.col("m") <= CROWD) | (F.col("n") == F.col("hub"))).select("key", *of("b"))
    return own.join(other, "key").where("b < a").where(may_link(settings)).select("a", "b").distinct()


def meet(distinct: DataFrame, settings: Settings) -> tuple[list[DataFrame], list[DataFrame]]:
    """The tables of ``block_pairs``, and ``key`` and ``n`` of the lines in blocks of more than
    CROWD. A few blocks of every line are shuffled at a time, which bounds the disk."""
    keys = blocks(settings.turns)
    pairs, crowds = [], []
    for first in range(0, len(keys), AT_ONCE):
        met = kept(meetings(distinct, keys[first : first + AT_ONCE]), "line-meetings")
        pairs.append(kept(block_pairs(met, settings), "block-pairs"))
        crowds.append(kept(met.where(F.col("m") > CROWD).select("key", "n"), "crowded-lines"))
        forget(met)
    return pairs, crowds


def central_pairs(met: DataFrame, distinct: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of a line and the central line of one of its blocks: that whose
    SimHash is nearest to the bitwise majority of the block's (ties: the smallest).

    Of a group of copies of one line with edits here and there, that line, or one like it,
    is central; compared with it, the copies are connected without meeting in pairs. Bits are
    counted two at a time, 32 binary places apart.
    """
    ones = 0x0000000100000001
    lanes = [f"a{i}" for i in range(LANES)]
    rows = met.join(distinct.select("n", *lanes), "n")
    sums = [
        F.sum(F.shiftrightunsigned(lane, k).bitwiseAND(F.lit(ones))).alias(f"s{lane}_{k}")
        for lane in lanes for k in range(32)
    ]
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *sums)
    # Adding this to a count sets bit 30 of it if it is more than half of m (below 2 ** 30).
    lift = (F.lit(0x3FFFFFFF).cast("long") - F.expr("m div 2")) * F.lit(ones)
    top = lambda s: F.shiftrightunsigned(F.col(s) + lift, 30).bitwiseAND(F.lit(ones))
    major = [
        reduce(Column.bitwiseOR, [F.shiftleft(top(f"s{lane}_{k}"), k) for k in range(32)]).alias(f"m_{lane}")
        for lane in lanes
    ]
    majority = counted.select("key", *major)
    off = reduce(Column.__add__, [F.bit_count(F.col(lane).bitwiseXOR(F.col(f"m_{lane}"))) for lane in lanes])
    nearest = rows.join(majority, "key").groupBy("key").agg(F.min(F.struct(off.alias("off"), "n")).alias("c"))
    found = met.join(nearest.select("key", F.col("c.n").alias("b")), "key").where("n != b")
    pairs = found.select(F.col("n").alias("a"), "b").distinct()
    both = pairs.join(ends(distinct, "a"), "a").join(ends(distinct, "b"), "b")
    return both.where(may_link(settings)).select("a", "b")


def open_pairs(met: DataFrame, classes: DataFrame, distinct: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of lines of a block that may be linked, in different classes so far.

    Similar lines are about as long: they meet in rings of one ratio of lengths, each line
    copied to the next ring.
    """
    known = classes.select(F.col("id").alias("n"), F.col("component").alias("class"))
    rows = kept(met.join(known, "n", "left").select("key", "n", F.coalesce("class", "n").alias("class")), "line-rows")
    several = rows.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x != y")
    ring = F.floor(F.log("size") / max(-math.log(max(settings.similarity, 0.01)) + 1e-6, 0.01)).cast("int")
    lanes = [f"a{i}" for i in range(LANES)]
    apart = rows.join(kept(several.select("key"), "open-keys"), "key").join(distinct.select("n", "size", *lanes), "n")
    apart = kept(apart.withColumn("ring", ring), "open-lines")
    of = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("n", "class", "size", *lanes)]
    own = apart.select("key", "ring", F.col("ring").alias("home"), *of("a"))
    near = F.explode(F.array(F.col("ring"), F.col("ring") + 1)).alias("ring")
    both = own.join(apart.select("key", F.col("ring").alias("from"), near, *of("b")), ["key", "ring"])
    found = (
        both.where("class_a != class_b and (from < home or n_a < n_b)")
        .where(may_link(settings))
        .select(F.greatest("n_a", "n_b").alias("a"), F.least("n_a", "n_b").alias("b"))
    )
    found = kept(found.distinct(), "rest-pairs")
    forget(rows, apart)
    return found


def verified(
    pairs: DataFrame, docs: DataFrame, distinct: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """Those of ``pairs`` whose texts are similar; only texts in a pair are fetched."""
    named = pairs.select(F.col("a").alias("n")).union(pairs.select("b")).distinct()
    wanted = kept(distinct.join(named, "n").select("n", "h", "g", "at"), "wanted-lines")
    hashes = wanted.select("h").distinct()
    texts = fetched(docs, hashes, wanted.select("h", "at"), id_col, text_col)
    texts = texts.withColumn("g", F.xxhash64(F.lit(1), F.split("norm", " ")))
    texts = kept(texts.join(wanted, ["h", "g"]).select("n", "norm"), "line-texts")
    of = lambda s: texts.select(F.col("n").alias(s), F.col("norm").alias(f"norm_{s}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    links = kept(both.where(similar(F.col("norm_a"), F.col("norm_b"), settings.similarity)).select("a", "b"), "line-links")
    forget(wanted, texts)
    return links


def line_classes(
    docs: DataFrame, distinct: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """``id`` and ``component`` of the distinct lines that are linked with others."""
    check = lambda pairs: verified(pairs, docs, distinct, settings, id_col, text_col)
    pair_tables, crowds = meet(distinct, settings)
    pairs, met = reduce(DataFrame.union, pair_tables), reduce(DataFrame.union, crowds)
    central = kept(central_pairs(met, distinct, settings), "central-pairs")
    # One pair per line and the central lines first: with most lines connected by those, few
    # pairs are left.
    first = pairs.groupBy("a").agg(F.min("b").alias("b")).union(central).distinct()
    first = kept(first, "first-pairs")
    links = check(first)
    forget(central, first)
    classes = kept(components(links), "line-classes")
    of = lambda s: classes.select(F.col("id").alias(s), F.col("component").alias(f"c_{s}"))
    # Other pairs of the blocks, and of lines of crowded ones that are not both similar to their hub.
    apart = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    apart = apart.where("c_a is null or c_b is null or c_a != c_b").select("a", "b")
    rest = open_pairs(met, classes, distinct, settings)
    more = check(kept(apart.union(rest).distinct(), "open-pairs"))
    forget(*pair_tables, *crowds, rest, classes)
    classes = kept(components(links.union(more)), "line-classes")
    forget(links, more)
    return classes


def line_groups(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row``, ``id``, ``line_no``, ``stay_row``, ``stay_id``, ``stay_no`` of grouped lines.

    One row for every line that has an equal or similar one; the last three name the line
    that stands for its group, itself included: that in the smallest id, and there the
    first; ids that are NULL come last. ``row`` is a hash of id and text, as rows may share
    an id. Lines are numbered from 0; those without a word are not looked at.
    """
    found, distinct = distinct_lines(docs, id_col, text_col)
    classes = line_classes(docs, distinct, settings, id_col, text_col)
    named = classes.select(F.col("id").alias("n"), "component")
    grouped = distinct.join(named, "n", "left").where("component is not null or at != last")
    grouped = kept(grouped.select("h", "g", "at", F.coalesce("component", "n").alias("component")), "line-groups")
    first = kept(grouped.groupBy("component").agg(F.min("at").alias("stays")), "first-lines")
    stays = grouped.join(first, "component").select(
        "h", "g", F.col("stays.row").alias("stay_row"), F.col("stays.id").alias("stay_id"), F.col("stays.line_no").alias("stay_no")
    )
    stays = kept(stays, "staying-lines")
    forget(distinct, classes, grouped, first)
    out = kept(found.join(stays, ["h", "g"]).drop("h", "g", "size"), "grouped-lines")
    forget(found, stays)
    return out


def dedup_lines(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts, and three more columns.

    ``n_lines`` counts the lines that have a word, ``n_removed`` those taken out, and
    ``emptied`` tells that none of them is left. Of every group of ``line_groups`` one line
    stays. Lines without a word are structure and always stay. NULL and empty texts pass as
    they are. Rows repeated with id and text are edited alike. Other columns pass unchanged,
    but for ones named like the new columns, which are replaced.
    """
    groups = line_groups(docs, settings, id_col, text_col)
    gone = groups.where("row != stay_row or line_no != stay_no or not id <=> stay_id")
    drops = kept(
        gone.groupBy(F.col("row").alias("__row"), F.col("id").alias("__id")).agg(F.collect_set("line_no").alias("__nos")),
        "removed-lines",
    )
    forget(groups)
    out = docs.drop("n_lines", "n_removed", "emptied").withColumn("__of", F.xxhash64(id_col, text_col))
    out = out.join(drops, (F.col("__of") == F.col("__row")) & F.col(id_col).eqNullSafe(F.col("__id")), "left")
    split = F.split(F.col(text_col), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__nos"))
    text = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    worded = F.size(F.filter(split, lambda x: F.rlike(x, F.lit(r"[\p{L}\p{N}]"))))
    removed = F.coalesce(F.size("__nos"), F.lit(0))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(worded).alias("n_lines")
    edited = F.when(F.col("__nos").isNotNull(), text).otherwise(F.col(text_col))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "emptied")]
    return out.select(
        *[edited.alias(c) if c == text_col else F.col(c) for c in names],
        total,
        removed.alias("n_removed"),
        ((removed > 0) & (removed == total)).alias("emptied"),
    )
