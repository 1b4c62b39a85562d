"""Document fingerprints by I-Match.

Terms in a band of document frequencies form the lexicon. Several random subsets of it
are drawn by hash; a text's part for a subset is the hash of its sorted distinct terms in
it. Texts that differ in a few terms still agree in the parts whose subsets miss those.
DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import kept

SEPARATOR = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Settings:
    """``low`` and ``high``: shares of the documents a lexicon term is in.

    Terms in at least a share ``low`` of documents of d distinct terms on average number
    d / low at most, whatever the corpus; ``max_terms`` states the bound outright (the
    most frequent ones stay). ``parts`` subsets each hold one term in ``one_in``.
    """

    low: float = 0.01
    high: float = 0.05
    max_terms: int = 100_000
    parts: int = 16
    one_in: int = 40


def words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), SEPARATOR)), "")


def lexicon(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """``term`` and ``mask``, whose bit k says that subset k has the term; terms in some subset."""
    texts = docs.select(F.col(text_col).alias("__text")).where("__text is not null")
    n = texts.count()
    low, high = max(2, math.ceil(settings.low * n)), math.floor(settings.high * n)
    found = (
        texts.select(F.explode(words(F.col("__text"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= low) & (F.col("n") <= high))
        .orderBy(F.col("n").desc(), "term")
        .limit(settings.max_terms)
    )
    mask = F.lit(0).cast("long")
    for k in range(settings.parts):
        hit = F.pmod(F.xxhash64("term", F.lit(k)), F.lit(settings.one_in)) == 0
        mask = mask.bitwiseOR(F.when(hit, F.lit(1 << k)).otherwise(0).cast("long"))
    return found.select("term", mask.alias("mask")).where("mask != 0")


def fingerprints(
    texts: DataFrame, terms: DataFrame, settings: Settings = Settings(), text_col: str = "text"
) -> DataFrame:
    """The columns of ``texts`` but ``text_col``, one row per distinct values, and ``fingerprint``.

    Texts without a lexicon term have a NULL fingerprint; ``or_exact`` names them by their
    content.
    """
    keys = [c for c in texts.columns if c != text_col]
    bits = F.sequence(F.lit(0), F.lit(settings.parts - 1))

    def part(k: Column) -> Column:
        own = F.filter("__found", lambda x: F.getbit(x["mask"], k) == 1)
        joined = F.array_join(F.transform(own, lambda x: x["term"]), " ")
        return F.when(F.size(own) > 0, F.substring(F.md5(joined), 1, 8)).otherwise("")

    # The empty word is in no subset, and there for every text to have a match.
    spark = texts.sparkSession
    terms = terms.unionByName(spark.range(1).select(F.lit("").alias("term"), F.lit(0).cast("long").alias("mask")))
    found = F.concat(F.split(F.lower(F.col(text_col)), SEPARATOR), F.array(F.lit("")))
    joined = F.array_join(F.transform(bits, part), "-")
    # The lexicon is bounded by ``max_terms``.
    return (
        texts.select(*keys, F.explode(found).alias("__term"))
        .join(F.broadcast(terms.withColumnRenamed("term", "__term")), "__term")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(F.struct(F.col("__term").alias("term"), "mask"))).alias("__found"))
        .select(*keys, F.when(F.size("__found") > 1, joined).alias("fingerprint"))
    )


def or_exact(fingerprint: Column, sha256: Column) -> Column:
    """The fingerprint, or for a text without lexicon terms one of its very content."""
    return F.coalesce(fingerprint, F.concat(F.lit("x"), F.substring(sha256, 1, 32)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those that either fingerprint has; 1 for equal ones."""
    pairs = F.arrays_zip(F.split(a, "-").alias("a"), F.split(b, "-").alias("b"))
    some = F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != ""))
    same = F.filter(some, lambda p: p["a"] == p["b"])
    return F.when(a == b, 1.0).otherwise(F.coalesce(F.try_divide(F.size(same), F.size(some)), F.lit(0.0)))


def with_next(docs: DataFrame, id_col: str, text_col: str, rows_per_range: int = 5_000) -> DataFrame:
    """``id_col``, text, next_text (the text of the next row by descending id), and ``row``,
    a number for the row.

    After the last row comes the first. Rows are cut into ranges of ids, each ordered by
    itself; the first row of a range follows the last of the range above. Rows of one id
    follow each other by content. NULL texts are empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col), text.alias("text")).withColumn("__h", F.xxhash64("text"))
    ranges = max(2, min(10_000, docs.count() // rows_per_range + 1))
    cuts = own.agg(
        F.percentile_approx(
            F.col(id_col), [i / ranges for i in range(1, ranges)], F.lit(20 * ranges)
        )
    ).first()[0]
    bounds = sorted(set(cuts or []))
    number = F.lit(0)
    if bounds:
        number = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(id_col)))
    own = own.withColumn("__range", F.when(F.col(id_col).isNull(), -1).otherwise(number))
    heads = own.groupBy("__range").agg(F.max(F.struct(id_col, "__h", "text")).alias("head"))
    # One row per range.
    down = Window.orderBy(F.col("__range").desc())
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "__range",
        F.coalesce(F.lead("head").over(down), F.first("head").over(every))["text"].alias("__after"),
    )
    order = Window.partitionBy("__range").orderBy(
        F.col(id_col).desc_nulls_last(), F.col("__h").desc(), F.col("text").desc()
    )
    rows = own.withColumn("__lead", F.lead("text").over(order))
    rows = rows.withColumn("__at", F.row_number().over(order))
    joined = rows.join(kept(heads, "range-heads"), "__range")
    row = F.struct("__range", "__at").alias("row")
    return joined.select(id_col, "text", F.coalesce("__lead", "__after").alias("next_text"), row)


def edited(text: Column, other: Column) -> Column:
    """``text`` with its second half (floor) replaced by as many code points of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(other, half))


def compare_edited(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every row's text, of its edited text, and their likeness.

    Columns: ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the next row's text). NULL texts are empty
    ones; equal texts have equal fingerprints, also those without lexicon terms. Repeated
    rows give a row each; other columns are not read.
    """
    terms = kept(lexicon(docs, settings, text_col), "lexicon")
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    base = rows.select(
        id_col,
        "row",
        F.length("text").cast("long").alias("n_chars"),
        sha("text").alias("own"),
        sha("edited").alias("edited_sha256"),
        sha("next_text").alias("next"),
        "edited",
    )
    base = kept(
        fingerprints(base, terms, settings, "edited").withColumnRenamed("fingerprint", "edited_print"),
        "edited-fingerprints",
    )
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prints = kept(
        fingerprints(texts.select(sha("text").alias("key"), "text"), terms, settings), "fingerprints"
    )

    def look_up(rows: DataFrame, key: str, name: str) -> DataFrame:
        found = prints.select(F.col("key").alias(key), F.col("fingerprint").alias("__f"))
        return (
            rows.join(found, key, "left")
            .withColumn(name, or_exact(F.col("__f"), F.col(key)))
            .drop("__f")
        )

    out = look_up(look_up(base, "own", "fingerprint"), "next", "__next")
    out = out.withColumn("edited_fingerprint", or_exact(F.col("edited_print"), F.col("edited_sha256")))
    return out.select(
        id_col,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )
