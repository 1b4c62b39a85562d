"""A corpus pipeline: stages over ``documents``, each written and read again.

Every stage works on all that the one before it kept, and all but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import decontamination, jaccard_join, language_id, line_blocks, mixing
from lakejobs.llm.common import kept, table
from lakejobs.llm.queries import MIXTURE


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; the others are rejected."""
    return language_id.keep_identified(docs, language_id.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document of nothing but repeated lines goes.

    ``n_chars`` follows the text.
    """
    out = line_blocks.dedup_lines(docs).where(~F.col("emptied"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Decided per row: of different texts under one id, or without an id, one stays too; NULL
    ids come last. Rows repeated with id and text stay or go together, but for those without
    an id, of which one stays.
    """
    numbered = kept(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    found = jaccard_join.jaccard_components(numbered, id_col="__row").select("__row", F.col("component_id").alias("__c"))
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    ranked = kept(numbered.select("__row", rank.alias("at")).join(kept(found, "near-classes"), "__row"), "near-rows")
    first = kept(ranked.groupBy("__c").agg(F.min(F.struct("at", "__row")).alias("first")), "near-first")
    # Repeated rows have ids to be told by; what has none is told by its row.
    other = ~F.col("at").eqNullSafe(F.col("first.at")) | (F.col("at.z") & (F.col("__row") != F.col("first.__row")))
    gone = kept(ranked.join(first, "__c").where(other).select("__row"), "near-duplicates")
    return numbered.join(gone, "__row", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in the target mixture, in shuffled order."""
    return mixing.mix(docs, MIXTURE)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", dedup_documents),
    ("benchmark_decontamination", decontaminate),
    ("mixing_sources", mix_sources),
]

# Language identification, edit similarity over groups and string tiling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
