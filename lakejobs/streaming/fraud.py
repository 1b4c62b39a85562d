"""Card fraud on a stream of point-of-sale records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakejobs.operators.skew import DEFAULT, Hot, Skew, join_lookup, search
from lakejobs.plans import fraud
from lakejobs.session import delete
from lakejobs.sinks import commits
from lakejobs.sinks.batches import batch_path, write_batch
from lakejobs.streaming import cards as states
from lakejobs.streaming import jobs
from lakejobs.streaming.cards import MEMORY


def blacklist_query(
    lines: DataFrame,
    read_cards: Callable[[], DataFrame],
    read_merchants: Callable[[], DataFrame],
    write: jobs.BatchWriter,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Records whose card or merchant is blacklisted, with ``matched_on``.

    The lists are read again for every micro-batch, so additions count from the next.
    """
    records, _ = fraud.parse_stream(lines)

    def match(batch: DataFrame, batch_id: int) -> None:
        with jobs.kept(batch):
            hits = [
                fraud.blacklist_hits(batch, blacklist, on)
                .select(batch.columns)
                .withColumn("matched_on", F.lit(on))
                for blacklist, on in ((read_cards(), "card_id"), (read_merchants(), "merchant_id"))
            ]
            write(hits[0].unionByName(hits[1]), batch_id)

    return jobs.start(records, match, checkpoint, interval)


def split_late(
    records: DataFrame,
    memory: DataFrame,
    skew: Skew | None = DEFAULT,
    found: dict[str, Hot | None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records after, and records before, the last one already decided on their card."""
    last = memory.groupBy("card_id").agg(F.max(F.struct(*fraud.ORDER)).alias("_last"))
    known = join_lookup(records, last, "card_id", ("txn_id",), skew, records, found)
    late = F.coalesce(F.struct(*fraud.ORDER) <= F.col("_last"), F.lit(False))
    return known.where(~late).drop("_last"), known.where(late).drop("_last")


def remember(records: DataFrame, n: int = fraud.RECENT) -> DataFrame:
    """The last ``n`` records of every card. The rank filter runs before the shuffle."""
    newest = Window.partitionBy("card_id").orderBy(*[F.col(c).desc() for c in fraud.ORDER])
    return (
        records.where(F.col("card_id").isNotNull() & F.col("ts").isNotNull())
        .select(*MEMORY)
        .withColumn("_rn", F.row_number().over(newest))
        .where(F.col("_rn") <= n)
        .drop("_rn")
    )


def decide_stream(
    lines: DataFrame,
    scores: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    n: int = fraud.RECENT,
    skew: Skew | None = DEFAULT,
    **rules,
) -> StreamingQuery:
    """Decide every record; each micro-batch goes on where the one before it stopped.

    Writes ``decided``, ``late``, ``rejected`` and ``memory`` under ``path``, a folder per micro-batch.
    Memory is the last ``n`` records of each card. A micro-batch reads the memory of the
    one before and replaces its own folders, so a repeated one gives the same result.
    It is decided with the batch job's windows: a card with a third of the records is
    cut over tasks, which state held per key could not be. Only the cards of the
    micro-batch take part; the memory of the others is passed on as it is.
    """
    def decide(lines: DataFrame, batch_id: int) -> None:
        with jobs.kept(lines):
            batch, rejected = fraud.parse_stream(lines)
            write_batch(rejected, batch_id, f"{path}/rejected")
            spark = lines.sparkSession
            fresh, late = batch, batch.limit(0)
            recalled = others = batch.limit(0).select(*MEMORY)
            if batch_id > 0:
                folder = batch_path(f"{path}/memory", batch_id - 1)
                memory = spark.read.schema(others.schema).parquet(folder)
                cards = batch.select("card_id").distinct()
                recalled = memory.join(cards, "card_id", "left_semi")
                others = memory.join(cards, "card_id", "left_anti")
                fresh, late = split_late(batch, recalled, skew)
            timeline = fresh.withColumn("_seen", F.lit(False)).unionByName(
                recalled.withColumn("_seen", F.lit(True)), allowMissingColumns=True
            )
            decided = fraud.decide_by_card(timeline, scores, n=n, skew=skew, **rules)
            write_batch(decided.where(~F.col("_seen")).drop("_seen"), batch_id, f"{path}/decided")
            write_batch(late, batch_id, f"{path}/late")
            kept = remember(timeline, n).unionByName(others)
            write_batch(kept, batch_id, f"{path}/memory")
            if batch_id > 1:
                delete(spark, batch_path(f"{path}/memory", batch_id - 2))

    return jobs.start(lines, decide, checkpoint, interval)


def decide_keyed(
    lines: DataFrame,
    scores: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    n: int = fraud.RECENT,
    skew: Skew | None = DEFAULT,
    forget_after_days: float | None = None,
    **rules,
) -> StreamingQuery:
    """As ``decide_stream``, with the last ``n`` records of each card in the state store.

    Only the buckets of a micro-batch's cards are touched, see ``cards.recalled``. The state
    gives the records from before the micro-batch, which is then decided with the
    batch job's windows, hot cards cut over tasks; they are searched for once. ``decided``,
    ``late`` and ``rejected`` are committed together: read them with
    ``commits.read_committed``. ``forget_after_days`` bounds the state, see ``cards.recalled``.
    """
    records, _ = fraud.parse_stream(lines)
    before = states.recalled(records, n, forget_after_days)
    both = lines.select("value", F.lit(False).alias("_seen")).unionByName(
        before.withColumn("_seen", F.lit(True)), allowMissingColumns=True
    )

    def decide(batch: DataFrame, batch_id: int) -> None:
        with jobs.kept(batch):
            fresh, rejected = fraud.parse_stream(batch.where(~F.col("_seen")).select("value"))
            memory = batch.where("_seen").select(*MEMORY)
            found = None
            if skew is not None:
                known = fresh.select("card_id", *fraud.ORDER).unionByName(memory.select("card_id", *fraud.ORDER))
                found = search(known, ["card_id"], fraud.ORDER, skew, "ts")
            fresh, late = split_late(fresh, memory, skew, found)
            timeline = fresh.withColumn("_seen", F.lit(False)).unionByName(
                memory.withColumn("_seen", F.lit(True)), allowMissingColumns=True
            )
            decided = fraud.decide_by_card(timeline, scores, n=n, skew=skew, found=found, **rules)
            outputs = {"decided": decided.where(~F.col("_seen")).drop("_seen"), "late": late, "rejected": rejected}
            commits.commit_batch(outputs, batch_id, path)

    return jobs.start(both, decide, checkpoint, interval)


def lost_cards(
    decided: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str,
    strikes: int = fraud.STRIKES,
    interval: str | None = None,
) -> StreamingQuery:
    """Cards lost over a stream of decisions, each told once; see ``cards.lost``."""
    found = states.lost(decided, lateness, strikes)
    return jobs.start(found, jobs.into_batches(path), checkpoint, interval)


# A list of terminals that one stream commits and another reads.
TERMINALS = StructType([StructField("merchant_id", StringType()), StructField("strikes", LongType())])


def keep_blacklist(
    decided: DataFrame,
    path: str,
    checkpoint: str,
    strikes: int = fraud.STRIKES,
    interval: str | None = None,
) -> StreamingQuery:
    """Commit the terminals reaching ``strikes`` suspicious records, a version per micro-batch."""

    def commit(found: DataFrame, batch_id: int) -> None:
        named = found.select(F.col("merchant_id").cast("string"), "strikes")
        commits.commit_batch({"terminals": named}, batch_id, path)

    return jobs.start(fraud.pos_blacklist(decided, strikes), commit, checkpoint, interval, "update")


def pinned_version(
    batch: DataFrame, batch_id: int, checkpoint: str, version_of: Callable[[int], int | None]
) -> int:
    """The version a micro-batch reads: chosen once and kept beside the checkpoint, so that the
    micro-batch gives the same result when it is delivered again. -1 before the first."""
    spark, folder = batch.sparkSession, f"{checkpoint}/pins"
    if batch_id in commits.marks(spark, folder):
        return int(commits.read_mark(spark, folder, batch_id))
    version = version_of(batch_id)
    version = -1 if version is None else version
    commits.put_mark(spark, folder, batch_id, str(version))
    delete(spark, f"{folder}/{batch_id - 2}")
    return version


def match_blacklist(
    lines: DataFrame,
    path: str,
    write: jobs.BatchWriter,
    checkpoint: str,
    interval: str | None = None,
    version_of: Callable[[int], int | None] | None = None,
) -> StreamingQuery:
    """Records of terminals that ``keep_blacklist`` has committed to ``path``.

    Each micro-batch reads the list as of its start, or the version that ``version_of``
    gives for it, and adds ``list_version``.
    """
    spark = lines.sparkSession
    records, _ = fraud.parse_stream(lines)

    def match(batch: DataFrame, batch_id: int) -> None:
        newest = version_of or (lambda _: commits.last_commit(spark, path))
        version = pinned_version(batch, batch_id, checkpoint, newest)
        listed = commits.read_committed(batch.sparkSession, path, "terminals", TERMINALS, version)
        hits = fraud.blacklist_hits(batch, listed, "merchant_id").select(batch.columns)
        write(hits.withColumn("list_version", F.lit(version).cast("long")), batch_id)

    return jobs.start(records, match, checkpoint, interval)


def strike_counts(
    decided: DataFrame,
    path: str,
    checkpoint: str,
    strikes: int = fraud.STRIKES,
    interval: str | None = None,
) -> StreamingQuery:
    """Terminals reaching ``strikes`` suspicious records over a stream of decisions.

    The state is one counter per merchant with a suspicious record.
    """
    return jobs.start(
        fraud.pos_blacklist(decided, strikes), jobs.into_batches(path), checkpoint, interval, "update"
    )
