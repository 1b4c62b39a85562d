"""Card-fraud scoring, one decision per transaction.

Frames: ``txns`` (txn_id, card_id, user_id, merchant_id, amount, ts, …), ``geo``
(merchant_id, latitude, longitude), ``bureau`` (user_id, credit_score).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.functions.geo import distance_km, speed
from lakejobs.operators import membership, ordered
from lakejobs.operators.skew import DEFAULT, Hot, Skew, join_lookup, search
from lakejobs.schemas import REALTIME

# Fixed values of the rules.
MAX_SPEED = 13  # kilometres per minute
MIN_SCORE = 250
RECENT = 5  # transactions the spending limits look back on
K_UTL = 2
K_CTL = 5
STRIKES = 3
SUSPICIOUS, PENDING, APPROVED = "Suspicious", "Approval Pending", "Approved"

ORDER = ("ts", "txn_id")
CARD, USER = "card", "user"


def merchant_geo(zips: DataFrame, merchants: DataFrame) -> DataFrame:
    """Coordinates of every merchant, by postal code and country."""
    places = zips.select("postal_code", "country_code", "latitude", "longitude")
    shops = merchants.select("postal_code", "country_code", "merchant_id")
    return shops.join(places, ["postal_code", "country_code"]).select(
        "latitude", "longitude", "merchant_id"
    )


def place_per_merchant(geo: DataFrame) -> DataFrame:
    """One place per merchant (the lowest), so that a join with it repeats no transaction."""
    return (
        geo.groupBy("merchant_id")
        .agg(F.min(F.struct("latitude", "longitude")).alias("_p"))
        .select("merchant_id", "_p.latitude", "_p.longitude")
    )


Found = dict[str, Hot | None]


def _hot(txns: DataFrame, keys: Sequence[str], skew: Skew | None) -> Found:
    """The hot keys of all these columns, from one pass."""
    return search(txns, keys, ORDER, skew, "ts") if skew is not None else {}


def locate(
    txns: DataFrame,
    geo: DataFrame,
    skew: Skew | None = DEFAULT,
    source: DataFrame | None = None,
    found: Found | None = None,
) -> DataFrame:
    """Add the merchant's coordinates (NULL if unknown)."""
    places = place_per_merchant(geo)
    return join_lookup(txns, places, "merchant_id", ("txn_id",), skew, source, found)


def _located_by_card(
    txns: DataFrame, geo: DataFrame, skew: Skew | None, source: DataFrame, found: Found
) -> tuple[DataFrame, bool]:
    """``txns`` with places and chunks of their cards, and whether some card is cut."""
    cuts = ordered.find_cuts(source, "card_id", *ORDER, skew, found)
    chunked = ordered.assign_chunks(txns, "card_id", *ORDER, CARD, cuts)
    return locate(chunked, geo, skew, source, found), cuts is not None


def _last(columns: Sequence[str]) -> dict[str, Column]:
    w = ordered.timeline("card_id", ORDER, CARD)
    return {f"last_{c}": ordered.known("card_id", ORDER, F.lag(c).over(w)) for c in columns}


def _with_last(located: DataFrame, carry: Sequence[str], cut: bool) -> DataFrame:
    """Add ``last_<column>`` of the same card's previous transaction."""
    ready = ordered.with_preceding(located, "card_id", ORDER, 1, carry, CARD, cut=cut)
    return ordered.drop_preceding(ready.withColumns(_last((*ORDER, *carry))), CARD)


def _with_travel(df: DataFrame) -> DataFrame:
    """Add distance, minutes and speed since the previous transaction."""
    km = distance_km(*[F.col(c) for c in ("last_latitude", "last_longitude", "latitude", "longitude")])
    seconds = (F.unix_micros("ts") - F.unix_micros("last_ts")) / 1e6
    return (
        df.withColumns({"distance": km, "minutes": seconds / 60})
        .withColumn("speed", speed(F.col("distance"), F.col("minutes")))
    )


def last_transaction(
    txns: DataFrame, geo: DataFrame, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Every transaction with the one before it on the same card, and both places."""
    found = _hot(txns, ("card_id", "merchant_id"), skew)
    located, cut = _located_by_card(txns, geo, skew, txns, found)
    return _with_last(located, ("merchant_id", "latitude", "longitude"), cut).select(
        "txn_id", "card_id", "ts", "merchant_id", "latitude", "longitude",
        "last_txn_id", "last_ts", "last_merchant_id", "last_latitude", "last_longitude",
    )


def distance_over_time(
    txns: DataFrame, geo: DataFrame, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Distance, elapsed minutes and speed since the card's previous transaction."""
    found = _hot(txns, ("card_id", "merchant_id"), skew)
    located, cut = _located_by_card(txns, geo, skew, txns, found)
    return _with_travel(_with_last(located, ("latitude", "longitude"), cut)).select(
        "txn_id", "card_id", "ts", "distance", "minutes", "speed"
    )


def low_score(txns: DataFrame, bureau: DataFrame, limit: int = MIN_SCORE) -> DataFrame:
    """Transactions of users whose credit score is below ``limit``."""
    poor = bureau.where(F.col("credit_score") < limit).select("user_id", "credit_score")
    return txns.join(poor, "user_id").select("txn_id", "user_id", "credit_score")


def _usual(key: str, prefix: str, n: int) -> Column:
    """Deviation plus mean of the key's ``n`` amounts before; NULL until there are 2."""
    over = ordered.timeline(key, ORDER, prefix).rowsBetween(-n, -1)
    usual = F.stddev_samp("amount").over(over) + F.avg("amount").over(over)
    return ordered.known(key, ORDER, usual)


def _with_limits(df: DataFrame, k_utl: int, k_ctl: int) -> DataFrame:
    """Turn ``_usual`` into the limits ``utl`` and ``ctl``."""
    usual = F.col("_usual")
    return df.withColumns({"utl": k_utl * usual, "ctl": k_ctl * usual}).drop("_usual")


def amount_limits(
    txns: DataFrame,
    n: int = RECENT,
    k_utl: int = K_UTL,
    k_ctl: int = K_CTL,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Each transaction's amount against the limits set by the user's last ``n``."""
    cuts = ordered.find_cuts(txns, "user_id", *ORDER, skew)
    chunked = ordered.assign_chunks(txns, "user_id", *ORDER, USER, cuts)
    cut = cuts is not None
    ready = ordered.with_preceding(chunked, "user_id", ORDER, n, ("amount",), USER, cut=cut)
    limited = _with_limits(ready.withColumn("_usual", _usual("user_id", USER, n)), k_utl, k_ctl)
    return ordered.drop_preceding(limited, USER).select("txn_id", "user_id", "amount", "utl", "ctl")


def parse_stream(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Point-of-sale text records as typed columns, and all other records with the reason.

    A record has no id of its own; its description tells those of one second apart. One
    without a card, amount, time or description cannot be decided and is ``incomplete``.
    """
    fields = "_corrupt_record STRING, " + REALTIME.simpleString()[7:-1].replace(":", " ")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    record = F.col(column)
    parsed = lines.select(record.alias("_record"), F.from_csv(record, fields, options).alias("_r"))
    needed = [F.col(f"_r.{c}").isNull() for c in ("cardId", "amt", "timestamp", "transDesc")]
    broken = F.col("_record").isNotNull() & F.col("_r._corrupt_record").isNotNull()
    missing = F.col("_r").isNull() | needed[0] | needed[1] | needed[2] | needed[3]
    parsed = parsed.withColumn(
        "_reason", F.when(broken, "malformed").when(missing, "incomplete")
    )
    records = parsed.where(F.col("_reason").isNull()).select(
        F.col("_r.cardId").alias("card_id"),
        F.col("_r.merchantId").alias("merchant_id"),
        F.col("_r.amt").alias("amount"),
        F.timestamp_seconds("_r.timestamp").alias("ts"),
        F.col("_r.type").alias("type"),
        F.col("_r.transDesc").alias("txn_id"),
        F.col("_r.latitude").alias("latitude"),
        F.col("_r.longitude").alias("longitude"),
    )
    rejected = parsed.where(F.col("_reason").isNotNull()).select(
        F.col("_record").alias("record"), F.col("_reason").alias("reject_reason")
    )
    return records, rejected


def verdict(too_fast: Column, low: Column, amount: Column, utl: Column, ctl: Column) -> Column:
    """Exactly one status; a rule whose inputs are unknown does not fire."""

    def fires(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return (
        F.when(fires(too_fast) | fires(low) | fires(amount > ctl), SUSPICIOUS)
        .when(fires(amount > utl), PENDING)
        .otherwise(APPROVED)
    )


def _per_chunk(
    scores: DataFrame, cuts: ordered.Cuts | None, key: str, chunk: str
) -> DataFrame:
    """The lowest score of every key, once for each chunk the key is cut into.

    Joined on (key, chunk) it needs no move of the rows: they are there already, for
    the window before it.
    """
    lowest = scores.groupBy(key).agg(F.min("credit_score").alias("credit_score"))
    first = F.lit(0).cast("long")
    if cuts is None:
        return lowest.withColumn(chunk, first)
    ids = ordered.chunk_ids(cuts, key, chunk)
    return lowest.join(ids, key, "left").withColumn(chunk, F.coalesce(chunk, first))


def _status(dot: float, min_score: int) -> Column:
    return verdict(
        F.col("speed") > dot,
        F.col("credit_score") < min_score,
        F.col("amount"),
        F.col("utl"),
        F.col("ctl"),
    )


def decide(
    txns: DataFrame,
    geo: DataFrame,
    bureau: DataFrame,
    dot: float = MAX_SPEED,
    min_score: int = MIN_SCORE,
    n: int = RECENT,
    k_utl: int = K_UTL,
    k_ctl: int = K_CTL,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Add speed, credit_score, utl, ctl and ``status`` to every transaction.

    Two shuffles of the transactions: one by card for the previous place, one by user
    for the recent amounts and the score.
    """
    found = _hot(txns, ("user_id", "card_id", "merchant_id"), skew)
    cuts = ordered.find_cuts(txns, "user_id", *ORDER, skew, found)
    by_user = ordered.assign_chunks(txns, "user_id", *ORDER, USER, cuts)
    located, cut = _located_by_card(by_user, geo, skew, txns, found)
    travelled = _with_travel(_with_last(located, ("latitude", "longitude"), cut))
    # The copies come from the transactions themselves, before any join.
    ready = ordered.with_preceding(
        travelled, "user_id", ORDER, n, ("amount",), USER, by_user, cuts is not None
    )
    seen = ready.withColumn("_usual", _usual("user_id", USER, n)).where(~F.col("_copy"))
    limited = _with_limits(seen, k_utl, k_ctl)
    chunk = f"{USER}_chunk"
    scores = _per_chunk(bureau, cuts, "user_id", chunk)
    decided = limited.join(scores, ["user_id", chunk], "left")
    return ordered.drop_preceding(decided, USER).withColumn("status", _status(dot, min_score))


def decide_by_card(
    records: DataFrame,
    scores: DataFrame,
    dot: float = MAX_SPEED,
    min_score: int = MIN_SCORE,
    n: int = RECENT,
    k_utl: int = K_UTL,
    k_ctl: int = K_CTL,
    skew: Skew | None = DEFAULT,
    found: Found | None = None,
) -> DataFrame:
    """The same decision where only the card is known, and records carry their place.

    One shuffle by card serves the previous place, the recent amounts and the score.
    ``scores`` is (card_id, credit_score); ``found`` may hold the hot cards.
    """
    cuts = ordered.find_cuts(records, "card_id", *ORDER, skew, found)
    by_card = ordered.assign_chunks(records, "card_id", *ORDER, CARD, cuts)
    carry = ("latitude", "longitude", "amount")
    ready = ordered.with_preceding(by_card, "card_id", ORDER, n, carry, CARD, cut=cuts is not None)
    looks_back = _last((*ORDER, "latitude", "longitude")) | {"_usual": _usual("card_id", CARD, n)}
    seen = ready.withColumns(looks_back).where(~F.col("_copy"))
    chunk = f"{CARD}_chunk"
    limited = _with_limits(seen, k_utl, k_ctl)
    scored = limited.join(_per_chunk(scores, cuts, "card_id", chunk), ["card_id", chunk], "left")
    return ordered.drop_preceding(_with_travel(scored), CARD).withColumn(
        "status", _status(dot, min_score)
    )


def pos_blacklist(decided: DataFrame, strikes: int = STRIKES) -> DataFrame:
    """Merchants with at least ``strikes`` suspicious transactions."""
    return (
        decided.where(F.col("status") == SUSPICIOUS)
        .groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("strikes"))
        .where(F.col("strikes") >= strikes)
    )


def lost_cards(decided: DataFrame, strikes: int = STRIKES) -> DataFrame:
    """Cards reported lost at their ``strikes``-th suspicious transaction.

    The rank filter runs in every task before the shuffle, so a card sends no more than
    ``strikes`` rows from each.
    """
    in_order = Window.partitionBy("card_id").orderBy(*ORDER)
    return (
        decided.where((F.col("status") == SUSPICIOUS) & F.col("card_id").isNotNull())
        .select("card_id", *ORDER)
        .withColumn("_strike", F.row_number().over(in_order))
        .where(F.col("_strike") == strikes)
        .select("card_id", F.col("ts").alias("lost_date"))
    )


def blacklist_hits(
    txns: DataFrame, blacklist: DataFrame, on: str, prefilter: bool = False
) -> DataFrame:
    """Transactions whose card (or merchant) is blacklisted.

    No hint: Catalyst broadcasts a list below its size threshold and AQE splits hot
    keys of a larger one. With ``prefilter``, for lists of millions, most other
    transactions go before the shuffle, see ``operators.membership``.
    """
    if prefilter:
        return membership.semi_join(txns, blacklist, on)
    return txns.join(blacklist.select(on), on, "left_semi")
