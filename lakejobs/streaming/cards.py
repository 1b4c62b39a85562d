"""State per card, in the state store: its last records (cards by the bucket), and its first
strikes.

Rows meet their state already reduced by every task to the few that can matter, so a card
with a third of all records sends a few rows and not its records.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakejobs.plans import fraud

# What a card's next record needs to know of the ones before it.
MEMORY = ("card_id", *fraud.ORDER, "latitude", "longitude", "amount")
# Times in the state are microseconds.
FIELDS = ("at", *MEMORY[2:])
RECORD = "at long, txn_id string, latitude double, longitude double, amount double"
# Keys of the state, each with the records of the cards that are hashed to it.
BUCKETS = 1 << 12
STRIKE = "at long, txn_id string"


def few_per_card(rows: DataFrame, n: int, newest: bool) -> DataFrame:
    """At most ``n`` rows of a card out of each batch of rows a task gets, by time.

    Rows without a time go; ``at`` stands for ``ts``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cards = batch.sort_values(["at", "txn_id"]).groupby("card_id", sort=False, dropna=False)
            yield cards.tail(n) if newest else cards.head(n)

    # As whole numbers: pandas has no times after the year 2262.
    timed = rows.where(F.col("ts").isNotNull()).withColumn("at", F.unix_micros("ts")).drop("ts")
    return timed.mapInPandas(run, timed.schema)


class LastRecords(StatefulProcessor):
    """Keeps the last ``n`` records of the cards of a bucket, and for the cards that have new
    ones gives those of the time before.

    Of the new records only those after the last one known count; see ``fraud.split_late``.
    The records of a bucket are one value of the state, so a card costs no call of the state.
    """

    def __init__(self, n: int, keep_ms: int | None):
        self.n, self.keep_ms = n, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Records by card, in order of time.
        self.last = handle.getValueState("last", "cards binary")

    def _known(self) -> dict[str, list[tuple]]:
        value = self.last.get()
        return pickle.loads(bytes(value[0])) if value else {}

    def _expiry(self, records: list[tuple]) -> int:
        """When a card is to be forgotten."""
        return records[-1][0] // 1000 + self.keep_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[str, list[tuple]] = {}
        for frame in rows:
            for card, *record in zip(*(frame[c].tolist() for c in ("card_id", *FIELDS))):
                new.setdefault(card, []).append(tuple(record))
        known, told, changed = self._known(), [], False
        for card, records in new.items():
            before = known.get(card, [])
            told += [(card, *r) for r in before]
            latest = before[-1][:2] if before else None
            fresh = [r for r in records if latest is None or r[:2] > latest]
            if fresh:
                known[card] = sorted([*before, *fresh], key=lambda r: r[:2])[-self.n :]
                changed = True
        if changed:
            self._keep(known)
        if told:
            yield pd.DataFrame(told, columns=["card_id", *FIELDS])

    def _keep(self, known: dict[str, list[tuple]]) -> None:
        self.last.update((pickle.dumps(known, protocol=5),))
        if self.keep_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(min(self._expiry(records) for records in known.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        left = {card: records for card, records in self._known().items() if self._expiry(records) > past}
        if left:
            self._keep(left)
        else:
            self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def recalled(
    records: DataFrame, n: int = fraud.RECENT, forget_after_days: float | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """For the cards of each micro-batch, the last ``n`` records of the micro-batches before.

    ``forget_after_days`` bounds the state: a card is forgotten when the newest record of
    the stream is so much later than its own. Cards are hashed to ``buckets``, each one
    key of the state; the number cannot change later on. A micro-batch reads and writes the
    buckets of its cards, so with more cards than some thousand to a bucket give it more.
    """
    keep = None if forget_after_days is None else int(forget_after_days * 86_400_000)
    own = records.select(*MEMORY).where(F.col("card_id").isNotNull())
    if keep is not None:
        own = own.withWatermark("ts", "0 seconds")
    found = (
        few_per_card(own, n, newest=True)
        .withColumn("bucket", F.pmod(F.xxhash64("card_id"), F.lit(buckets)))
        .groupBy("bucket")
        .transformWithStateInPandas(
            LastRecords(n, keep), f"card_id string, {RECORD}", "Append", "None" if keep is None else "EventTime"
        )
    )
    return found.withColumn("ts", F.timestamp_micros("at")).select(*MEMORY)


class FirstStrikes(StatefulProcessor):
    """Keeps the first ``strikes`` suspicious records of a card by their own time, and tells
    the last of them once, when the watermark says that no earlier one will come."""

    def __init__(self, strikes: int):
        self.strikes = strikes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getListState("first", STRIKE)
        self.told = handle.getValueState("told", "told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] is None or self.told.exists():
            return
        before = [tuple(r) for r in self.first.get()]
        now = sorted({*before, *((r["at"], r["txn_id"]) for r in rows)})[: self.strikes]
        if now == before:
            return
        self.first.put(now)
        if len(now) == self.strikes:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # The first full millisecond after the strike.
            self.handle.registerTimer(now[-1][0] // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first = sorted(tuple(r) for r in self.first.get())
        self.told.update((True,))
        self.first.clear()
        yield Row(card_id=key[0], at=first[-1][0])

    def close(self) -> None:
        pass


def lost(decided: DataFrame, lateness: str, strikes: int = fraud.STRIKES) -> DataFrame:
    """Cards at their ``strikes``-th suspicious record, whatever order the records came in.

    A card is told once, when records up to that one can no longer be late. Rows without a
    card only move the time on: a source that falls silent has to send such heartbeats
    (``status`` suspicious), or the last cards are never told.
    """
    suspicious = decided.where(F.col("status") == fraud.SUSPICIOUS).select("card_id", *fraud.ORDER)
    few = few_per_card(suspicious.withWatermark("ts", lateness), strikes, newest=False)
    found = few.groupBy("card_id").transformWithState(
        FirstStrikes(strikes), "card_id string, at long", "Append", "EventTime"
    )
    return found.select("card_id", F.timestamp_micros("at").alias("lost_date"))
