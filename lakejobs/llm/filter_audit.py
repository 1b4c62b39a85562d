"""Filter interaction audit: what each of several filters removes in every order of them.

One pass of a table-driven byte transducer over the UTF-8 text counts words, capitals, code
points and symbols, and puts the spans of the words into a hash table that compares bytes
before it takes two words for one. Filters are conditions on these counts; copies of an
earlier text are found by a hash of the text. Which filters a document fails is a bit mask,
so all orders are worked out from the few masks of a part, not from documents.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import kept, map_texts

# Classes of bytes.
GAP, CAPITAL, SYMBOL, FIRST, INNER = range(5)
# States, and what the transducer puts out on a byte.
OUTSIDE, INSIDE = 0, 1
WORD_STARTS, WORD_ENDS, IS_CAPITAL, IS_SYMBOL, IS_INNER = 1, 2, 4, 8, 16

CLASSES = np.full(256, FIRST, np.uint8)
CLASSES[0x80:0xC0] = INNER
CLASSES[[0x20, *range(0x09, 0x0E)]] = GAP
CLASSES[ord("A") : ord("Z") + 1] = CAPITAL
CLASSES[list(b"#$%&*|")] = SYMBOL
# By state and class. The next state hangs on the class alone, so a whole buffer is run by
# looking up every byte with the state that the byte before it leads to.
NEXT = np.array([[OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
PUTS = np.array(
    [
        [0, WORD_STARTS | IS_CAPITAL, WORD_STARTS | IS_SYMBOL, WORD_STARTS, WORD_STARTS | IS_INNER],
        [WORD_ENDS, IS_CAPITAL, IS_SYMBOL, 0, IS_INNER],
    ],
    np.uint8,
)

# Texts are run in buffers of about so many bytes, a longer one alone.
BUFFER = 1 << 20
# Longer words are hashed and compared as bytes, the others eight bytes at a time.
LONG = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def transduce(data: np.ndarray) -> np.ndarray:
    """What the transducer puts out on each byte, started outside a word."""
    found = CLASSES[data]
    states = np.empty(len(data), np.uint8)
    states[:1] = OUTSIDE
    np.take(NEXT[OUTSIDE], found[:-1], out=states[1:])
    return PUTS.ravel()[states * np.uint8(PUTS.shape[1]) + found]


class Spans:
    """Words of a buffer as spans of bytes, with the text each is in."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, texts: np.ndarray):
        self.data, self.starts, self.texts = data, starts, texts
        self.sizes = ends - starts
        padded = data + bytes(8)
        self.eights = np.ndarray((len(data),), "<u8", buffer=padded, strides=(1,))
        self.hashes = self._hashes()

    def _eight(self, words: np.ndarray, at: int) -> np.ndarray:
        left = np.minimum(self.sizes[words] - at, 8)
        return self.eights[self.starts[words] + at] & _MASKS[left]

    def _bytes(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.starts[word] + self.sizes[word]]

    def _hashes(self) -> np.ndarray:
        h = self.texts.astype(np.uint64) * _MIX + self.sizes.astype(np.uint64)
        words, at = np.arange(len(h)), 0
        while len(words) and at < LONG:
            mixed = (h[words] ^ self._eight(words, at)) * _MIX
            h[words] = mixed ^ (mixed >> np.uint64(29))
            at += 8
            words = words[self.sizes[words] > at]
        for word in words:
            h[word] ^= np.uint64(hash(self._bytes(word)) & 0xFFFFFFFFFFFFFFFF)
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` and ``b`` are of one text and equal byte by byte."""
        equal = (self.hashes[a] == self.hashes[b]) & (self.texts[a] == self.texts[b])
        equal &= self.sizes[a] == self.sizes[b]
        left, at = np.flatnonzero(equal), 0
        while len(left) and at < LONG:
            equal[left] = self._eight(a[left], at) == self._eight(b[left], at)
            at += 8
            left = left[equal[left] & (self.sizes[a[left]] > at)]
        for i in left:
            equal[i] = self._bytes(a[i]) == self._bytes(b[i])
        return equal

    def first_ones(self) -> np.ndarray:
        """The words that take a slot of the hash table: one of each distinct word of a text."""
        n = len(self.starts)
        room = 1 << max(4, (2 * n).bit_length())
        slots = np.full(room, -1, np.int64)
        place = (self.hashes >> np.uint64(7)).astype(np.int64) & (room - 1)
        pending, winners = np.arange(n), []
        while len(pending):
            at = place[pending]
            free = slots[at] < 0
            slots[at[free]] = pending[free]
            holder = slots[at]
            winners.append(pending[holder == pending])
            # A slot held by another word: on to the next one.
            pending = pending[~self.same(pending, holder)]
            place[pending] = (place[pending] + 1) & (room - 1)
        return np.concatenate(winners) if winners else np.arange(0)


def _buffers(texts: list[bytes]):
    """Runs of texts of about BUFFER bytes together."""
    batch, size = [], 0
    for text in texts:
        if batch and size + len(text) > BUFFER:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def counts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """MEASURES of each text. Memory is a small multiple of BUFFER or of the longest text."""
    out = []
    for batch in _buffers([(t or "").encode("utf-8", "surrogatepass") for t in texts]):
        # A blank behind every text ends its last word.
        data = b" ".join(batch) + b" "
        sizes = np.array([len(t) for t in batch], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        puts = transduce(np.frombuffer(data, np.uint8))
        per_text = lambda mask: np.diff(np.searchsorted(np.flatnonzero(puts & mask), bounds))  # noqa: B023, E731
        starts, ends = np.flatnonzero(puts & WORD_STARTS), np.flatnonzero(puts & WORD_ENDS)
        owners = np.searchsorted(bounds, starts, side="right") - 1
        firsts = Spans(data, starts, ends, owners).first_ones()
        out.append(
            [
                np.bincount(owners, minlength=len(batch)),
                np.bincount(owners[firsts], minlength=len(batch)),
                per_text(IS_CAPITAL),
                sizes - per_text(IS_INNER),
                per_text(IS_SYMBOL),
            ]
        )
    joined = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
    return {name: c.astype(np.int64) for name, c in zip(MEASURES, joined)}


# Letter to the condition on MEASURES under which a document fails the filter; COPY fails
# documents whose text a smaller id has as well.
COPY = "copy"
FILTERS: dict[str, Callable[[], Column] | str] = {
    "A": lambda: F.col("n_words") < 50,
    "B": lambda: 100 * F.col("n_distinct") < 65 * F.col("n_words"),
    "C": lambda: 100 * F.col("n_capitals") > 5 * F.col("n_points"),
    "D": lambda: F.col("n_symbols") > 0,
    "E": COPY,
}


def failures(
    docs: DataFrame,
    filters: dict[str, Callable[[], Column] | str] = FILTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``id``, ``part``, ``failing`` and ``n``: rows by id, part and bit mask of the filters
    they fail; bit 0 is the first filter.

    Repeated rows are counted in ``n``, and none of them is a copy of the other. A NULL
    text is empty, a NULL part the empty string. A row without an id is no copy and no
    text is a copy of it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("hash"),
        text.alias("text"),
    )
    schema = ", ".join(f"{m} long" for m in MEASURES)
    measured = map_texts(rows, ["id", "part", "hash"], "text", schema, counts)
    mask = F.lit(0)
    for bit, condition in enumerate(filters.values()):
        if condition != COPY:
            mask = mask + F.when(condition(), 1 << bit).otherwise(0)
    facts = kept(measured.select("id", "part", "hash", mask.alias("failing")), "audit-facts")
    counted = facts.groupBy("id", "part", "hash", "failing").agg(F.count(F.lit(1)).alias("n"))
    copy_bits = sum(1 << bit for bit, c in enumerate(filters.values()) if c == COPY)
    if not copy_bits:
        return counted.select("id", "part", "failing", "n")
    # Joined by hash and id, so that a text of very many documents is no hot key.
    first = facts.where("id is not null").groupBy("hash").agg(F.min("id").alias("id"))
    is_copy = F.col("id").isNotNull() & F.col("own").isNull()
    return counted.join(first.withColumn("own", F.lit(True)), ["hash", "id"], "left").select(
        "id", "part", (F.col("failing") + F.when(is_copy, copy_bits).otherwise(0)).alias("failing"), "n"
    )


def steps(letters: list[str]) -> Column:
    """Array of all steps of all orders: the order, the step's number, letter and bit, and
    the bits of the filters before it."""
    found = []
    for order in itertools.permutations(range(len(letters))):
        name = "".join(letters[i] for i in order)
        for at, i in enumerate(order):
            before = sum(1 << j for j in order[:at])
            found.append({"filter_order": name, "step": at + 1, "letter": letters[i], "bit": 1 << i, "before": before})
    schema = "array<struct<filter_order: string, step: int, letter: string, bit: int, before: int>>"
    return F.from_json(F.lit(json.dumps(found)), schema)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Callable[[], Column] | str] = FILTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    good_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """A row per part, order of the filters and step, with the documents of the part that the
    step keeps, removes (``removed``), finds removed already though its filter fails them
    (``redundant``), or alone among the filters fails (``unique_fails``); the removed ones
    labelled good and toxic; and ``shapley``, what its filter removes summed over all orders.

    See ``failures`` for NULLs and repeated rows. Of several labels of an id the largest
    counts, none at all is 0. Tables without rows give none. Up to six filters: there are
    as many orders as permutations, a fixed number of rows per part.
    """
    if not 1 <= len(filters) <= 6:
        raise ValueError("one to six filters")
    rows = kept(failures(docs, filters, id_col, text_col, part_col), "audit-rows")
    known = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(*[F.max((F.col(c) == 1).cast("int")).alias(n) for c, n in ((good_col, "good"), (toxic_col, "toxic"))])
    )
    # Rows without an id have no label; joined, they would be one hot key.
    nameless = rows.where("id is null").select("part", "failing", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    named = rows.where("id is not null").join(known, "id", "left").select(
        "part", "failing", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    )
    cells = (
        named.union(nameless)
        .groupBy("part", "failing")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(c)).alias(c) for c in ("good", "toxic")])
    )
    each = cells.select("part", "failing", "n", "good", "toxic", F.explode(steps(list(filters))).alias("s")).select(
        "part", "failing", "n", "good", "toxic", "s.*"
    )
    fails = F.col("failing").bitwiseAND(F.col("bit")) != 0
    gone = F.col("failing").bitwiseAND(F.col("before")) != 0
    total = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0))
    summed = each.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("failing") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return summed.withColumn("shapley", shapley).drop("letter")
