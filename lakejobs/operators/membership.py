"""Semi-join with a list that is too large to broadcast, behind a bit filter of bounded size.

The filter is a table of blocks of 32,768 bits. A key has one block and four bits in it,
all from its hash. Rows whose bits are not all set cannot be in the list and go before the
shuffle; the exact semi-join sees the others. A filter too small for its list lets more rows
through, and costs time, not rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 512 words of 64 bits; a place in a block takes 15 bits of a hash.
WORDS, WORD_BITS, PLACE_BITS = 512, 64, 15
BLOCK_BITS = WORDS * WORD_BITS
PLACES = 4
BITS_PER_KEY = 12
# 64 MB, which is right for about 45 million keys.
MAX_BYTES = 64 * 1024 * 1024


def blocks_for(n_keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Blocks of a filter for so many keys; ``max_bytes`` bounds them."""
    return max(1, min(-(-n_keys * BITS_PER_KEY // BLOCK_BITS), max_bytes * 8 // BLOCK_BITS))


def _block(key: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("_block")


def _places(key: str) -> list[Column]:
    spread = F.xxhash64(F.lit(1), F.col(key))
    mask = F.lit(BLOCK_BITS - 1).cast("long")
    return [F.shiftrightunsigned(spread, PLACE_BITS * i).bitwiseAND(mask) for i in range(PLACES)]


def key_filter(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``_block`` and ``_words``, an array of 512 words, of all blocks; NULL keys set no bit."""
    spark = keys.sparkSession
    set_bits = keys.where(F.col(key).isNotNull()).select(
        _block(key, n_blocks), F.explode(F.array(*_places(key))).alias("_place")
    )
    bits = set_bits.select(
        "_block",
        F.expr(f"_place div {WORD_BITS}").alias("_word"),
        F.expr(f"shiftleft(1L, cast(_place % {WORD_BITS} as int))").alias("_bits"),
    )
    blank = spark.range(n_blocks * WORDS).select(
        F.expr(f"id div {WORDS}").alias("_block"), (F.col("id") % WORDS).alias("_word"), F.lit(0).cast("long").alias("_bits")
    )
    # Dealt by block once, for both aggregates.
    words = bits.unionByName(blank).repartition("_block").groupBy("_block", "_word").agg(F.bit_or("_bits").alias("_bits"))
    in_order = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    return words.groupBy("_block").agg(in_order.getField("_bits").alias("_words"))


def may_hold(key: str) -> Column:
    """Whether the block joined to a row has all bits of its key."""

    def is_set(place: Column) -> Column:
        word = F.get("_words", F.shiftright(place, WORD_BITS.bit_length() - 1).cast("int"))
        return F.getbit(word, (place % WORD_BITS).cast("int")) == 1

    return reduce(and_, [is_set(p) for p in _places(key)])


def _met(rows: DataFrame, keys: DataFrame, key: str, max_bytes: int) -> DataFrame:
    """Rows with ``_hit``, their key if it may be in the list; the others are gone."""
    n_blocks = blocks_for(keys.where(F.col(key).isNotNull()).count(), max_bytes)
    # Never more than ``max_bytes``, whatever the list.
    filtered = F.broadcast(key_filter(keys, key, n_blocks))
    met = rows.where(F.col(key).isNotNull()).withColumn("_block", _block(key, n_blocks)).join(filtered, "_block")
    return met.withColumn("_hit", F.when(may_hold(key), F.col(key))).where("_hit is not null")


def passing(rows: DataFrame, keys: DataFrame, key: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows whose ``key`` may be among ``keys``: all that are, and a few that are not."""
    return _met(rows, keys, key, max_bytes).select(*rows.columns)


def semi_join(rows: DataFrame, keys: DataFrame, key: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` whose ``key`` is in ``keys``, a list of any size.

    The list is read twice and counted first. ``key`` must have one type on both sides, as
    the hash of a number depends on its type; NULL is in no list.
    """
    kinds = rows.schema[key].dataType, keys.schema[key].dataType
    if kinds[0] != kinds[1]:
        raise TypeError(f"{key} is {kinds[0].simpleString()} in the rows, {kinds[1].simpleString()} in the list")
    # By a key made with the filter: on the plain one, Catalyst would join the list first.
    listed = keys.select(F.col(key).alias("_hit"))
    met = _met(rows, keys.select(key), key, max_bytes)
    return met.join(listed, "_hit", "left_semi").select(*rows.columns)
