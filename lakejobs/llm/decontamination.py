"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item meet if they share a seed of a few tokens. Their longest
common token runs are then marked, longest first and without overlap, by Karp-Rabin
hashing; the share of the item's tokens under such tiles is its coverage. Tiles may come
in any order, so passages with rearranged sentences are found too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import share_package

WORDS = re.compile(r"\w+")
BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Settings:
    """``least``: tokens of a seed and of the shortest tile. ``coverage``: share that counts.

    ``block_tokens``: tokens of benchmark items sent to the workers at once; a benchmark
    with more is searched in several passes.
    """

    least: int = 5
    coverage: float = 0.8
    block_tokens: int = 1_000_000


def tokens(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` values (wrapping at 64 bits)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Doubling: the hash of 2k values comes from two hashes of k values.
    out, have = None, 0
    step, width, power = values, 1, BASE
    while have < size:
        if size & width:
            if out is None:
                out = step
            else:
                m = len(values) - have - width + 1
                out = out[:m] * np.uint64(power) + step[have:][:m]
            have += width
        step = step[:-width] * np.uint64(power) + step[width:]
        power, width = power * power % 2**64, width * 2
    return out[:n]


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (doc start, item start, length) of two arrays of token ids, longest first.

    In each turn the longest length with a match of unmarked tokens is found by bisection,
    since a longer match holds a shorter one; then its matches are marked from left to right.
    """
    in_doc, in_item = _mixed(doc), _mixed(item)
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    out: list[tuple[int, int, int]] = []

    def free(mask: np.ndarray, size: int) -> np.ndarray:
        taken = np.concatenate([[0], np.cumsum(~mask)])
        return np.flatnonzero(taken[size:] == taken[: len(taken) - size])

    def matches(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        d, i = free(free_doc, size), free(free_item, size)
        hd, hi = window_hashes(in_doc, size)[d], window_hashes(in_item, size)[i]
        hit = np.isin(hd, hi)
        return d[hit], hd[hit], i, hi

    longest = min(len(doc), len(item))
    while longest >= least:
        low, high = least - 1, longest
        while low < high:
            mid = (low + high + 1) // 2
            if len(matches(mid)[0]):
                low = mid
            else:
                high = mid - 1
        if low < least:
            break
        starts, hashes, places, place_hashes = matches(low)
        by_hash: dict[int, list[int]] = {}
        for at, h in zip(places.tolist(), place_hashes.tolist()):
            by_hash.setdefault(h, []).append(at)
        before, end = len(out), -1
        for d, h in zip(starts.tolist(), hashes.tolist()):
            if d < end:
                continue
            left = by_hash.get(h, [])
            while left:
                i = left[0]
                if not free_item[i : i + low].all():
                    left.pop(0)
                    continue
                if (doc[d : d + low] == item[i : i + low]).all():
                    free_doc[d : d + low] = free_item[i : i + low] = False
                    out.append((d, i, low))
                    end = d + low
                break
        # Nothing to mark at this length (all equal hashes were chance): go one shorter.
        longest = low if len(out) > before else low - 1
    return out


class Block:
    """Benchmark items with an index of their seeds; a worker searches texts in it."""

    def __init__(self, items: list[tuple[int, list[str]]], settings: Settings):
        self.settings = settings
        vocabulary: dict[str, int] = {}
        self.ids = [item for item, _ in items]
        self.items = [
            np.array([vocabulary.setdefault(t, len(vocabulary) + 1) for t in found], np.int64)
            for _, found in items
        ]
        self.vocabulary = vocabulary
        hashes = [window_hashes(_mixed(x), settings.least) for x in self.items]
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, int)])
        flat = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner, self.place = flat[order], owner[order], place[order]

    def search(self, text: str | None) -> Iterator[tuple[int, float, int, int]]:
        """(item id, coverage, tiles, longest tile) of every item covered well enough."""
        least = self.settings.least
        get = self.vocabulary.get
        doc = np.array([get(t, 0) for t in tokens(text)], np.int64)
        if len(doc) < least or not len(self.seeds):
            return
        unknown = np.concatenate([[0], np.cumsum(doc == 0)])
        at = np.flatnonzero(unknown[least:] == unknown[:-least])
        if not len(at):
            return
        hashes = np.unique(window_hashes(_mixed(doc), least)[at])
        first = np.searchsorted(self.seeds, hashes, "left")
        last = np.searchsorted(self.seeds, hashes, "right")
        rows = [np.arange(a, b) for a, b in zip(first[last > first], last[last > first])]
        if not rows:
            return
        rows = np.concatenate(rows)
        for number in np.unique(self.owner[rows]):
            item = self.items[number]
            # No tile covers a token that no shared seed covers.
            under = np.zeros(len(item) + 1, int)
            places = self.place[rows[self.owner[rows] == number]]
            np.add.at(under, places, 1)
            np.add.at(under, places + least, -1)
            if (np.cumsum(under)[:-1] > 0).sum() < self.settings.coverage * len(item):
                continue
            found = tile(doc, item, least)
            covered = sum(t[2] for t in found) / len(item)
            if covered >= self.settings.coverage:
                yield self.ids[number], covered, len(found), max(t[2] for t in found)


def blocks(
    benchmark: DataFrame, settings: Settings, id_col: str = "item_id", text_col: str = "text"
) -> Iterator[Block]:
    """The items in blocks of at most ``block_tokens`` (a longer item is a block of its own).

    Items of fewer than ``least`` tokens, and NULL ones, are left out: too short to tell.
    """
    rows: list[tuple[int, list[str]]] = []
    size = 0
    for item_id, text in benchmark.select(id_col, text_col).toLocalIterator():
        found = tokens(text)
        if len(found) < settings.least:
            continue
        if rows and size + len(found) > settings.block_tokens:
            yield Block(rows, settings)
            rows, size = [], 0
        rows.append((item_id, found))
        size += len(found)
    if rows:
        yield Block(rows, settings)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, item_id, coverage, n_tiles and longest_tile of every document and item
    with coverage ``settings.coverage`` or more.

    NULL, empty and short texts match nothing; repeated rows are each reported; other
    columns are not read. An empty benchmark gives no rows.
    """
    share_package(docs.sparkSession)
    own = docs.select(F.col(id_col), F.col(text_col))
    kind = own.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id long, coverage double, n_tiles int, longest_tile int"
    fields = ("item_id", "coverage", "n_tiles", "longest_tile")
    types = (pa.int64(), pa.float64(), pa.int32(), pa.int32())

    def pass_over(block: Block) -> DataFrame:
        handle = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for hit in handle.value.search(text):
                        rows.append(i)
                        found.append(hit)
                arrays = [batch.column(0).take(pa.array(rows, pa.int64()))]
                arrays += [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *fields])

        return own.mapInArrow(run, schema)

    passes = [pass_over(b) for b in blocks(benchmark, settings)]
    if not passes:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, passes)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: Settings = Settings(),
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs``, all columns, in which no benchmark item is covered."""
    share_package(docs.sparkSession)
    schema = docs.schema
    at = schema.fieldNames().index(text_col)

    def keep(docs: DataFrame, block: Block) -> DataFrame:
        handle = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            for batch in batches:
                texts = batch.column(at).to_pylist()
                ok = [next(handle.value.search(t), None) is None for t in texts]
                yield batch.filter(pa.array(ok, pa.bool_()))

        return docs.mapInArrow(run, schema)

    return reduce(keep, blocks(benchmark, settings), docs)
