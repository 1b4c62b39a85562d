"""Exact Jaccard join of documents in the metric space of their shingle sets.

Two sets are linked when their Jaccard distance is a fifth or less. Pivots cut the space
into regions, in three steps:

1. Pivots that are single shingles. Their nearest sets are those that hold them; ties are
   broken by one global order of shingles, rare ones first. Sets within the threshold share
   at least k of their first n - ceil(0.8 n) + k shingles, so a set goes to the region of
   each of these, every link lies in k regions, and a set in fewer has none. (Documents alone do not work as
   pivots: nearly all pairs are at distance 1, so no window would exclude anything.)
2. One document per region as its pivot. Regions with the same pivot make up one cell, to
   which each of their sets goes once. Small cells are joined as they are.
3. Large cells are cut by their members' exact distance to the pivot into rings of the
   threshold's width. By the triangle inequality a set links only into its own and the
   neighbouring rings, so it is copied to the next one; those in the innermost ring are
   linked by the pivot already. Rings that are still large are cut once more, into blocks
   that meet in pairs of blocks, each pair a task of bounded size.

A task returns a spanning forest of the links it finds, never all pairs.

Sets are kept as 64-bit hashes of their shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import kept, share_package
from lakejobs.llm.components import components

SIZE = 5
# Tenths of the union that the intersection of linked sets makes up at least.
TENTHS = 8
MEMO_WORDS = 300_000
LIGHTEST = 250
# A linked set shares one shingle more of the prefix for every so many it has.
PART = 30
FACTOR, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
# Shingles of more sets than this are counted by matrix products, others pair by pair.
DENSE = 16


@dataclass(frozen=True)
class Settings:
    """``common``: shingles in more documents than this come last in the global order.

    ``most_common``: how many of these are told to the workers, the commonest first. Both
    and ``filter_bits``, the size of the filter of sets to fetch, cost time when they are
    wrong and never a link. ``cell``: shingles of all sets together that one task compares,
    where a set counts as LIGHTEST at least, which bounds the number of sets. ``crowd``: a
    shingle in the prefixes of more rows than this is dealt over tasks, without a search for
    the sets that may have a link.
    """

    common: int = 8
    most_common: int = 1_000_000
    filter_bits: int = 1 << 24
    cell: int = 500_000
    crowd: int = 500


class _Memo(dict):
    """Hashes of words, a bounded number of them remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


@lru_cache(maxsize=1)
def _memo() -> _Memo:
    return _Memo()


def _finish(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; empty without words."""
    if not text:
        return np.zeros(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    memo = _memo()
    if len(memo) > MEMO_WORDS:
        memo.clear()
    values = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(SIZE, len(values))
    n = len(values) - size + 1
    out = values[:n].copy()
    for k in range(1, size):
        out *= FACTOR
        out += values[k : n + k]
        out ^= out >> SHIFT
    # Shorter sequences are whole texts: apart from five-word shingles.
    out = _finish(out + np.uint64(size))
    out.sort()
    fresh = np.empty(n, bool)
    fresh[:1] = True
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out if fresh.all() else out[fresh]


def set_id(hashes: np.ndarray) -> int:
    """A number for a set, equal for equal sets."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def shared_least(n):
    """How many shingles of its prefix a set of n shares with a linked one that is no smaller."""
    return 1 + n // PART


def prefix_size(n: int) -> int:
    """How many of a set's first shingles hold ``shared_least`` ones of a linked larger set.

    The j-th shingle two sets share has at least (their intersection - j) places after it.
    """
    return n - (TENTHS * n + 9) // 10 + shared_least(n) if n else 0


def linked(common: int, n_a: int, n_b: int) -> bool:
    return 10 * common >= TENTHS * (n_a + n_b - common)


def _per_batch(
    docs: DataFrame, columns: list[str], schema: str, fn: Callable[[list, list], pa.RecordBatch]
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch.column(0), batch.column(1).to_pylist())

    share_package(docs.sparkSession)
    return docs.select(*columns).mapInArrow(run, schema)


def members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``set_id``, ``n`` and ``text_hash`` per row; set_id is NULL for an empty set."""
    share_package(docs.sparkSession)
    own = docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col))
    kind = own.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                names=[id_col, "text_hash", "set_id", "n"],
            )

    return own.mapInArrow(run, f"`{id_col}` {kind}, text_hash long, set_id long, n long")


def common_shingles(docs: DataFrame, text_col: str, settings: Settings) -> np.ndarray:
    """Sorted hashes of the commonest shingles, counted over all documents.

    Only the prefixes in the order of hashes are counted: others seldom come early.
    """

    def run(_, texts):
        sets = [shingles(t) for t in texts]
        parts = [s[: prefix_size(len(s))] for s in sets]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        found, n = np.unique(flat, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["s", "n"]
        )

    counts = _per_batch(docs, [text_col, text_col], "s long, n long", run)
    top = (
        counts.groupBy("s")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > settings.common)
        .orderBy(F.col("n").desc(), "s")
        .limit(settings.most_common)
        .select("s")
        .toArrow()
    )
    return np.sort(top.column("s").to_numpy().astype(np.int64).view(np.uint64))


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def ordered(hashes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set in the global order, and which of it are common."""
    last = _member(common, hashes)
    size = prefix_size(len(hashes))
    out = np.concatenate([hashes[~last], hashes[last]])[:size]
    return out, np.arange(size) >= (~last).sum()


def regions(
    docs: DataFrame, text_col: str, common: np.ndarray, settings: Settings = Settings()
) -> DataFrame:
    """``s``, ``set_id``, ``n``: the sets in each region that may have a link there.

    Rows of common and of crowded shingles are dealt over tasks and all kept; the others meet
    by shingle in sorted order, and stay if another one's size and place in the order allow a
    link. Copies in one batch give the rows of one.
    """
    handle = docs.sparkSession.sparkContext.broadcast(common)

    def run(_, texts):
        s, ids, n, pos, last, seen = [], [], [], [], [], set()
        for text in texts:
            found = shingles(text)
            if not len(found):
                continue
            own = set_id(found)
            if own in seen:
                continue
            seen.add(own)
            first, is_common = ordered(found, handle.value)
            s.append(first)
            ids.append(np.full(len(first), own, np.int64))
            n.append(np.full(len(first), len(found), np.int32))
            pos.append(np.arange(len(first), dtype=np.int32))
            last.append(is_common)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(join(s, np.uint64).view(np.int64)),
                pa.array(join(ids, np.int64)),
                pa.array(join(n, np.int32)),
                pa.array(join(pos, np.int32)),
                pa.array(join(last, bool)),
            ],
            names=["s", "set_id", "n", "pos", "common"],
        )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by s and set_id; a shingle's rows are worked on together."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            s = table.column("s").to_numpy()
            # The last shingle may go on in the next batch.
            cut = int(np.searchsorted(s, s[-1], "left"))
            held = table.slice(cut)
            yield from _several(table.slice(0, cut))
        if held is not None:
            yield from _several(held)

    rows = _per_batch(docs, [text_col, text_col], "s long, set_id long, n int, pos int, common boolean", run)
    rows = kept(rows, "prefixes")
    # What the order of hashes did not show as common may still be crowded in the order used.
    crowded = rows.where("not common").groupBy("s").agg(F.count(F.lit(1)).alias("rows"))
    crowded = kept(crowded.where(F.col("rows") > settings.crowd).select("s", F.lit(True).alias("crowded")), "crowded")
    rows = rows.join(crowded, "s", "left").select(
        "s", "set_id", "n", "pos", (F.col("common") | F.coalesce("crowded", F.lit(False))).alias("common")
    )
    spread = F.when(F.col("common"), F.pmod(F.xxhash64("set_id"), F.lit(64))).otherwise(0)
    dealt = rows.repartition("s", spread).sortWithinPartitions("s", "set_id")
    return dealt.mapInArrow(shared, rows.schema)


def _several(table: pa.Table) -> list[pa.RecordBatch]:
    if not table.num_rows:
        return []
    s, ids = table.column("s").to_numpy(), table.column("set_id").to_numpy()
    table = table.filter(pa.array(np.concatenate([[True], (s[1:] != s[:-1]) | (ids[1:] != ids[:-1])])))
    s, n = table.column("s").to_numpy(), table.column("n").to_numpy().astype(np.int64)
    keep = _possible(s, n, table.column("pos").to_numpy()) | table.column("common").to_numpy()
    return table.filter(pa.array(keep)).to_batches()


def _possible(s: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which rows have another one of their shingle that they may be linked with.

    If s is among the first ``shared_least`` shingles two sets share, they share no more than
    those and what either has from there.
    """
    order = np.lexsort((n, s))
    s, n, left = s[order], n[order], (n - pos)[order]
    ok = np.zeros(len(s), bool)
    at, step = np.arange(len(s) - 1), 1
    while len(at):
        to = at + step
        # By size within a shingle: once the other is too large, so are all after it.
        near = (s[at] == s[to]) & (10 * n[at] >= TENTHS * n[to])
        at, to = at[near], to[near]
        most = np.minimum(left[at], left[to]) + shared_least(n[to]) - 1
        reach = (10 + TENTHS) * most >= TENTHS * (n[at] + n[to])
        ok[at[reach]] = ok[to[reach]] = True
        step += 1
        at = at[at + step < len(s)]
    out = np.empty(len(s), bool)
    out[order] = ok
    return out


def fetched(docs: DataFrame, wanted: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``set_id`` and ``hashes`` (bytes) of the documents whose text hash is in ``wanted``.

    A filter of fixed size lets through all wanted texts and few others, so that no text is
    shuffled; the filter only saves work. Copies give one row.
    """
    bits = settings.filter_bits
    places = F.explode(F.array(*[F.pmod(F.xxhash64(F.col("text_hash"), F.lit(i)), F.lit(bits)) for i in range(3)]))
    words = (
        wanted.select(places.alias("p"))
        .groupBy(F.expr("p div 32").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 as int)))").alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    handle = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for i in range(3):
                p = batch.column(1 + i).to_numpy()
                ok &= (handle.value[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1
            texts = batch.column(0).filter(pa.array(ok)).to_pylist()
            sets = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["set_id", "hashes"],
            )

    share_package(docs.sparkSession)
    hashed = docs.where(F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("__text"), F.xxhash64(text_col).alias("__h")
    )
    marked = hashed.select(
        "__text", *[F.pmod(F.xxhash64("__h", F.lit(i)), F.lit(bits)).alias(f"__p{i}") for i in range(3)]
    )
    return marked.mapInArrow(run, "set_id long, hashes binary").dropDuplicates(["set_id"])


def forest(sets: list[np.ndarray], block: np.ndarray, mixed: bool) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of places, of the links among ``sets``.

    With ``mixed``, only links between different blocks count.
    """
    k = len(sets)
    if k < 2:
        return []
    n = np.array([len(x) for x in sets])
    common = _intersections(sets, n)
    link = 10 * common >= TENTHS * (n[:, None] + n[None, :] - common)
    if mixed:
        link &= block[:, None] != block[None, :]
    out, fresh = [], np.ones(k, bool)
    for root in range(k):
        if not fresh[root]:
            continue
        fresh[root] = False
        wave = [root]
        while wave:
            at = wave.pop()
            found = np.flatnonzero(link[at] & fresh)
            fresh[found] = False
            out += [(at, int(x)) for x in found]
            wave += found.tolist()
    return out


def _intersections(sets: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """Intersection sizes of every two of ``sets``."""
    k = len(sets)
    owner = np.repeat(np.arange(k), n)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rare = (times[column] > 1) & (times[column] <= DENSE)
    o, c, common = owner[rare], column[rare], np.zeros(k * k, np.int64)
    for step in range(1, DENSE):
        same = np.flatnonzero(c[step:] == c[:-step])
        if not len(same):
            break
        common += np.bincount(o[same] * k + o[same + step], minlength=k * k)
    common = common.reshape(k, k)
    common = (common + common.T).astype(np.float32)
    often = times > DENSE
    o, c = owner[often[column]], (np.cumsum(often) - 1)[column[often[column]]]
    width = 4096
    for start in range(0, int(often.sum()), width):
        here = (c >= start) & (c < start + width)
        part = np.zeros((k, min(width, int(often.sum()) - start)), np.float32)
        part[o[here], c[here] - start] = 1
        common += part @ part.T
    return common


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``keys`` together, from batches sorted by these."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        columns = [table.column(c).to_numpy() for c in keys]
        new = np.zeros(table.num_rows - 1, bool)
        for c in columns:
            new |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        held = table.slice(starts[-1])
    if held is not None:
        yield held


def joined_cells(rows: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that span those within each (cell, ring, i, j).

    ``rows``: cell, ring, i, j, block, set_id, hashes. Where i differs from j the blocks are
    compared with each other only.
    """
    keys = ["cell", "ring", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            ids = table.column("set_id").to_numpy()
            first = np.unique(ids, return_index=True)[1]
            if len(first) < 2:
                continue
            ids, table = ids[first], table.take(pa.array(first))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
            block = table.column("block").to_numpy()
            mixed = table.column("i")[0].as_py() != table.column("j")[0].as_py()
            found = forest(sets, block, mixed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[[x for x, _ in found]], pa.int64()),
                    pa.array(ids[[y for _, y in found]], pa.int64()),
                ],
                names=["a", "b"],
            )

    sent = rows.repartition(*keys).sortWithinPartitions(*keys)
    return sent.mapInArrow(run, "a long, b long")


def cell_rows(
    cells: DataFrame, fetch: Callable[[DataFrame], DataFrame], settings: Settings
) -> DataFrame:
    """Rows for ``joined_cells``: small cells whole, large ones by ring and block.

    ``cells``: cell (the pivot's set id), set_id, n. ``fetch`` gives set_id and hashes of the
    sets in some cells.
    """
    zero = F.lit(0)

    def whole(cells: DataFrame) -> DataFrame:
        one = [zero.alias(c) for c in ("ring", "i", "j", "block")]
        return cells.join(fetch(cells), "set_id").select("cell", *one, "set_id", "hashes")

    weight = cells.groupBy("cell").agg(F.sum(F.greatest("n", F.lit(LIGHTEST))).alias("weight"))
    large = kept(weight.where(F.col("weight") > settings.cell), "large-cells")
    if not large.limit(1).count():
        return whole(cells)
    cells = kept(cells.join(large, "cell", "left"), "cells")
    wide = cells.where("weight is not null").select("cell", "set_id", "n")
    sets = fetch(wide)
    pivots = wide.where("cell = set_id").select("cell", "set_id").join(sets, "set_id")
    pivots = pivots.select("cell", F.col("hashes").alias("pivot_hashes"))
    members = wide.join(sets, "set_id")
    ringed = kept(_rings(members.join(pivots, "cell")), "ringed-sets")
    # A set is at home in its ring and visits the one inside it.
    placed = ringed.select("*", F.explode(F.array(F.col("ring"), F.col("ring") - 1)).alias("at")).where("at >= 0")
    counts = kept(placed.groupBy("cell", "at").agg(F.ceil(F.sum(F.greatest("n", F.lit(LIGHTEST))) / settings.cell).cast("int").alias("g")), "ring-sizes")
    placed = placed.join(counts, ["cell", "at"])
    own = F.pmod(F.xxhash64("set_id"), F.col("g")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")
    blocks = placed.select("cell", F.col("at").alias("ring"), own.alias("block"), other, "set_id", "hashes")
    blocks = blocks.select(
        "cell", "ring", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "set_id", "hashes",
    )
    return whole(cells.where("weight is null").select("cell", "set_id")).union(blocks)


def _rings(rows: DataFrame) -> DataFrame:
    """``cell``, ``set_id``, ``n``, ``hashes`` and ``ring``: fifths of distance to the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                rings.append(10 * (union - common) // ((10 - TENTHS) * union))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(4)], pa.array(rings, pa.int32())],
                names=["cell", "set_id", "n", "hashes", "ring"],
            )

    own = rows.select("cell", "set_id", F.col("n").cast("int"), "hashes", "pivot_hashes")
    return own.mapInArrow(run, "cell long, set_id long, n int, hashes binary, ring int")


def jaccard_components(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, n_shingles and component_id, the smallest id reachable by links, per row.

    NULL, empty and wordless texts have no shingles and are linked with nothing: their
    component is their own id. Rows with a NULL id take part; ids of components are the
    smallest that are not NULL. Equal texts and repeated rows are in one component. Other
    columns are not read.
    """
    rows = kept(members(docs, id_col, text_col), "sets")
    # One document stands for each distinct set.
    first = kept(
        rows.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min(id_col).alias("id"), F.min("text_hash").alias("text_hash")),
        "distinct-sets",
    )
    region = kept(regions(docs, text_col, common_shingles(docs, text_col, settings), settings), "regions")
    # The smaller of two linked sets has eight tenths of the larger one's size or more.
    enough = F.count(F.lit(1)) >= 1 + F.expr(f"max({TENTHS} * n div 10 div {PART})")
    linkable = region.groupBy("set_id").agg(enough.alias("ok")).where("ok").select("set_id")
    region = kept(region.join(kept(linkable, "linkable-sets"), "set_id"), "linkable-regions")
    pivots = region.groupBy("s").agg(F.min("set_id").alias("cell"), F.max("set_id").alias("last"))
    pivots = kept(pivots.where("cell != last").select("s", "cell"), "pivots")
    cells = kept(region.join(pivots, "s").select("cell", "set_id", "n").distinct(), "cell-sets")

    def fetch(some: DataFrame) -> DataFrame:
        wanted = some.select("set_id").distinct().join(first, "set_id").select("text_hash")
        return fetched(docs, kept(wanted, "wanted-sets"), text_col, settings)

    links = kept(joined_cells(cell_rows(cells, fetch, settings)), "links")
    classes = components(links).select(F.col("id").alias("set_id"), "component")
    least = kept(classes.join(first, "set_id"), "class-ids")
    lowest = kept(least.groupBy("component").agg(F.min("id").alias("lowest")), "class-lowest")
    joined = least.join(lowest, "component").select("set_id", "lowest")
    named = kept(
        first.join(joined, "set_id", "left").select("set_id", F.coalesce("lowest", "id").alias("__c")), "set-classes"
    )
    return rows.join(named, "set_id", "left").select(
        id_col, F.col("n").alias("n_shingles"), F.coalesce("__c", F.col(id_col)).alias("component_id")
    )
