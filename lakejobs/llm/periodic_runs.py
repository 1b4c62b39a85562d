"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffixes of a prefix are the path from its state to the root of the automaton's link
tree. Every node on it remembers where its words ended last; nodes that agree in that form
one segment of the path, held as one splay tree with one colour. Appending a word walks up
the path segment by segment and recolours it: a segment of colour p whose longest suffix
has m words says that m words before place i also end at p, so with m >= i - p they form a
square of period i - p, and all of them together the runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import map_texts

FAR = 1 << 40
# Passes over a text that narrow down where runs can be.
NARROWINGS = 30


@dataclass(frozen=True)
class Settings:
    """A run has ``least_words`` words and ``least_powers`` periods at least."""

    least_words: int = 6
    least_powers: int = 4

    def __post_init__(self):
        if self.least_powers < 2:
            raise ValueError("a run repeats: least_powers is 2 or more")


class SuffixAutomaton:
    """Link tree of the automaton of ``words``; state 0 is none, 1 the root."""

    def __init__(self, words: list):
        moves: list[dict] = [{}, {}]
        length, link = [0, 0], [0, 0]
        last, prefixes = 1, []
        for word in words:
            state = len(length)
            length.append(length[last] + 1)
            link.append(0)
            moves.append({})
            at = last
            while at and word not in moves[at]:
                moves[at][word] = state
                at = link[at]
            if not at:
                link[state] = 1
            else:
                to = moves[at][word]
                if length[to] == length[at] + 1:
                    link[state] = to
                else:
                    twin = len(length)
                    length.append(length[at] + 1)
                    link.append(link[to])
                    moves.append(moves[to].copy())
                    while at and moves[at].get(word) == to:
                        moves[at][word] = twin
                        at = link[at]
                    link[to] = link[state] = twin
            last = state
            prefixes.append(state)
        self.length, self.link, self.prefixes = length, link, prefixes


class Paths:
    """Coloured segments of the link tree, a splay tree by depth each.

    The colour of a segment is held at the root of its splay tree. It starts as -1: nothing
    has ended there yet.
    """

    def __init__(self, automaton: SuffixAutomaton):
        n = len(automaton.length)
        self.length = automaton.length
        # The parent in a splay tree, or for its root the node above the segment.
        self.up = list(automaton.link)
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def _splay(self, v: int) -> None:
        """Turn ``v`` up to the root of its splay tree."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[v]
            if not p or (left[p] != v and right[p] != v):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._turn(p if (left[g] == p) == (left[p] == v) else v)
            self._turn(v)

    def _turn(self, v: int) -> None:
        """Turn ``v`` above its parent in the splay tree."""
        up, left, right = self.up, self.left, self.right
        p = up[v]
        g = up[p]
        if left[p] == v:
            b = left[p] = right[v]
            right[v] = p
        else:
            b = right[p] = left[v]
            left[v] = p
        if b:
            up[b] = p
        if left[g] == p:
            left[g] = v
        elif right[g] == p:
            right[g] = v
        up[p], up[v] = v, g

    def _root_colour(self, v: int) -> int:
        up, left, right = self.up, self.left, self.right
        while up[v] and (left[up[v]] == v or right[up[v]] == v):
            v = up[v]
        return self.colour[v]

    def access(self, v: int, colour: int) -> list[tuple[int, int]]:
        """Colour the path from ``v`` to the root; colour and greatest length of each segment
        that was on it, from the deepest up."""
        found, below = [], 0
        up, right, colours = self.up, self.right, self.colour
        while v:
            old = self._root_colour(v)
            self._splay(v)
            found.append((old, self.length[v]))
            if right[v]:
                # What is deeper leaves the path and keeps its colour.
                colours[right[v]] = old
            right[v] = below
            below = v
            v = up[v]
        colours[below] = colour
        return found


def runs_of(words: list, settings: Settings = Settings()) -> list[tuple[int, int, int]]:
    """Start, length and period of the runs of ``words``, sorted by start and period."""
    automaton = SuffixAutomaton(words)
    paths = Paths(automaton)
    found = set()
    n = len(words)
    for i, state in enumerate(automaton.prefixes):
        for last, m in paths.access(state, i):
            period = i - last
            if last < 0 or m < period * (settings.least_powers - 1) or m + period < settings.least_words:
                continue
            if i + 1 < n and words[i + 1] == words[i + 1 - period]:
                continue
            found.add((i - m - period + 1, m + period, period))
    return sorted((s, size, p) for s, size, p in found)


def stretches(words: list, settings: Settings) -> list[tuple[int, int]]:
    """Where runs can be: stretches of words that all occurred shortly before.

    In a run of period q all words but the first q have been seen at most q words before, and
    there are q * (least_powers - 1) of them at least. So of a stretch of n words with an
    earlier occurrence those seen last more than n / (least_powers - 1) words before are in
    no run of it; they part it, until nothing changes or for NARROWINGS passes.
    """
    seen, gaps = {}, []
    get = seen.get
    for i, word in enumerate(words):
        gaps.append(i - get(word, -FAR))
        seen[word] = i
    gaps = np.array(gaps, np.int64)
    powers = settings.least_powers
    least = max(powers - 1, -(-settings.least_words * (powers - 1) // powers))
    good = gaps <= len(words) // powers
    for _ in range(NARROWINGS):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return []
        room = np.zeros(len(words), np.int64)
        for s, e in zip(starts, ends):
            room[s:e] = (e - s) // (powers - 1)
        now = gaps <= room
        if (now == good).all():
            break
        good = now
    return list(zip(starts.tolist(), ends.tolist()))


def find(words: list, settings: Settings = Settings()) -> list[tuple[int, int, int]]:
    """The runs of ``words``: the automaton is built over each stretch that can hold one, and
    the words before it that its first period may reach."""
    found = []
    for start, end in stretches(words, settings):
        low = max(0, start - (end - start) // (settings.least_powers - 1))
        for s, size, period in runs_of(words[low:end], settings):
            # What lies before the stretch is the end of a run of an earlier one.
            if low + s + period >= start:
                found.append((low + s, size, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` with one period left of each run."""
    stays = np.ones(len(words), bool)
    for start, size, period in runs:
        stays[start + period : start + size] = False
    return [words[i] for i in np.flatnonzero(stays)]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the text's
    words with one period left of each run, joined by single blanks.

    Words are parted by ASCII blanks and numbered from 0. NULL and empty texts have no words,
    no runs and an empty ``collapsed``. Repeated rows are searched each; other columns are
    not read. The time of a text is its words' number times its logarithm, whatever it
    repeats; memory is a few hundred bytes a word of the longest stretch that repeats.
    """

    def run(texts: list) -> dict:
        n_words, runs, short = [], [], []
        for text in texts:
            words = (text or "").encode("utf-8", "surrogatepass").split()
            found = find(words, settings)
            n_words.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            left = collapse(words, found) if found else words
            short.append(b" ".join(left).decode("utf-8", "surrogatepass"))
        return {
            "n_words": pa.array(n_words, pa.int64()),
            "runs": pa.array(runs, pa.list_(RUN)),
            "collapsed": pa.array(short, pa.string()),
        }

    schema = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_texts(docs, [id_col], text_col, schema, run)


def with_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end planted into about a tenth of the texts, to be found again.

    With h the crc32 of the id as text, g = h div 10 and n words: where h ends in 0, the
    words from g mod n on repeat the first 1 + (n - a) div (3 + g mod 8) of them. Rows
    without an id or words stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    planted = (
        docs.withColumn("__w", F.when(h % 10 == 0, words))
        .withColumn("__n", F.size("__w"))
        .withColumn("__g", F.floor(h / 10).cast("long"))
        .withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")).cast("int"))
        .withColumn("__p", F.expr("cast(1 + (__n - __a) div (3 + __g % 8) as int)"))
    )
    piece = F.slice("__w", F.col("__a") + 1, F.col("__p"))
    times = F.expr("cast((__n - __a + __p - 1) div __p as int)")
    tail = F.slice(F.flatten(F.array_repeat(piece, times)), F.lit(1), F.col("__n") - F.col("__a"))
    text = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a")), tail), " ")
    out = planted.withColumn(text_col, F.when(F.col("__n") > 0, text).otherwise(F.col(text_col)))
    return out.select(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """``found`` as of ``periodic_runs`` with the number of runs, the longest (the first of
    equally long ones, then that of the least period) and hashes of all runs and of the text."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("from"), (-r["period"]).alias("each")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    others = [c for c in found.columns if c not in ("runs", "collapsed")]
    return found.withColumn("__l", longest).select(
        *others,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__l.from")).alias("start"),
        F.col("__l.length").alias("length"),
        (-F.col("__l.each")).alias("period"),
        F.expr("(1000 * __l.length) div (-__l.each)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
