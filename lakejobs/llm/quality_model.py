"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network.

Every word has a sparse random index vector, drawn from its hash. Its word vector is the sum
of the index vectors of its neighbours over the whole corpus. Words are told apart by a row
of a table of fixed size, so nothing is counted out and rare words share rows. A document
is the mean and the spread of the vectors of its words; a small network, trained in numpy
on labelled documents, turns that into a probability, calibrated by a temperature.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import map_texts, share_package

# Words, numbers, and runs of signs.
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
NUMBER, SHOUT = "0", "^"
# Tokens of texts that are worked on together: counted, and pooled (in a processor's cache).
CHUNK, POOLED = 1 << 18, 1 << 12
# Partial sums of a row block are added up in so many places first.
SALTS = 64
BLOCKS = 64


@dataclass(frozen=True)
class Settings:
    """``rows`` x ``size`` numbers are the word vectors, whatever the corpus; ``signs`` of an
    index vector's numbers are not zero, and ``reach`` words on either side are neighbours.

    At most about ``docs_per_class`` documents of a label teach the network, every
    ``validate``-th of them its temperature.
    """

    rows: int = 8192
    size: int = 64
    signs: int = 4
    reach: int = 2
    docs_per_class: int = 8_000
    hidden: int = 32
    epochs: int = 40
    validate: int = 5
    seed: int = 13

    def __post_init__(self):
        if self.rows % BLOCKS:
            raise ValueError(f"rows must be a multiple of {BLOCKS}")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Rows(dict):
    """Table row of a token, by the crc32 of the token; remembers a bounded number of them."""

    def __init__(self, rows: int, most: int = 1 << 20):
        self.rows, self.most = rows, most

    def __missing__(self, token: str) -> int:
        if len(self) >= self.most:
            self.clear()
        if len(token) > 1 and token.isupper():
            key = SHOUT
        elif token[0].isdigit():
            key = NUMBER
        else:
            key = token.lower() if token[0].isalpha() else token[:3]
        row = self[token] = zlib.crc32(key.encode("utf-8", "surrogatepass")) % self.rows
        return row


def index_vectors(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the numbers of each row's index vector that are not zero."""
    rng = np.random.default_rng(settings.seed)
    places = np.argsort(rng.random((settings.rows, settings.size)), axis=1)[:, : settings.signs]
    signs = rng.integers(0, 2, places.shape) * 2 - 1
    return places, signs


def chunks(texts: list[str | None], rows: Rows, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the tokens of some texts after the other, and how many tokens each text has."""
    found, sizes, n = [], [], 0
    for i, text in enumerate(texts, 1):
        found.append(list(map(rows.__getitem__, TOKEN.findall(text or ""))))
        sizes.append(len(found[-1]))
        n += sizes[-1]
        if n >= size or i == len(texts):
            yield np.fromiter(chain.from_iterable(found), np.int64, n), np.array(sizes, np.int64)
            found, sizes, n = [], [], 0


def neighbour_sums(found: np.ndarray, sizes: np.ndarray, settings: Settings, places, signs) -> np.ndarray:
    """Sums of the index vectors of the neighbours of each row's tokens."""
    out = np.zeros(settings.rows * settings.size)
    text = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, settings.reach + 1):
        near = np.flatnonzero(text[:-step] == text[step:])
        a, b = found[near], found[near + step]
        for word, other in ((a, b), (b, a)):
            for j in range(settings.signs):
                at = word * settings.size + places[other, j]
                out += np.bincount(at, signs[other, j], minlength=len(out))
    return out


def _added(parts: DataFrame, per_block: int, keys: list[str]) -> DataFrame:
    """Partial sums with equal ``keys`` (after ``repartition`` by them) added up as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            names = zip(*[batch.column(i).to_pylist() for i in range(2)])
            for name, part in zip(names, batch.column(2)):
                key = name if len(keys) == 2 else (name[0], 0)
                if key not in sums:
                    sums[key] = np.zeros(per_block, np.int64)
                sums[key] += np.frombuffer(part.as_buffer(), np.int64)
        if sums:
            yield _parts(sums)

    return parts.repartition(*keys).mapInArrow(run, parts.schema)


def _parts(sums: dict[tuple, np.ndarray]) -> pa.RecordBatch:
    blocks, salts = zip(*sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(salts, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
        names=["block", "salt", "sums"],
    )


def word_vectors(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> np.ndarray:
    """The word vectors, ``rows`` x ``size``, from the neighbours in all texts.

    Tasks send one table each, its rows dealt over blocks, which are added up in two steps;
    the sums are whole numbers, so their order does not matter. The driver gets one table.
    """
    share_package(docs.sparkSession)
    per_block = settings.rows * settings.size // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows, (places, signs) = Rows(settings.rows), index_vectors(settings)
        total = np.zeros(settings.rows * settings.size)
        for batch in batches:
            for found, sizes in chunks(batch.column(0).to_pylist(), rows, CHUNK):
                total += neighbour_sums(found, sizes, settings, places, signs)
        table = total.astype(np.int64).reshape(BLOCKS, per_block)
        context = TaskContext.get()
        salt = context.partitionId() % SALTS if context else 0
        sums = {(i, salt): block for i, block in enumerate(table) if block.any()}
        if sums:
            yield _parts(sums)

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string"))
    parts = texts.mapInArrow(count, "block int, salt int, sums binary")
    added = _added(_added(parts, per_block, ["block", "salt"]), per_block, ["block"])
    table = np.zeros((BLOCKS, per_block))
    for row in added.collect():
        table[row["block"]] += np.frombuffer(row["sums"], np.int64)
    table = table.reshape(settings.rows, settings.size)
    # Frequent neighbours would drown the others.
    table = np.sign(table) * np.sqrt(np.abs(table))
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(norm, 1e-9)).astype(np.float32)


def n_features(settings: Settings) -> int:
    return 2 * settings.size + 4


def pooled(texts: list[str | None], vectors: np.ndarray, settings: Settings) -> np.ndarray:
    """A row per text: mean and spread of its words' vectors, the length of the mean, how much
    neighbours are alike and how often they are equal, and the logarithm of the length."""
    out, rows = [], Rows(settings.rows)
    for found, sizes in chunks(texts, rows, POOLED):
        x = np.zeros((len(sizes), n_features(settings)), np.float32)
        some = np.flatnonzero(sizes)
        if len(some):
            bounds = np.concatenate([[0], np.cumsum(sizes[some])])[:-1]
            n = sizes[some][:, None].astype(np.float32)
            v = vectors[found]
            mean = np.add.reduceat(v, bounds, axis=0) / n
            spread = np.sqrt(np.maximum(np.add.reduceat(v * v, bounds, axis=0) / n - mean**2, 0))
            # Against the token before; the first of a text has none.
            like, equal = np.zeros(len(found), np.float32), np.zeros(len(found), np.float32)
            like[1:] = np.einsum("ij,ij->i", v[1:], v[:-1])
            equal[1:] = found[1:] == found[:-1]
            like[bounds] = equal[bounds] = 0
            pairs = np.maximum(sizes[some] - 1, 1)
            x[some] = np.column_stack(
                [
                    mean,
                    spread,
                    np.linalg.norm(mean, axis=1),
                    np.add.reduceat(like, bounds) / pairs,
                    np.add.reduceat(equal, bounds) / pairs,
                    np.log1p(sizes[some]) / 10,
                ]
            )
        out.append(x)
    return np.concatenate(out) if out else np.zeros((0, n_features(settings)), np.float32)


@dataclass
class Network:
    """Inputs are standardised; a hidden layer of tanh units and a logistic output."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.shift) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


@dataclass
class Model:
    """``network`` is None where there was nothing to tell apart; ``share`` is then the score."""

    settings: Settings
    vectors: np.ndarray
    network: Network | None = None
    share: float = 0.5
    n_taught: dict[int, int] = field(default_factory=dict)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        return self.network.probabilities(pooled(texts, self.vectors, self.settings).astype(np.float64))


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray, settings: Settings) -> Network:
    """Train by Adam on mini-batches, the log loss weighted by ``weights``."""
    rng = np.random.default_rng(settings.seed)
    scale = x.std(axis=0)
    net = Network(
        shift=x.mean(axis=0),
        scale=np.where(scale > 1e-6, scale, 1.0),
        w1=rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], settings.hidden)),
        b1=np.zeros(settings.hidden),
        w2=rng.normal(0, 1 / np.sqrt(settings.hidden), settings.hidden),
        b2=0.0,
    )
    z = np.clip((x - net.shift) / net.scale, -8, 8)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, batch, decay = 0, 128, 1e-4
    for epoch in range(settings.epochs):
        rate = 0.003 * (1 - epoch / settings.epochs)
        order = rng.permutation(len(z))
        for at in range(0, len(z), batch):
            rows = order[at : at + batch]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            out = np.clip(hidden @ params[2] + params[3][0], -30, 30)
            error = weights[rows] * (1 / (1 + np.exp(-out)) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - hidden**2)
            grads = [
                z[rows].T @ back + decay * params[0],
                back.sum(axis=0),
                hidden.T @ error + decay * params[2],
                np.array([error.sum()]),
            ]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    return net


def temperature(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """What to divide logits by for the least log loss, between 1/4 and 8."""
    def loss(t: float) -> float:
        z = np.clip(logits / t, -30, 30)
        return float(np.sum(weights * (np.logaddexp(0, z) - y * z)))

    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    return float(min(grid, key=loss))


def taught(
    docs: DataFrame, labels: DataFrame, settings: Settings, id_col: str, text_col: str, label_col: str
) -> tuple[DataFrame, dict[int, int]]:
    """``__id``, ``__y`` and ``__text`` of documents that may teach, and the labels by class."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .where(~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("__id"))
        .agg((F.max(F.col(label_col)) > 0).cast("int").alias("__y"))
    )
    n = {r[0]: r[1] for r in known.groupBy("__y").count().collect()}
    of = 1_000_003
    hashed = F.pmod(F.xxhash64("__id", F.lit(settings.seed)), F.lit(of))
    wanted = F.lit(False)
    for y, count in n.items():
        wanted |= (F.col("__y") == y) & (hashed < int(min(1.0, settings.docs_per_class / count) * of) + 1)
    # The limit makes the size of the broadcast certain.
    chosen = known.where(wanted).limit(3 * settings.docs_per_class)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return texts.join(F.broadcast(chosen), "__id"), n


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Word vectors of all texts, and a network taught by labelled ones that are not held out.

    Of several labels of an id the largest counts. Labels of one class only, or none, teach
    nothing: every document then scores the share of label 1 (one half without any).
    """
    model = Model(settings, word_vectors(docs, settings, text_col))
    sample, n = taught(docs, labels, settings, id_col, text_col, label_col)
    total = sum(n.values())
    model.n_taught, model.share = n, n.get(1, 0) / total if total else 0.5
    if len(n) < 2:
        return model

    def run(texts: list) -> dict:
        x = pooled(texts, model.vectors, settings)
        return {"x": pa.array([r.tobytes() for r in x], pa.binary())}

    rows = (
        map_texts(sample, ["__id", "__y"], "__text", "x binary", run)
        .limit(4 * settings.docs_per_class)
        .collect()
    )
    if len({r["__y"] for r in rows}) < 2:
        return model
    # In one order whatever the partitions.
    rows.sort(key=lambda r: (str(r["__id"]), r["x"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], float)
    y = np.array([r["__y"] for r in rows], float)
    share = np.array([n[c] / total / max((y == c).mean(), 1e-9) for c in (0, 1)])
    weights = share[y.astype(int)]
    checks = np.arange(len(rows)) % settings.validate == 0
    if len(set(y[checks])) == 2 and len(set(y[~checks])) == 2:
        model.network = fit(x[~checks], y[~checks], weights[~checks], settings)
        model.network.temperature = temperature(model.network.logits(x[checks]), y[checks], weights[checks])
    else:
        model.network = fit(x, y, weights, settings)
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``id_col``, score and predicted of every row, from its whole text.

    NULL and empty texts are documents without words and score like any other. Repeated
    rows score alike; other columns are not read.
    """

    def run(texts: list) -> dict:
        p = model.scores(texts)
        return {"score": p.astype(float), "predicted": (p >= threshold).astype(np.int32)}

    return map_texts(docs, [id_col], text_col, "score double, predicted int", run)
