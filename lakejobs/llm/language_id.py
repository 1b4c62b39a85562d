"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weighted character n-grams (one to three code points of the
lower-cased letters, words apart), hashed into buckets. The weights are trained with
follow-the-regularised-leader and elastic-net penalties, so most are exactly zero, and
the probabilities are then calibrated with one temperature.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import held_out, map_texts, share_package

UNDETERMINED = "und"
BITS = 16
ORDERS = (1, 2, 3)
# Texts are worked on in slices of so many code points; the slices overlap by the longest n-gram.
SLICE = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``docs_per_language`` bounds the training sample; the rest are the learner's."""

    docs_per_language: int = 800
    max_languages: int = 500
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, IDF folded in
    idf: np.ndarray
    bias: np.ndarray
    temperature: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(text: str | None):
    """Buckets of the n-grams of a text, slice by slice; nothing without a letter."""
    if not text:
        return
    letters, carry = _letters(), np.zeros(0, dtype=np.uint32)
    for start in range(0, len(text), SLICE):
        part = text[start : start + SLICE].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, dtype=np.uint32)
        codes = np.where(letters[codes], codes, 32).astype(np.uint32)
        codes = np.concatenate([carry if start else np.array([32], np.uint32), codes])
        if start + SLICE >= len(text):
            codes = np.append(codes, np.uint32(32))
        first = len(carry) if start else 0
        blank = codes == 32
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        first -= int((~keep[:first]).sum())
        codes = codes[keep]
        h = codes.astype(np.uint64)
        for order in ORDERS:
            if order > 1:
                if len(codes) < order:
                    break
                h = h[:-1] * np.uint64(0x100000001B3) + codes[order - 1 :].astype(np.uint64)
            mixed = (h + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            buckets = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
            # Only grams that end in this slice; those before ended in the last one.
            buckets = buckets[max(0, first - order + 1) :]
            if order == 1:
                buckets = buckets[codes[first:] != 32]
            yield buckets
        carry = codes[-(ORDERS[-1] - 1) :]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of its n-grams."""
    parts = list(_grams(text))
    if not sum(len(p) for p in parts):
        return np.zeros(0, np.int64), np.zeros(0)
    buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
    return buckets, counts / counts.sum()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], settings: Settings) -> Model:
    """Fit to (buckets, shares, language) rows; the order of the rows does not matter."""
    rows = sorted(rows, key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
    languages = sorted({r[2] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.ones(1 << BITS), np.zeros(0), 1.0)
    df = np.zeros(1 << BITS)
    for buckets, _, _ in rows:
        df[buckets] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    index = {x: i for i, x in enumerate(languages)}
    order = np.random.default_rng(7).permutation(len(rows))
    calibration = set(order[:: 5].tolist()) if len(rows) >= 20 else set()
    k = len(languages)
    z, n = np.zeros((1 << BITS, k)), np.zeros((1 << BITS, k))
    zb, nb = np.zeros(k), np.zeros(k)
    a, b, l1, l2 = settings.alpha, settings.beta, settings.l1, settings.l2

    def vector(row):
        x = row[1] * idf[row[0]]
        return x / max(np.sqrt((x * x).sum()), 1e-12)

    def weights(z, n):
        return np.where(
            np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((b + np.sqrt(n)) / a + l2)
        )

    for _ in range(settings.epochs):
        for i in order:
            if i in calibration:
                continue
            buckets, x = rows[i][0], vector(rows[i])
            w, bias = weights(z[buckets], n[buckets]), -zb / ((b + np.sqrt(nb)) / a)
            gap = _softmax(x @ w + bias)
            gap[index[rows[i][2]]] -= 1
            g = x[:, None] * gap
            sigma = (np.sqrt(n[buckets] + g * g) - np.sqrt(n[buckets])) / a
            z[buckets] += g - sigma * w
            n[buckets] += g * g
            sigma = (np.sqrt(nb + gap * gap) - np.sqrt(nb)) / a
            zb += gap - sigma * bias
            nb += gap * gap
    w, bias = weights(z, n), -zb / ((b + np.sqrt(nb)) / a)
    temperature = 1.0
    if calibration:
        held = sorted(calibration)
        scores = np.array([vector(rows[i]) @ w[rows[i][0]] + bias for i in held])
        truth = np.array([index[rows[i][2]] for i in held])
        grid = np.exp(np.linspace(np.log(0.1), np.log(10), 81))
        loss = [
            -np.log(_softmax(scores / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in grid
        ]
        temperature = float(grid[int(np.argmin(loss))])
    return Model(languages, w * idf[:, None], idf, bias, temperature)


def classify(text: str | None, model: Model) -> tuple[str, float]:
    """Language and its calibrated probability; (und, 0) without a letter or a language."""
    if not model.languages or not has_letter(text):
        return UNDETERMINED, 0.0
    counts = np.zeros(1 << BITS)
    for buckets in _grams(text):
        counts += np.bincount(buckets, minlength=1 << BITS)
    found = np.flatnonzero(counts)
    counts = counts[found]
    norm = np.sqrt(((counts * model.idf[found]) ** 2).sum())
    total = counts @ model.weights[found] / max(norm, 1e-12) + model.bias
    p = _softmax(total / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def training_rows(docs: DataFrame, settings: Settings, id_col: str, text_col: str, lang_col: str):
    """Features of a bounded sample: at most about ``docs_per_language`` rows per language.

    Counts per language cover all rows; rows are then taken by the hash of their id, at
    the rate that meets the bound.
    """
    learn = docs.where(
        ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    )
    counts = (
        learn.groupBy(lang_col)
        .count()
        .orderBy(F.col("count").desc(), lang_col)
        .limit(settings.max_languages)
        .collect()
    )
    if not counts:
        return []
    wanted = F.lit(False)
    for lang, n in counts:
        rate = min(1.0, settings.docs_per_language / n)
        limit = int(rate * 1_000_003) + 1
        wanted |= (F.col(lang_col) == lang) & (
            F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) < limit
        )
    # Many rows of one id share a hash: the limit keeps the bound even then.
    most = 2 * settings.docs_per_language * len(counts)

    def extract(texts: list) -> dict:
        found = [features(t) for t in texts]
        return {"__buckets": [f[0] for f in found], "__shares": [f[1] for f in found]}

    rows = map_texts(
        learn.where(wanted).select(F.col(lang_col).alias("__lang"), F.col(text_col).alias("__t")),
        ["__lang"],
        "__t",
        "__buckets array<long>, __shares array<double>",
        extract,
    )
    found = rows.limit(most).collect()
    return [(np.array(r[1], np.int64), np.array(r[2]), r[0]) for r in found if r[1]]


def train(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    return fit(training_rows(docs, settings, id_col, text_col, lang_col), settings)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, lang_pred and score (0 to 1) of every row, from its whole text.

    NULL texts, texts without a letter, and a model that learned no language give
    ``und`` with score 0. Repeated rows get the same answer each; other columns are not
    read.
    """
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list) -> dict:
        found = [classify(t, handle.value) for t in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_texts(docs, [id_col], text_col, "lang_pred string, score double", run)


def keep_identified(
    docs: DataFrame,
    model: Model,
    least: float = 0.4,
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs`` whose text is in some learned language with score ``least`` or more.

    All columns pass unchanged; NULL, empty and letterless texts are rejected, and so is
    everything if no language was learned.
    """
    share_package(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches):
        at = schema.fieldNames().index(text_col)
        for batch in batches:
            found = [classify(t, handle.value) for t in batch.column(at).to_pylist()]
            keep = [x != UNDETERMINED and s >= least for x, s in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
