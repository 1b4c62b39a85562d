"""Toxicity by a weighted lexicon.

Texts are folded (lower case, look-alike letters, digits standing for letters), matched
against whole words and word stems with one Aho-Corasick automaton, and the matched
weights are normalised by length. Matches inside an exception phrase do not count. The
lexicon and its weights are learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import held_out, map_texts

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q",
    "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "scum line")

_FOLD = str.maketrans(HOMOGLYPHS | {chr(c): None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060)})
_SUBST = str.maketrans(SUBSTITUTES)
# A run of letters, digits and signs that has a substitute; numbers alone stay as they are.
_RUN = re.compile(r"[\w@$]*[013457@$][\w@$]*")
_FULLWIDTH = re.compile("[！-～]")
_GAPS = re.compile(r"[\W\d_]+")


def _unmask(run: re.Match) -> str:
    found = run[0]
    return found.translate(_SUBST) if any(c.isalpha() for c in found) else found


def fold(text: str) -> str:
    """Folded words of a text, one blank around each."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
        text = _FULLWIDTH.sub(lambda m: chr(ord(m[0]) - 0xFEE0), text)
    if any(c in text for c in SUBSTITUTES):
        text = _RUN.sub(_unmask, text)
    return f" {_GAPS.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Settings:
    """``docs_per_class`` and ``max_terms`` bound the labelled sample and the lexicon.

    A term needs ``least_docs`` toxic documents, a share ``least_precision`` of the (equally
    weighted) documents it is in, and a log-likelihood ratio of ``least_evidence``, which
    keeps out what is rare and toxic by chance. A stem needs ``stem_words`` such words.
    """

    docs_per_class: int = 8_000
    max_terms: int = 2_000
    least_docs: int = 4
    least_precision: float = 0.8
    least_evidence: float = 30.0
    stem: tuple[int, int] = (3, 8)
    stem_words: int = 4
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass
class Lexicon:
    """``terms``: pattern to weight; ' word ' is a word and ' stem' the start of one."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    # Log-odds of the label: intercept, per log(1 + weight), per weight in 100 words.
    curve: tuple[float, float, float] = (-6.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            pattern = fold(phrase)
            if pattern.strip():
                found.add_word(pattern, (len(pattern), None))
        if len(found):
            found.make_automaton()
        return found


def matched(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Weight of the matches outside exception phrases, and how many there are."""
    if not len(automaton):
        return 0.0, 0
    spans, hits = [], []
    for end, (size, weight) in automaton.iter(folded):
        (spans if weight is None else hits).append((end - size + 1, end, weight))
    if spans and hits:
        spans.sort()
        starts = np.array([s[0] for s in spans])
        ends = np.maximum.accumulate([s[1] for s in spans])
        at = np.searchsorted(starts, [h[0] for h in hits], side="right") - 1
        hits = [h for h, i in zip(hits, at) if i < 0 or ends[i] < h[1]]
    return sum(h[2] for h in hits), len(hits)


def measure(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, int, int]:
    """Matched weight, matches and words of a text."""
    if not text:
        return 0.0, 0, 0
    folded = fold(text)
    weight, hits = matched(folded, automaton)
    return weight, hits, folded.count(" ") - 1


def _inputs(weight, words) -> np.ndarray:
    weight, words = np.asarray(weight, float), np.asarray(words, float)
    return np.column_stack(
        [np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 20))]
    )


def scores(weight, words, curve: tuple[float, float, float]) -> np.ndarray:
    x = np.clip(_inputs(weight, words) @ np.array(curve), -30, 30)
    return 1 / (1 + np.exp(-x))


def _term_features(texts: list, settings: Settings) -> list[list[str]]:
    """Distinct words and stems of each text, as patterns."""
    low, high = settings.stem
    out = []
    for text in texts:
        words = set(fold(text or "").split())
        found = {f" {w} " for w in words}
        for w in words:
            found.update(f" {w[:n]}" for n in range(low, min(high, len(w) - 1) + 1))
        out.append(list(found))
    return out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, settings: Settings, id_col: str, text_col: str,
    label_col: str,
) -> DataFrame:
    """``__id``, ``__text`` and ``__y`` of at most about ``docs_per_class`` documents per class."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .where(~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("__id"))
        .agg((F.max(F.col(label_col)) > 0).cast("int").alias("__y"))
    )
    n = {r[0]: r[1] for r in known.groupBy("__y").count().collect()}
    wanted = F.lit(False)
    for y, count in n.items():
        limit = int(min(1.0, settings.docs_per_class / count) * 1_000_003) + 1
        wanted |= (F.col("__y") == y) & (F.pmod(F.xxhash64("__id"), F.lit(1_000_003)) < limit)
    # The limit makes the size of the broadcast certain.
    chosen = known.where(wanted).limit(3 * settings.docs_per_class)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return texts.join(F.broadcast(chosen), "__id")


def _evidence(b: int, g: int, bad: int, good: int) -> float:
    """Log-likelihood ratio of a term that is in b of the bad and g of the good documents."""
    rate = (b + g) / (bad + good)
    return 2 * sum(n * math.log(n / (rate * of)) for n, of in ((b, bad), (g, good)) if n)


def learn_terms(sample: DataFrame, settings: Settings) -> dict[str, float]:
    """Words and stems that point to the label, with their log-odds."""
    n = {r[0]: r[1] for r in sample.groupBy("__y").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad:
        return {}
    found = map_texts(
        sample, ["__y"], "__text", "__terms array<string>",
        lambda texts: {"__terms": _term_features(texts, settings)},
    )
    is_word = F.endswith("__term", F.lit(" "))
    rows = (
        found.select("__y", F.explode("__terms").alias("__term"))
        .groupBy("__term")
        .agg(F.sum("__y").alias("bad"), F.sum(1 - F.col("__y")).alias("good"))
        .where(F.col("bad") >= settings.least_docs)
    )
    share = F.col("bad") / bad / (F.col("bad") / bad + (F.col("good") + 0.5) / max(good, 1))
    top = (
        rows.where(share >= settings.least_precision)
        .withColumn("word", is_word)
        .orderBy(F.col("bad").desc(), F.col("good"), "__term")
        .limit(20 * settings.max_terms)
        .collect()
    )
    stats = {r["__term"]: (r["bad"], r["good"]) for r in top}
    words = {t for t in stats if t.endswith(" ")}
    stems = sorted((t for t in stats if not t.endswith(" ")), key=lambda t: (len(t), t))
    children: dict[str, int] = {}
    for w in words:
        for size in range(1 + settings.stem[0], len(w) - 1):
            children[w[:size]] = children.get(w[:size], 0) + 1
    chosen: dict[str, tuple[int, int]] = {}
    for stem in stems:
        # A stem stands for many words; one that a longer stem explains as well is too short.
        longer = max((stats[t][0] for t in stems if len(t) == len(stem) + 1 and t.startswith(stem)), default=0)
        if children.get(stem, 0) < settings.stem_words or longer >= 0.9 * stats[stem][0]:
            continue
        if not any(stem.startswith(t) for t in chosen):
            chosen[stem] = stats[stem]
    for word in words:
        if not any(word.startswith(t) for t in chosen if not t.endswith(" ")):
            chosen[word] = stats[word]
    chosen = {
        t: (b, g) for t, (b, g) in chosen.items() if _evidence(b, g, bad, good) >= settings.least_evidence
    }
    weigh = {t: math.log((b + 0.1) / (bad + 1)) - math.log((g + 0.1) / (good + 1)) for t, (b, g) in chosen.items()}
    best = sorted(weigh, key=lambda t: (-chosen[t][0] * weigh[t], t))[: settings.max_terms]
    return {t: weigh[t] for t in best if weigh[t] > 0}


def fit_curve(weight, words, y, steps: int = 60) -> tuple[float, float, float]:
    """Ridge logistic regression of the label on matched weight and its density."""
    x, y = _inputs(weight, words), np.asarray(y, float)
    beta = np.zeros(3)
    penalty = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    # More matches never lower a score.
    return float(beta[0]), float(max(beta[1], 0)), float(max(beta[2], 0))


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Lexicon:
    """Learn from labelled documents that are not held out.

    Without a positive label the lexicon is empty and every score is low. Conflicting
    labels of one id count as positive.
    """
    sample = labelled_sample(docs, labels, settings, id_col, text_col, label_col)
    terms = learn_terms(sample, settings)
    lexicon = Lexicon(terms, settings.exceptions)
    if not terms:
        return lexicon

    def run(texts: list) -> dict:
        automaton = lexicon.automaton()
        found = [measure(t, automaton) for t in texts]
        return {"w": [float(f[0]) for f in found], "n": [f[2] for f in found]}

    rows = map_texts(sample, ["__y"], "__text", "w double, n long", run).limit(
        4 * settings.docs_per_class
    ).collect()
    y = np.array([r["__y"] for r in rows])
    lexicon.curve = fit_curve([r["w"] for r in rows], [r["n"] for r in rows], y)
    return lexicon


def score(
    docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """``id_col``, score, predicted, n_hits and n_words of every row, from its whole text.

    NULL and empty texts match nothing and get the lowest score. Repeated rows get the
    same score each; other columns are not read.
    """
    def run(texts: list) -> dict:
        automaton = lexicon.automaton()
        found = [measure(t, automaton) for t in texts]
        p = scores([f[0] for f in found], [f[2] for f in found], lexicon.curve)
        return {
            "score": p,
            "predicted": (p >= threshold).astype(np.int32),
            "n_hits": [f[1] for f in found],
            "n_words": [f[2] for f in found],
        }

    return map_texts(
        docs, [id_col], text_col, "score double, predicted int, n_hits long, n_words long", run
    )
