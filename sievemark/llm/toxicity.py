"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word beginnings (four characters, for inflected
words), word pairs and pairs with one word between, of the whole text (ASCII letters
lower-cased, ASCII punctuation as space). A feature is admitted when it occurs in at least
``MIN_ROWS`` rows of the sample. Each coordinate has its own learning rate and an L1
threshold, so that the fitted model is a short list of weights.

Learning uses a bounded sample of labelled rows (about ``MAX_ROWS``), chosen by a hash of
the id. NULL and empty texts get the score of no features. Rows without a label only get
a score. An id with several labels counts with the majority, ties as 1. If nothing can be
learned every score is 0. Repeated rows get equal scores; other columns are carried
untouched.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix64, unit_hash

BITS = 22
MAX_ROWS = 10_000
MIN_ROWS = 3
BEGINNING = 4
EPOCHS = 6
ALPHA, BETA, L1, L2 = 10.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7
SEED = 11
TO_SPACE = bytes.maketrans(
    (string.punctuation + string.ascii_uppercase).encode(), (" " * len(string.punctuation) + string.ascii_lowercase).encode()
)


class Beginnings(WordHashes):
    """Word → hash of its first characters, marked so that it differs from that of a whole word."""

    def __missing__(self, word: bytes) -> int:
        return super().__missing__(word, b"^" + word.decode()[:BEGINNING].encode())


def features(text: str | None, hashes: tuple[WordHashes, Beginnings], bits: int = BITS) -> np.ndarray:
    """Hashed features with repeats, as indices below ``2**bits``."""
    tokens = (text or "").encode().translate(TO_SPACE).split()
    words, starts = (h.of(tokens) for h in hashes)
    with np.errstate(over="ignore"):
        pairs = mix64(words[:-1] * np.uint64(3) + words[1:] * np.uint64(5))
        skips = mix64(words[:-2] * np.uint64(7) + words[2:] * np.uint64(11) + np.uint64(1))
    return (np.concatenate([words, starts, pairs, skips]) & np.uint64(2**bits - 1)).astype(np.int32)


@dataclass
class Weights:
    """Non-zero weights and the intercept."""

    index: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = 0.0
    bits: int = BITS
    fitted: bool = False

    def scorer(self):
        dense = np.zeros(2**self.bits, np.float32)
        dense[self.index] = self.value
        used = dense != 0
        hashes = WordHashes(), Beginnings()

        def score(text: str | None) -> float:
            ids = features(text, hashes, self.bits)
            return float(1 / (1 + np.exp(-np.clip(self.bias + dense[np.unique(ids[used[ids]])].sum(), -30, 30))))

        return score


def ftrl(rows: list[np.ndarray], labels: np.ndarray, *, bits: int = BITS, min_rows: int = MIN_ROWS, epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, seed: int = SEED) -> Weights:
    """Follow the proximally regularised leader, one example after the other; the intercept is not shrunk."""
    seen = np.bincount(np.concatenate(rows), minlength=2**bits) >= min_rows
    rows = [ids[seen[ids]] for ids in rows]
    z, n = np.zeros(2**bits), np.zeros(2**bits)
    z0 = n0 = 0.0
    rng = np.random.default_rng(seed)

    def weight(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids = rows[i]
            zi, ni = z[ids], n[ids]
            w = weight(zi, ni)
            w0 = -z0 * alpha / (beta + n0**0.5)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -30, 30))) - labels[i]
            root = np.sqrt(ni + g * g)
            z[ids] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[ids] = ni + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / alpha * w0
            n0 += g * g
    w = weight(z, n)
    index = np.flatnonzero(w)
    return Weights(index.astype(np.int32), w[index], float(-z0 * alpha / (beta + n0**0.5)), bits, True)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train_on: Column | None, max_rows: int, seed: int, columns: list) -> DataFrame:
    """doc_id, y and ``columns`` of about ``max_rows`` labelled documents, by a hash of the id.

    The chosen labels are few by construction, so they travel to the texts, not the other way round.
    Of rows that repeat an id the one with the least text hash counts, so that rows are bounded as ids are.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (train_on if train_on is not None else F.lit(True)))
    known = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    total = known.count()
    chosen = known.filter(unit_hash(seed, F.col("doc_id")) < max_rows / max(total, 1))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return single.select("doc_id", "y", *columns)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", train_on: Column | None = None, max_rows: int = MAX_ROWS, seed: int = SEED) -> Weights:
    """Weights learned from ``labels`` (doc_id and a 0/1 column) where ``train_on``, a condition on them, holds."""
    @F.pandas_udf("binary")  # four bytes a feature; lists would take nine times that on the driver
    def ids(texts: pd.Series) -> pd.Series:
        hashes = WordHashes(), Beginnings()
        return pd.Series([np.unique(features(t, hashes)).tobytes() for t in texts])

    rows = labelled_sample(docs, labels, label, train_on, max_rows, seed, [ids("text").alias("ids")]).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["ids"])))
    y = np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        return Weights()
    return ftrl([np.frombuffer(r["ids"], np.int32) for r in rows], y, seed=seed)


def predict(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    if not weights.fitted:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rate = sent.value.scorer()
        for texts in batches:
            yield pd.Series([rate(t) for t in texts], dtype=float)

    scored = docs.withColumn("score", score("text"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
