"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of ``WINDOW``
bytes, drawn from a bounded sample: about ``docs_per_lang`` documents of a language and
``WINDOWS_PER_DOC`` windows of each. Every language is learned: with more than ``FULL_LANGS``
of them the documents of each get fewer (one at least), the network gets larger and is
trained for longer. Prediction cuts the whole text into
windows of that length, labels every byte of it, and averages the probabilities over the
document. Fitted weights are a few tens of kB, and some hundred bytes for each language more.

A text that is NULL or has no letter is ``und`` with score 0; so is every text if nothing
can be learned (no row with text, language and id). Very long texts are processed window
by window. Repeated rows get equal predictions. Other columns are carried untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unit_hash, written

WINDOW = 64
HIDDEN = 8
DOCS_PER_LANG = 600
WINDOWS_PER_DOC = 4
FULL_LANGS = 64
STEPS = 240
BATCH = 256
RATE = 0.02
SEED = 5
UNKNOWN = "und"
BLOCK_ROWS, BLOCK_BYTES = 1024, 4_000_000
CELLS = 2_000_000


def growth(langs: int) -> float:
    """Factor on hidden units and steps: 1 up to ``FULL_LANGS`` languages, from 2 with the root of their number beyond."""
    return 2 * math.sqrt(langs / FULL_LANGS) if langs > FULL_LANGS else 1.0


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


@dataclass
class Direction:
    """One reading direction: byte → gate inputs, state → gate inputs; gates are update, reset, candidate."""

    table: np.ndarray
    recur: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(rng: np.random.Generator, hidden: int) -> Direction:
        table = rng.normal(0, 0.3, (256, 3 * hidden))
        recur = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        return Direction(table.astype(np.float32), recur.astype(np.float32), np.zeros(3 * hidden, np.float32))

    def states(self, steps: np.ndarray) -> np.ndarray:
        """(time, hidden, rows) states after each of the (time, rows) bytes, with nothing kept for learning.

        Rows lie along the last axis, so that every gate is one contiguous block.
        """
        hidden = self.recur.shape[0]
        gate = 2 * hidden
        table, recur = np.ascontiguousarray((self.table + self.bias).T), np.ascontiguousarray(self.recur.T)
        table[:gate] *= 0.5
        recur[:gate] *= 0.5
        out = np.empty((len(steps), hidden, steps.shape[1]), np.float32)
        h = np.zeros(out.shape[1:], np.float32)
        x, y = np.empty((2, 3 * hidden, steps.shape[1]), np.float32)
        update, reset, new = x[:hidden], x[hidden:gate], y[gate:]
        for t, row in enumerate(steps):
            np.take(table, row, axis=1, out=x, mode="clip")
            np.matmul(recur, h, out=y)
            both = x[:gate]
            both += y[:gate]
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            new *= reset
            new += x[gate:]
            np.tanh(new, out=new)
            state = out[t]
            np.subtract(h, new, out=state)
            state *= update
            state += new
            h = state
        return out

    def forward(self, steps: np.ndarray) -> tuple[np.ndarray, list]:
        hidden = self.recur.shape[0]
        h, out, tape = np.zeros((steps.shape[1], hidden), np.float32), [], []
        for row in steps:
            x, y = self.table[row] + self.bias, h @ self.recur
            gates = 0.5 + 0.5 * np.tanh(0.5 * (x[:, : 2 * hidden] + y[:, : 2 * hidden]))
            z, r = gates[:, :hidden], gates[:, hidden:]
            n = np.tanh(x[:, 2 * hidden :] + r * y[:, 2 * hidden :])
            tape.append((h, z, r, n, y[:, 2 * hidden :]))
            h = n + z * (h - n)
            out.append(h)
        return np.stack(out), tape

    def backward(self, steps: np.ndarray, tape: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, recur and bias, given those of all states."""
        table, recur, bias = np.zeros_like(self.table), np.zeros_like(self.recur), np.zeros_like(self.bias)
        carried = np.zeros_like(grad[0])
        for t in range(len(steps) - 1, -1, -1):
            before, z, r, n, y = tape[t]
            d = grad[t] + carried
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (before - n) * z * (1 - z)
            dr = dn * y * r * (1 - r)
            into = np.concatenate([dz, dr, dn], axis=1)
            back = np.concatenate([dz, dr, dn * r], axis=1)
            recur += before.T @ back
            bias += into.sum(axis=0)
            np.add.at(table, steps[t], into)
            carried = d * z + back @ self.recur.T
        return [table, recur, bias]


@dataclass
class Model:
    langs: list[str]
    ahead: Direction | None = None
    behind: Direction | None = None
    out: np.ndarray | None = None
    shift: np.ndarray | None = None

    def window_probabilities(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(rows, languages): probabilities of a window's positions, added up over its first ``length`` bytes."""
        steps = np.ascontiguousarray(windows.T).astype(np.intp)
        hidden = self.ahead.recur.shape[0]
        a, b = self.ahead.states(steps), self.behind.states(steps[::-1])[::-1]
        logits = np.matmul(self.out[:hidden].T, a)
        logits += np.matmul(self.out[hidden:].T, b)
        logits += self.shift[:, None]
        np.exp(logits, out=logits)
        inside = np.arange(windows.shape[1])[:, None] < lengths
        logits *= (inside / logits.sum(axis=1))[:, None, :]
        return logits.sum(axis=0, dtype=np.float64).T

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages) mean over all positions; texts must not be empty."""
        total = np.zeros((len(texts), len(self.langs)))
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= BLOCK_BYTES):
                size += len(texts[end])
                end += 1
            part = texts[start:end]
            counts = np.array([-(-len(t) // WINDOW) for t in part])
            data = np.frombuffer(b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(part, counts)), np.uint8).reshape(-1, WINDOW)
            owner = np.repeat(np.arange(start, end), counts)
            lengths = np.full(len(data), WINDOW)
            lengths[np.cumsum(counts) - 1] = [len(t) - (n - 1) * WINDOW for t, n in zip(part, counts)]
            block = max(1, BLOCK_ROWS * FULL_LANGS // max(FULL_LANGS, len(self.langs)))
            for i in range(0, len(data), block):
                rows = slice(i, i + block)
                np.add.at(total, owner[rows], self.window_probabilities(data[rows], lengths[rows]))
            start = end
        return total / np.array([len(t) for t in texts])[:, None]


def train(windows: list[bytes], labels: list[int], langs: list[str], *, steps: int = STEPS, hidden: int = HIDDEN, seed: int = SEED) -> Model:
    """Adam on the mean cross-entropy of all positions."""
    rng = np.random.default_rng(seed)
    data = np.frombuffer(b"".join(w[:WINDOW].ljust(WINDOW, b"\0") for w in windows), np.uint8).reshape(-1, WINDOW)
    lengths, labels = np.array([min(len(w), WINDOW) for w in windows]), np.array(labels)
    model = Model(langs, Direction.fresh(rng, hidden), Direction.fresh(rng, hidden))
    model.out = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
    model.shift = np.zeros(len(langs), np.float32)
    weights = [model.ahead.table, model.ahead.recur, model.ahead.bias, model.behind.table, model.behind.recur, model.behind.bias, model.out, model.shift]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    by_lang = [np.flatnonzero(labels == k) for k in range(len(langs))]
    for step in range(1, steps + 1):
        # with more languages than places, each step takes other languages
        turn = by_lang if len(langs) <= BATCH else [by_lang[k] for k in rng.choice(len(langs), BATCH, replace=False)]
        picked = np.concatenate([rng.choice(rows, max(1, BATCH // len(langs))) for rows in turn])
        x, y, n = np.ascontiguousarray(data[picked].T), labels[picked], lengths[picked]
        a, tape_a = model.ahead.forward(x)
        b, tape_b = model.behind.forward(x[::-1])
        both = np.concatenate([a, b[::-1]], axis=2)
        logits = both @ model.out + model.shift
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(len(y)), y] -= 1
        p *= ((np.arange(WINDOW)[:, None] < n) / n.sum())[:, :, None]
        p = p.astype(np.float32)
        back = p @ model.out.T
        grads = [
            *model.ahead.backward(x, tape_a, back[:, :, :hidden]), *model.behind.backward(x[::-1], tape_b, back[::-1, :, hidden:]),
            both.reshape(-1, 2 * hidden).T @ p.reshape(-1, p.shape[2]), p.sum(axis=(0, 1)),
        ]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def fit(docs: DataFrame, *, train_on: Column | None = None, docs_per_lang: int = DOCS_PER_LANG, seed: int = SEED) -> Model:
    """Model from the rows of ``docs`` where ``train_on`` holds and text and lang are there.

    The sample is by a hash of the id, with a rate per language that is lower with more than
    ``FULL_LANGS`` of them; the document of the least hash is always in it. Only windows of it
    reach the driver: about ``FULL_LANGS * docs_per_lang`` documents, or one of each language
    if that is more, of ``WINDOWS_PER_DOC * WINDOW`` characters each.
    """
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (train_on if train_on is not None else F.lit(True)))
    usable = usable.select("doc_id", "text", "lang").filter(F.col("text").rlike(r"\p{L}"))
    usable = usable.withColumn("_u", unit_hash(seed, F.col("doc_id")))
    counts = written(usable.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"), F.min("_u").alias("_least")), "langid-counts")
    langs = sorted(r["_lang"] for r in counts.select("_lang").collect())
    if not langs:
        return Model([])
    wanted = docs_per_lang * min(1.0, FULL_LANGS / len(langs))
    spots = F.transform(F.sequence(F.lit(1), F.lit(WINDOWS_PER_DOC)), lambda i: F.pmod(
        F.xxhash64("doc_id", i, F.lit(seed)), F.greatest(F.length("text") - WINDOW + 1, F.lit(1)).cast("bigint")).cast("int") + 1)
    rows = (
        usable.join(F.broadcast(counts), F.col("lang") == F.col("_lang"))  # a row for each language
        .filter((F.col("_u") < F.lit(wanted) / F.col("_n")) | (F.col("_u") == F.col("_least")))
        .select("doc_id", "lang", F.explode(F.transform(F.array_distinct(spots), lambda s: F.col("text").substr(s, F.lit(WINDOW)))).alias("w"))
        .orderBy("doc_id", "lang", "w").collect()
    )
    index = {lang: i for i, lang in enumerate(langs)}
    grown = growth(len(langs))
    return train(
        [r["w"].encode() for r in rows], [index[r["lang"]] for r in rows], langs,
        steps=round(STEPS * grown), hidden=math.ceil(HIDDEN * grown), seed=seed,
    )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language over all bytes of the text."""
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model.langs:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))

    @F.pandas_udf("lang string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        rows = np.flatnonzero(texts.notna().to_numpy())
        out = pd.DataFrame({"lang": UNKNOWN, "score": 0.0}, index=texts.index)
        if len(rows):
            names = np.array(model.langs, dtype=object)
            share = max(1, CELLS // len(names))
            for i in range(0, len(rows), share):
                part = rows[i : i + share]
                p = model.document_probabilities([t.encode() for t in texts.iloc[part]])
                best = p.argmax(axis=1)
                out.iloc[part, 0] = names[best]
                out.iloc[part, 1] = np.clip(p[np.arange(len(best)), best], 0.0, 1.0)
        return out

    said = docs.withColumn("_said", label(F.when(known, F.col("text"))))
    return said.withColumn("lang_pred", F.col("_said.lang")).withColumn("score", F.col("_said.score")).drop("_said")
