"""Quality classifier as a sparse rule ensemble.

Statistics of the text are column expressions. Small trees are grown on bootstrap samples
of labelled rows; each path from a root to a node is a rule (a conjunction of comparisons);
a lasso logistic regression keeps few rules; these become one column expression, so that
scoring runs inside Spark without Python.

Learning uses about ``MAX_ROWS`` labelled rows, chosen by a hash of the id, of which only
the statistics reach the driver. NULL text counts as empty; all statistics are 0 then. If
nothing can be learned every score is 0. An id with several labels counts with the
majority. Repeated rows get equal scores; other columns are carried untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import labelled_sample

MAX_ROWS = 20_000
TREES, DEPTH, BINS, LEAF = 24, 3, 32, 15
#: Rows drawn for a tree.
TREE_ROWS = 4000
L1, STEPS = 0.002, 600
THRESHOLD = 0.7
SEED = 23


def statistics(text: Column) -> dict[str, Column]:
    """Name → column, over a text that is not NULL."""
    chars = F.length(text)
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(chars, F.lit(1))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    return {
        "chars": chars.cast("double"),
        "words": F.size(words).cast("double"),
        "word_chars": chars / F.greatest(F.size(words), F.lit(1)),
        "distinct_words": F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_words": F.size(words) / F.size(lines),
        "upper": share("[A-Z]"),
        "digits": share("[0-9]"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:!?'()\"-]"),
        "shouts": share("[!?]"),
        "stops": share(r"[.!?](?=\s|$)"),
    }


@dataclass(frozen=True)
class Rule:
    """Conjunction of (statistic, above?, bound)."""

    terms: tuple

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        parts = [(x[:, names.index(n)] > b) if above else (x[:, names.index(n)] <= b) for n, above, b in self.terms]
        return np.logical_and.reduce(parts)

    def column(self, stats: str) -> Column:
        parts = [F.col(f"{stats}.{n}") > F.lit(b) if above else F.col(f"{stats}.{n}") <= F.lit(b) for n, above, b in self.terms]
        return reduce(lambda a, b: a & b, parts)


@dataclass
class Ensemble:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0
    fitted: bool = False

    def column(self, stats: str = "_stats") -> Column:
        """Score in (0, 1) as one expression over a struct column of statistics."""
        total = reduce(lambda a, b: a + b, [F.when(r.column(stats), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights)], F.lit(self.bias))
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(x: np.ndarray, y: np.ndarray, names: list[str], rng: np.random.Generator, depth: int, bins: int, leaf: int) -> list[Rule]:
    """All root-to-node paths of one tree, split by variance over quantile bounds of some statistics."""
    found: list[Rule] = []

    def grow(rows: np.ndarray, terms: tuple) -> None:
        if terms:
            found.append(Rule(terms))
        if len(terms) == depth or len(rows) < 2 * leaf or y[rows].min() == y[rows].max():
            return
        best = (0.0, None, None)
        for j in rng.choice(len(names), max(1, (2 * len(names)) // 3), replace=False):
            values = x[rows, j]
            for bound in np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])):
                left = values <= bound
                k = int(left.sum())
                if min(k, len(rows) - k) >= leaf:
                    gain = k * (len(rows) - k) * (y[rows][left].mean() - y[rows][~left].mean()) ** 2 / len(rows)
                    if gain > best[0]:
                        best = (gain, j, bound)
        if best[1] is None:
            return
        _, j, bound = best
        left = x[rows, j] <= bound
        grow(rows[left], (*terms, (names[j], False, float(bound))))
        grow(rows[~left], (*terms, (names[j], True, float(bound))))

    grow(np.arange(len(y)), ())
    return found


def lasso(a: np.ndarray, y: np.ndarray, l1: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty by accelerated proximal steps; the intercept is free."""
    n, k = a.shape
    design = np.hstack([a, np.ones((n, 1))])
    bound = 0.25 * np.linalg.norm(design.T @ design / n, 2)
    w = v = np.zeros(k + 1)
    w[k] = v[k] = np.log(y.mean() / (1 - y.mean()))
    momentum = 1.0
    for _ in range(steps):
        gradient = design.T @ (1 / (1 + np.exp(-design @ v)) - y) / n
        new = v - gradient / bound
        new[:k] = np.sign(new[:k]) * np.maximum(np.abs(new[:k]) - l1 / bound, 0)
        nextm = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new + (momentum - 1) / nextm * (new - w)
        w, momentum = new, nextm
    return w[:k], float(w[k])


def learn(x: np.ndarray, y: np.ndarray, names: list[str], *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
          leaf: int = LEAF, l1: float = L1, steps: int = STEPS, seed: int = SEED, tree_rows: int = TREE_ROWS) -> Ensemble:
    """Rules of all trees, each kept once for the rows it covers, weighed by the lasso.

    A tree grows on ``tree_rows`` rows drawn with replacement, or as many as there are; the lasso
    sees all rows.
    """
    rng = np.random.default_rng(seed)
    size = min(len(y), tree_rows)
    rules: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for _ in range(trees):
        rows = rng.choice(len(y), size)
        for rule in tree_rules(x[rows], y[rows], names, rng, depth, bins, leaf):
            held = rule.holds(x, names)
            rules.setdefault(np.packbits(held).tobytes(), (rule, held))
    if not rules:
        return Ensemble(bias=float(np.log(y.mean() / (1 - y.mean()))), fitted=True)
    design = np.column_stack([h for _, h in rules.values()]).astype(float)
    weights, bias = lasso(design, y, l1, steps)
    kept = [(r, float(w)) for (r, _), w in zip(rules.values(), weights) if w != 0]
    return Ensemble([r for r, _ in kept], [w for _, w in kept], bias, True)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", train_on: Column | None = None, max_rows: int = MAX_ROWS, seed: int = SEED) -> Ensemble:
    """Ensemble learned from ``labels`` (doc_id and a 0/1 column) where ``train_on``, a condition on them, holds."""
    stats = statistics(F.coalesce("text", F.lit("")))
    names = list(stats)
    rows = labelled_sample(docs, labels, label, train_on, max_rows, seed, [c.alias(n) for n, c in stats.items()]).collect()
    rows.sort(key=tuple)
    y = np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        return Ensemble()
    return learn(np.array([[r[n] for n in names] for r in rows], float), y, names, seed=seed)


def predict(docs: DataFrame, ensemble: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    if not ensemble.fitted:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    stats = statistics(F.coalesce("text", F.lit("")))
    own = "_stats"
    while own in docs.columns:  # a column of the user's stays as it is
        own += "_"
    scored = docs.withColumn(own, F.struct(*[c.alias(n) for n, c in stats.items()])).withColumn("score", ensemble.column(own)).drop(own)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
