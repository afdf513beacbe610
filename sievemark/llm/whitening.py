"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Entries become integers, so sums and the scatter about the rounded mean are exact whatever the
partitions; only d values and then d(d+1)/2 values reach the driver, as many for any number of
rows. The triangular factor L (V = L Lᵀ) is made orthogonal in its columns by plane rotations
from the right: the norms of the rotated columns are the roots of the eigenvalues, the
normalised columns the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A product sum travels as signed digits of this many bits, so that any sum of them fits a long.
DIGIT = 40
DIGITS = 5
LIMB = 16
#: Rows whose limb products are summed in doubles at once: below 2**53.
EXACT_ROWS = 1 << 20
SCALE, OFFSET = 64, 1_000_000


@dataclass(frozen=True)
class Whitening:
    """Fitted on n vectors: integer sums by dimension, components as rows, their eigenvalues, trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> tuple[int, ...]:
        """Sums about ``middle``: 0 to n - 1."""
        return tuple(s - self.n * (s // self.n) for s in self.sums)


def integers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry; entries beyond the range of long take its ends less the offset."""
    top = float(1 << 62)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), c.cast("double") * SCALE))) + OFFSET)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not NULL, holds entries, and only finite ones."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(F.coalesce(finite & (F.size(vector) > 0), F.lit(False)))


def digits(value: int) -> list[int]:
    """``value`` in signed digits of base 2**DIGIT; the last takes what is left."""
    out, sign, value = [], -1 if value < 0 else 1, abs(value)
    for _ in range(DIGITS - 1):
        out.append(sign * (value & ((1 << DIGIT) - 1)))
        value >>= DIGIT
    return [*out, sign * value]


def product_sums(z: np.ndarray) -> np.ndarray:
    """Exact Σ zᵢ zⱼ over the rows of an integer matrix, as Python integers."""
    size, sign = np.abs(z.astype(object)) if z.min(initial=0) == np.iinfo(np.int64).min else np.abs(z), np.sign(z)
    total = np.zeros((z.shape[1], z.shape[1]), object)
    limbs = []
    for k in range(64 // LIMB):
        part = ((size >> (LIMB * k)) & ((1 << LIMB) - 1)).astype(np.float64) * sign
        if part.any():
            limbs.append((k, part))
    for k, a in limbs:
        for m, b in limbs:
            total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (k + m))
    return total


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in column]) if len(column) else np.zeros((0, 0), np.int64)


def scatter(middle: np.ndarray):
    """Rows → digits of the product sums about ``middle``, one row per pair of dimensions and task."""
    d = len(middle)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d), object)
        for frame in frames:
            for start in range(0, len(frame), EXACT_ROWS):
                total += product_sums(matrix(frame["x"].iloc[start : start + EXACT_ROWS]) - middle)
        rows = [(i, j, *digits(int(total[i, j]))) for i, j in pairs if total[i, j]]
        if rows:
            yield pd.DataFrame(rows, columns=["i", "j", *[f"d{k}" for k in range(DIGITS)]])

    return run


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with V = L Lᵀ, one column per pivot, largest remaining diagonal first.

    Ends where no more than rounding is left of any diagonal entry, each measured by itself:
    dimensions of very different size keep their own.
    """
    left = v.diagonal().copy()
    least = 4 * len(v) * np.finfo(float).eps * v.diagonal()
    columns: list[np.ndarray] = []
    for _ in range(len(v)):
        p = int(np.where(left > least, left, -1.0).argmax())
        if left[p] <= least[p]:
            break
        column = v[:, p].copy()
        for c in columns:
            column -= c * c[p]
        column /= np.sqrt(column[p])
        columns.append(column)
        left -= column**2
        left[p] = 0.0
    return np.array(columns).T.reshape(len(v), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``factor`` rotated in planes until every two are orthogonal to rounding."""
    columns = factor.T.copy()
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p in range(len(columns) - 1):
            for q in range(p + 1, len(columns)):
                a, b, c = columns[p] @ columns[p], columns[q] @ columns[q], columns[p] @ columns[q]
                if abs(c) <= eps * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * c)
                t = np.copysign(1.0, zeta) / (abs(zeta) + np.hypot(1.0, zeta))
                cosine = 1 / np.hypot(1.0, t)
                x, y = columns[p].copy(), columns[q].copy()
                columns[p], columns[q] = cosine * (x - t * y), cosine * (t * x + y)
        if not turned:
            break
    return columns.T


def fit(rows: DataFrame) -> Whitening | None:
    """From the column x (arrays of long of one length); None without rows.

    The driver gets one number per dimension, then one per pair of dimensions.
    """
    # Sums in two halves, so that no entry can overflow them.
    half = F.posexplode("x").alias("i", "x")
    sums = rows.select(half).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("x", 32)).alias("high"), F.sum(F.col("x").bitwiseAND(0xFFFFFFFF)).alias("low")
    ).collect()
    if not sums:
        return None
    n = sums[0]["n"]
    s = tuple((r["high"] << 32) + r["low"] for r in sorted(sums, key=lambda r: r["i"]))
    middle = np.array([v // n for v in s], np.int64)
    names = [f"d{k}" for k in range(DIGITS)]
    parts = rows.select("x").mapInPandas(scatter(middle), ", ".join(["i int", "j int", *[f"{c} long" for c in names]]))
    found = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names]).collect()
    d = len(s)
    rest = [v - n * (v // n) for v in s]
    exact = [[0] * d for _ in range(d)]
    for r in found:
        exact[r["i"]][r["j"]] = exact[r["j"]][r["i"]] = sum(r[c] << (DIGIT * k) for k, c in enumerate(names))
    v = np.array([[float(Fraction(n * exact[i][j] - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)])
    trace = float(sum(Fraction(n * exact[i][i] - rest[i] ** 2, n * n) for i in range(d)))
    unit = max(v.diagonal().max(initial=0.0), 0.0) or 1.0
    rotated = one_sided_jacobi(pivoted_cholesky(v / unit))
    norms = np.linalg.norm(rotated, axis=0)
    order = np.argsort(-norms, kind="stable")
    components = (rotated / norms).T[order]
    return Whitening(n, s, components, norms[order] ** 2 * unit, trace)


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """x - S / n in double: the exact distance to the rounded mean, then the rest of the mean."""
    return (x - model.middle).astype(np.float64) - np.array([r / model.n for r in model.rest])


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Exact Σ (n x - S)²; None where it exceeds a long."""
    z = x - model.middle
    small = int(np.abs(z).max(initial=0)) * model.n + model.n < 1 << 28 and x.shape[1] < 1 << 6
    z = z if small else z.astype(object)
    total = ((model.n * z - np.array(model.rest, z.dtype)) ** 2).sum(axis=1)
    return [int(t) if t < 1 << 63 else None for t in total]


def project(model: Whitening, components: int):
    wide = (model.components[:components] / np.sqrt(model.eigenvalues[:components])[:, None]).T

    def apply(x: pd.Series) -> pd.DataFrame:
        rows = matrix(x)
        if not len(rows):
            return pd.DataFrame({"whitened": [], "deviation": []})
        return pd.DataFrame({"whitened": list(centred(rows, model) @ wide), "deviation": pd.array(deviations(rows, model), "Int64")})

    return F.pandas_udf(apply, "struct<whitened: array<double>, deviation: long>")


def grams(model: Whitening, components: int):
    """Rows → sums and product sums of whitened entries, one row per pair and task; j = -1 is the sum."""
    wide = (model.components[:components] / np.sqrt(model.eigenvalues[:components])[:, None]).T
    k = wide.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for frame in frames:
            w = centred(matrix(frame["x"]), model) @ wide
            total, sums = total + w.T @ w, sums + w.sum(axis=0)
        yield pd.DataFrame([(i, -1, sums[i]) for i in range(k)] + [(i, j, total[i, j]) for i in range(k) for j in range(i, k)], columns=["i", "j", "v"])

    return run


def identity_error(rows: DataFrame, model: Whitening, components: int) -> float:
    """Largest absolute entry of (covariance of the whitened vectors - identity), measured on the vectors."""
    found = rows.select("x").mapInPandas(grams(model, components), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    value = {(r["i"], r["j"]): r["v"] / model.n for r in found}
    return max(abs(v - value[i, -1] * value[j, -1] - (i == j)) for (i, j), v in value.items() if j >= 0)


def whiten(vectors: DataFrame, components: int = 32, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, whitened (array), deviation of every usable row, with n, explained (array) and identity_error.

    Rows whose vector is NULL, empty or holds NULL or non-finite entries take no part. All others
    are fitted on; vectors of a length other than the most frequent one (the longer of two) have
    no common covariance and take no part either. Repeated ids and rows are rows of their own, a
    NULL id stays. There are as many components as the covariance has rank, ``components`` at
    most: with one row, or equal rows only, arrays are empty; an empty table gives no rows.
    ``deviation`` is NULL where it exceeds a long. Deviations that differ by more than 15 digits
    between dimensions are beyond a double's components. Further columns are not read.
    """
    read = usable(vectors.select(F.col(id).alias(id), F.col(vector).alias(vector)), vector)
    sizes = read.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    schema = f"{id} {vectors.schema[id].dataType.simpleString()}, whitened array<double>, deviation long, n long, explained array<double>, identity_error double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = read.filter(F.size(vector) == sizes[0]["d"]).select(id, integers(F.col(vector)).alias("x"))
    model = fit(rows)
    kept = min(components, len(model.eigenvalues))
    error = identity_error(rows, model, kept) if kept else 0.0
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:kept]]).cast("array<double>")
    return rows.select(id, project(model, kept)("x").alias("w")).select(
        id, "w.whitened", "w.deviation", F.lit(model.n).cast("long").alias("n"), explained.alias("explained"), F.lit(float(error)).alias("identity_error")
    )
