"""Array-of-number expressions: dot products, softmax, argmax, top-n, parity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it inside ``body``, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vec), F.lit(0.0), lambda s, x: s + x * x))


def normalise(vec: Column) -> Column:
    """v / ‖v‖ as doubles; NULL stays NULL."""
    return let(norm(vec), lambda length: F.transform(as_double(vec), lambda x: x / length))


def best_dot(vec: str, prompts: str) -> Column:
    """Largest dot product with any vector of an array of vectors."""
    best = F.array_max(F.transform(F.col(prompts), lambda p: dot(p, F.col(vec))))
    return F.when(F.col(vec).isNotNull(), best)


def softmax(logits: Column) -> Column:
    """Stable softmax: shift by the maximum, exponentiate, divide by the sum."""
    def scaled(peak: Column) -> Column:
        return F.transform(as_double(logits), lambda x: F.exp(x - peak))

    def divided(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda s, x: s + x)
        return let(total, lambda t: F.transform(exps, lambda e: e / t))

    return let(F.array_max(as_double(logits)), lambda peak: let(scaled(peak), divided))


def argmax(vec: Column) -> Column:
    """0-based index of the maximum, first one on ties."""
    return (F.array_position(vec, F.array_max(vec)) - 1).cast("int")


def class_name(index: Column, names: Column) -> Column:
    """Name of a 0-based class index, ``class_<i>`` when the list has no such entry."""
    return F.coalesce(F.get(names, index), F.concat(F.lit("class_"), index.cast("string")))


def top_n(probs: Column, n: int, names: Column) -> Column:
    """Array of (species, confidence, rank) for the n best classes, n in [1, classes].

    Ties keep the lower class index first.
    """
    pairs = F.transform(probs, lambda p, i: F.struct((-p).alias("neg"), i.alias("idx")))
    wanted = F.greatest(F.lit(1), F.least(F.lit(n), F.size(probs)))
    best = F.slice(F.array_sort(pairs), F.lit(1), wanted)
    return F.transform(
        best,
        lambda b, r: F.struct(
            class_name(b["idx"], names).alias("species"),
            (-b["neg"]).alias("confidence"),
            (r + 1).cast("int").alias("rank"),
        ),
    )


def valid_prediction(item: Column) -> Column:
    """Checks of one top-n entry: confidence in [0, 1], rank at least 1."""
    return item["confidence"].between(0.0, 1.0) & (item["rank"] >= 1)


def max_abs_diff(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(as_double(a), as_double(b), lambda x, y: F.abs(x - y)))
