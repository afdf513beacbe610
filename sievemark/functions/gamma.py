"""Regularised incomplete gamma function as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stirling series of the log gamma function.
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
SHIFT = 12
HALF_LOG_TAU = 0.9189385332046727


def log_gamma(a: Column) -> Column:
    """ln Γ(a) for a > 0: Stirling's series at a + 12, brought back by the recurrence."""
    z = a + float(SHIFT)
    series = sum((F.lit(c) / F.pow(z, F.lit(float(2 * i + 1))) for i, c in enumerate(STIRLING)), F.lit(0.0))
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda s, i: s + F.log(a + i))
    return (z - 0.5) * F.log(z) - z + F.lit(HALF_LOG_TAU) + series - steps


def upper_gamma(a: Column, x: Column) -> Column:
    """Q(a, x) = Γ(a, x) / Γ(a) for a > 0, x >= 0; NULL otherwise.

    Below a + 1 by the series, above by the continued fraction; as many terms as a double
    needs, which is of the order of sqrt(a).
    """
    terms = F.sequence(F.lit(1), (F.lit(60) + F.ceil(F.sqrt(a) * 12)).cast("int"))
    scale = F.exp(a * F.log(x) - x - log_gamma(a))

    def term(state: Column, i: Column) -> Column:
        t = state["t"] * x / (a + i)
        return F.struct(t.alias("t"), (state["s"] + t).alias("s"))

    start = F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s"))
    lower = scale * F.aggregate(terms, start, term, lambda s: s["s"])

    def part(state: Column, i: Column) -> Column:
        # modified Lentz: numerators i (a - i), denominators x + 2 i + 1 - a
        top = (a - i) * i
        b = x + i * 2.0 + 1.0 - a
        d = F.lit(1.0) / (b + top * state["d"])
        c = b + top / state["c"]
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    first = F.lit(1.0) / (x + 1.0 - a)
    begin = F.struct(F.lit(1e300).alias("c"), first.alias("d"), first.alias("h"))
    upper = scale * F.aggregate(terms, begin, part, lambda s: s["h"])
    value = F.when(x < a + 1.0, 1.0 - lower).otherwise(upper)
    return F.when((a > 0) & (x == 0), 1.0).when((a > 0) & (x > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """P(chi² > statistic); NULL without a statistic or a degree of freedom."""
    x = statistic.cast("double")
    return upper_gamma(freedom.cast("double") / 2.0, F.when(x < 0, F.lit(0.0)).otherwise(x) / 2.0)
