"""Vector and set similarity as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(x: Column, y: Column) -> Column:
    return _sum(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")))


def norm(x: Column) -> Column:
    return F.sqrt(_sum(F.transform(x, lambda a: a.cast("double") * a.cast("double"))))


def cosine(x: Column, y: Column) -> Column:
    """0 where a vector is zero; within -1 and 1."""
    length = norm(x) * norm(y)
    return F.when(length == 0, 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(x, y) / length)))


def truncated(x: Column, dims: int) -> Column:
    """The first dims components at unit length; null for short, zero and non-finite vectors."""
    head = F.transform(F.slice(x, 1, dims), lambda a: a.cast("double"))
    length = norm(head)
    good = (F.size(x) >= dims) & (length > 0) & F.forall(head, lambda a: ~F.isnan(a) & (F.abs(a) != float("inf")))
    return F.when(good, F.transform(head, lambda a: a / length))


def runs(tokens: Column, n: int) -> Column:
    """The runs of n tokens in order, joined by blanks; none for fewer tokens. tokens should be a plain
    column, since the expression repeats it for each run."""
    size = F.size(tokens)
    out = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.when(size >= n, out).otherwise(F.array().cast("array<string>"))


def shingles(tokens: Column, n: int) -> Column:
    """The distinct runs of n tokens."""
    return F.array_distinct(runs(tokens, n))


def overlap(candidate: Column, source: Column) -> Column:
    """The share of the candidate's items that the source holds."""
    return F.size(F.array_intersect(candidate, source)) / F.greatest(F.lit(1), F.size(candidate))


def risk_level(exact: Column, run: Column, shared: Column, semantic: Column) -> Column:
    """Similarity risk: high, match or low."""
    return (
        F.when(exact | (run >= 12) | (shared >= 0.5) | (semantic >= 0.9), "high")
        .when(exact | (run >= 8) | (shared >= 0.2) | (semantic >= 0.8), "match")
        .otherwise("low")
    )
