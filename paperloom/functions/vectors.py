"""Arithmetic on array columns: distances, expected scores, class choice."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .core import bind, col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(
        col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cosine; a zero vector is at distance 1 from everything."""
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return bind(norm, lambda n: F.when(n > 0, 1 - dot(a, b) / n).otherwise(F.lit(1.0)))


def ev_ordinal(logits: Column | str) -> Column:
    """Expected level from cumulative logits: 1 + sum of sigmoids."""
    return F.aggregate(
        col(logits).cast("array<double>"),
        F.lit(1.0),
        lambda acc, x: acc + 1 / (1 + F.exp(-x)),
    )


def ev_softmax(logits: Column | str) -> Column:
    """Expected level under the softmax of one logit per level (levels 1..n)."""

    def expected(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        weighted = F.transform(e, lambda x, i: x * (i + 1))
        return F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x) / total

    scores = col(logits).cast("array<double>")
    shifted = bind(scores, lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))
    return bind(shifted, expected)


def ev_blend(ev_ord: Column | str, ev_ce: Column | str, gamma: float = 0.6) -> Column:
    return col(ev_ord) * gamma + col(ev_ce) * (1 - gamma)


def argmax_label(probabilities: Column | str) -> Column:
    """Zero-based index of the largest entry; the first one wins a tie."""
    p = col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")
