"""Ordinal labels and score-to-label rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .core import col, trim_ws

LABELS = (1, 2, 3, 4, 5)
DEFAULT_CUTS = (1.5, 2.5, 3.5, 4.5)


def to_zero_based(label: Column | str) -> Column:
    return col(label) - 1


def to_one_based(label: Column | str) -> Column:
    return col(label) + 1


def clamp(x: Column | str, low: int = LABELS[0], high: int = LABELS[-1]) -> Column:
    """Null stays null: ``greatest`` and ``least`` alone would skip it."""
    return F.when(col(x).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col(x))))


def in_domain(label: Column | str) -> Column:
    return col(label).between(LABELS[0], LABELS[-1])


def ordinal_targets(label: Column | str) -> Column:
    """Cumulative indicators ``[y>1, y>2, y>3, y>4]`` as doubles."""
    y = col(label)
    return F.transform(
        F.array(*[F.lit(i) for i in LABELS[:-1]]), lambda i: (y > i).cast("double")
    )


def apply_thresholds(score: Column | str, cuts: Sequence[float] | Column = DEFAULT_CUTS) -> Column:
    """1 + the number of cut points at or below the score; null for a null score."""
    x = col(score)
    points = cuts if isinstance(cuts, Column) else F.array(*[F.lit(float(c)) for c in cuts])
    return F.when(x.isNotNull(), F.size(F.filter(points, lambda t: x >= t)) + 1)


def parse_llm_json(reply: Column | str) -> Column:
    """Struct ``(score, reason)`` of a saved model reply.

    Code fences are dropped; the score is cut to an integer and clamped to the label range. A score
    in quotes must be an integer. A reply that is not exactly one JSON object, or lacks a field, gives
    a null score and an error text; a reason that is null counts as given.
    """
    bare = trim_ws(F.replace(F.replace(col(reply), F.lit("```json"), F.lit("")),
                             F.lit("```"), F.lit("")))
    # Read as the only element of an array, so that text after the object makes it unreadable.
    listed = F.from_json(F.concat(F.lit("["), bare, F.lit("]")), "array<struct<score string, reason string>>")
    single = F.coalesce(F.size(listed) == 1, F.lit(False)) & bare.startswith("{")
    keys = F.coalesce(F.json_object_keys(F.when(single, bare)), F.array().cast("array<string>"))
    parsed = F.get(listed, F.lit(0))
    quoted = F.get_json_object(F.concat(F.lit('{"a":['), bare, F.lit("]}")), "$.a[*].score").startswith('"')
    text = F.when(~F.coalesce(quoted, F.lit(False)) | trim_ws(parsed["score"]).rlike("^[+-]?[0-9]+$"), parsed["score"])
    number = trim_ws(text).try_cast("double").try_cast("int")
    ok = single & number.isNotNull() & F.array_contains(keys, "reason")
    error = (
        F.when(~single, "invalid JSON")
        .when(~F.array_contains(keys, "score"), "missing score")
        .when(number.isNull(), "score is no number")
        .otherwise("missing reason")
    )
    return F.struct(
        F.when(ok, clamp(number)).alias("score"),
        F.when(ok, parsed["reason"]).otherwise(F.coalesce(error, F.lit("invalid JSON"))).alias("reason"),
    )
