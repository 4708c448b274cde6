"""Literals made of many values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def numbers(values: Sequence[float | int], kind: str = "double") -> Column:
    """An array literal as one foldable expression, whatever its length."""
    if not len(values):
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
