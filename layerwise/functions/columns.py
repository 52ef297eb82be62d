"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often (or inside whichever lambda)
    the body uses it, also when the optimizer merges projections."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def literal_array(values) -> Column:
    """One literal array of doubles (a single call into the JVM)."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")
