"""Column expressions: null tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of ``columns`` is null."""
    if not columns:
        raise ValueError("any_null needs at least one column")
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
