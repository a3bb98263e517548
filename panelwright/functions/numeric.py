"""Numeric column helpers with an explicit zero-division policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div_inf(num, den) -> Column:
    """num/den with pandas' float semantics: x/0 is +-Infinity (0/0 is NaN
    there; here a zero deviation stays 0 and NaN never enters the engine). Spark's ANSI division
    would raise and ``try_divide`` would lose the sign of the extreme."""
    num, den = _c(num), _c(den)
    inf = F.lit(float("inf"))
    return (F.when(den != 0, num / den)
            .when(num > 0, inf)
            .when(num < 0, -inf)
            .when(num == 0, F.lit(0.0))
            .otherwise(F.lit(None).cast("double")))


def trunc_int(c) -> Column:
    """Truncate toward zero to int (NULL stays NULL)."""
    return _c(c).cast("int")


def round6(c) -> Column:
    return F.round(_c(c), 6)


def argmax(arr) -> Column:
    """0-based index of the largest element of an array."""
    a = _c(arr)
    return F.array_position(a, F.array_max(a)) - 1
