"""Statistics across the columns of one row, nulls skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .scalars import add_all, flag, safe_div


def row_count(cols: Sequence[Column]) -> Column:
    return add_all([flag(c.isNotNull()) for c in cols])


def row_sum(cols: Sequence[Column]) -> Column:
    return add_all([F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols: Sequence[Column]) -> Column:
    return safe_div(row_sum(cols), row_count(cols))


def row_min(cols: Sequence[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def row_max(cols: Sequence[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def row_std(cols: Sequence[Column]) -> Column:
    """Sample standard deviation; null below two present values."""
    mean = row_mean(cols)
    ss = add_all([F.coalesce(F.pow(c.cast("double") - mean, 2), F.lit(0.0)) for c in cols])
    n = row_count(cols)
    return F.when(n > 1, F.sqrt(safe_div(ss, n - 1)))


def row_product(cols: Sequence[Column]) -> Column:
    out = F.lit(1.0)
    for c in cols:
        out = out * F.coalesce(c.cast("double"), F.lit(1.0))
    return out


def row_nulls(cols: Sequence[Column]) -> Column:
    return add_all([flag(c.isNull()) for c in cols])
