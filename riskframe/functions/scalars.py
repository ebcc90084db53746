"""Null-safe arithmetic. Everything stays a JVM expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    """A column by its exact name; names with dots or spaces are allowed."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def safe_div(num: Column, den: Column) -> Column:
    """num / den, null where den is 0 (ANSI mode would raise)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def at_least(c: Column, floor) -> Column:
    """Lower bound that keeps null (``greatest`` would skip it)."""
    return F.when(c < F.lit(floor), F.lit(floor)).otherwise(c)


def at_most(c: Column, cap) -> Column:
    return F.when(c > F.lit(cap), F.lit(cap)).otherwise(c)


def clamp(c: Column, low=None, high=None) -> Column:
    if low is not None:
        c = at_least(c, low)
    return at_most(c, high) if high is not None else c


def to_whole(c: Column) -> Column:
    """Half-even rounding, then long."""
    return F.bround(c.cast("double")).cast("long")


def add_all(terms: Sequence[Column]) -> Column:
    """Balanced-free sum of columns; an empty list gives 0."""
    return reduce(lambda a, b: a + b, terms) if terms else F.lit(0)


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def present(c: Column, dtype: str) -> Column:
    """The value with NaN turned into null; other types unchanged."""
    return F.when(~F.isnan(c), c) if dtype in ("double", "float") else c


def edge_code(c: Column, inner_edges: Sequence[float], closed_left: bool = True) -> Column:
    """Number of inner edges <= c (or < c); null stays null.

    Edges are literals, so the code is one generated expression without a join.
    """
    code = F.lit(0) * F.when(c.isNotNull(), 1)
    for e in inner_edges:
        code = code + ((c >= float(e)) if closed_left else (c > float(e))).cast("int")
    return code


def even_grid(low: float, high: float, n: int) -> list[float]:
    """n evenly spaced points with both ends included."""
    step = (high - low) / (n - 1)
    return [low + i * step for i in range(n - 1)] + [high]


def grid_code(c: Column, grid: Sequence[float]) -> Column:
    """Number of points of an even grid that are <= c.

    The guess comes from the step, then one look-up on each side repairs
    rounding, so cost does not depend on the grid length.
    """
    n = len(grid)
    low, step = grid[0], (grid[-1] - grid[0]) / (n - 1)
    points = F.array(*[F.lit(float(g)) for g in grid])
    guess = F.floor((c - F.lit(low)) / F.lit(step)) + F.lit(1)
    guess = F.greatest(F.lit(0), F.least(F.lit(n), guess)).cast("int")
    above = F.when((guess < n) & (F.try_element_at(points, guess + 1) <= c), 1).otherwise(0)
    below = F.when((guess > 0) & (F.try_element_at(points, F.greatest(guess, F.lit(1))) > c), 1).otherwise(0)
    return F.when(c.isNotNull(), guess + above - below)
