"""Exact quantiles with bounded state.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
so it cannot be used on large continuous columns. Here one pass sketches a narrow
bracket around every wanted rank; the next passes count values in cells that
split the brackets, until a cell that holds a wanted rank has a single value.
Each pass is one map-side combined aggregation whose result has at most
``features x ranks x cells`` rows, whatever the table size. The answer is
exact: a rank outside its bracket is simply looked for in the cell that has it.

Infinite values are ordinary values at the ends of the order: they are counted in the first pass, and the cells hold the finite
ones. Between an infinite and a finite value a quantile is infinite, between both infinities it is NaN.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions.frames import WIDE_LIMIT

_ACCURACY = 10_000
_MAX_CELL_ROWS = 200_000
_STRIDE = 4096
_INF = float("inf")


def _sql(values: Sequence[float]) -> list[str]:
    return [f"{float(v)!r}D" for v in values]


def _index_sql(v: str, intervals: Sequence[tuple[float, float]]) -> str:
    """Number of intervals that start at or below the value."""
    return " + ".join(["0", *[f"CAST({v} >= {lo} AS INT)" for lo in _sql([x for x, _ in intervals])]])


def _cell_sql(v: str, at: str, intervals: Sequence[tuple[float, float]], cells: int) -> str:
    """Code of the gap or sub-interval a value lies in, increasing with the value."""
    if not intervals:
        return "0L"
    pick = lambda values: f"element_at(array({', '.join(_sql(values))}), greatest({at}, 1))"
    lo, hi = pick([x * 0.5 for x, _ in intervals]), pick([y for _, y in intervals])
    # halves keep the width of the widest interval finite; a one-value interval has no parts
    width = pick([(y * 0.5 - x * 0.5) or 1.0 for x, y in intervals])
    part = f"least({cells - 1}, floor(({v} * 0.5D - {lo}) / {width} * {float(cells)!r}D))"
    gap = f"2L * {at} * {_STRIDE}"
    return f"CASE WHEN {at} > 0 AND {v} <= {hi} THEN {gap} - {_STRIDE} + {part} ELSE {gap} END"


def _merge(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(set(intervals)):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _count_cells(base: DataFrame, intervals: Mapping[int, list], cells: int) -> dict[int, list]:
    """{feature: [(count, min, max), ...] in value order} from one job."""
    # the index is a projection of its own so that its comparisons are generated once
    indexed = base.selectExpr(*[f"v{i}" for i in intervals],
                              *[f"{_index_sql(f'v{i}', iv)} AS at{i}" for i, iv in intervals.items()])
    items = ", ".join(f"struct({i} AS f, v{i} AS v, {_cell_sql(f'v{i}', f'at{i}', iv, cells)} AS cell)"
                      for i, iv in intervals.items())
    rows = (
        indexed.selectExpr(f"inline(array({items}))")
        .where("v is not null")
        .groupBy("f", "cell").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    out: dict[int, list] = {i: [] for i in intervals}
    for r in sorted(rows, key=lambda r: (r.f, r.cell)):
        out[r.f].append((r.n, r.lo, r.hi))
    return out


def exact_quantiles(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float],
                    approx: bool = False) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per named column; None when no value is present.

    The input is scanned about three times: stage it first if it is costly.
    ``approx=True`` stops after the sketch.
    """
    names = list(values)
    if not names:
        return {}
    def clean(c: Column) -> Column:
        d = c.cast("double")
        return F.when(d.isNotNull() & ~F.isnan(d), d)
    every = df.select(*[clean(values[n]).alias(f"r{i}") for i, n in enumerate(names)])
    finite = [F.when(F.abs(F.col(f"r{i}")) < F.lit(_INF), F.col(f"r{i}")).alias(f"v{i}") for i in range(len(names))]
    base = every.select("*", *finite)

    probes: list[float] = []
    for p in probs:
        probes += [p] if approx else [max(0.0, p - 2 / _ACCURACY), min(1.0, p + 2 / _ACCURACY)]
    stats: dict[int, tuple] = {}
    per = WIDE_LIMIT // 6
    for start in range(0, len(names), per):
        idx = range(start, min(start + per, len(names)))
        sketch = ", ".join(_sql(probes))
        row = base.selectExpr(*[x for i in idx for x in (
            f"count(r{i})", f"min(v{i})", f"max(v{i})", f"percentile_approx(r{i}, array({sketch}), {_ACCURACY})",
            f"count_if(r{i} = double('-infinity'))", f"count(v{i})")]).first()
        for j, i in enumerate(idx):
            stats[i] = tuple(row[6 * j:6 * j + 6])

    if approx:
        return {n: (list(stats[i][3]) if stats[i][0] else [None] * len(probs)) for i, n in enumerate(names)}

    wanted: dict[int, set[int]] = {}
    found: dict[tuple[int, int], float] = {}
    intervals: dict[int, list[tuple[float, float]]] = {}
    for i, (n, lo, hi, sketch, below, inside) in stats.items():
        if not n:
            continue
        ranks = set()
        brackets = []
        for k, p in enumerate(probs):
            h = p * (n - 1)
            ranks |= {math.floor(h), math.ceil(h)}
            if inside:
                a = lo if p - 2 / _ACCURACY <= 0 else sketch[2 * k]
                b = hi if p + 2 / _ACCURACY >= 1 else sketch[2 * k + 1]
                brackets.append((min(max(a, lo), hi), min(max(b, lo), hi)))
        found.update({(i, r): -_INF for r in ranks if r < below})
        found.update({(i, r): _INF for r in ranks if r >= below + inside})
        for known, value in ((below, lo), (below + inside - 1, hi)):
            if inside and known in ranks:
                found[i, known] = value
        wanted[i] = {r for r in ranks if (i, r) not in found}
        if wanted[i]:
            if lo == hi:
                found.update({(i, r): lo for r in wanted[i]})
                wanted[i] = set()
            else:
                intervals[i] = _merge(brackets)

    while intervals:
        total = sum(len(v) for v in intervals.values())
        cells = max(16, min(1024, _MAX_CELL_ROWS // max(1, total)))
        counted = _count_cells(base, intervals, cells)
        nxt: dict[int, list[tuple[float, float]]] = {}
        for i, cell_rows in counted.items():
            before, open_cells = stats[i][4], []  # ranks count the infinite values below
            for n, lo, hi in cell_rows:
                inside = [r for r in wanted[i] if before <= r < before + n]
                for r in inside:
                    if lo == hi or r == before:
                        found[i, r] = lo
                    elif r == before + n - 1:
                        found[i, r] = hi
                if any((i, r) not in found for r in inside):
                    open_cells.append((lo, hi))
                before += n
            wanted[i] = {r for r in wanted[i] if (i, r) not in found}
            if open_cells:
                nxt[i] = _merge(open_cells)
        intervals = nxt

    out: dict[str, list[float | None]] = {}
    for i, name in enumerate(names):
        n = stats[i][0]
        if not n:
            out[name] = [None] * len(probs)
            continue
        vals = []
        for p in probs:
            h = p * (n - 1)
            a, b = found[i, math.floor(h)], found[i, math.ceil(h)]
            part = h - math.floor(h)
            if math.isinf(a) or math.isinf(b):
                vals.append(a if part == 0 or a == b or math.isinf(a) and not math.isinf(b) else b if not math.isinf(a) else float("nan"))
            else:
                vals.append(a + (b - a) * part)
        out[name] = vals
    return out


def class_quantiles(df: DataFrame, by: Column, classes: Sequence, values: Mapping[str, Column],
                    probs: Sequence[float]) -> dict[tuple, list[float | None]]:
    """Quantiles per (class, column) for a short list of classes."""
    spread = {}
    for c in classes:
        for n, v in values.items():
            spread[f"{len(spread)}"] = ((c, n), F.when(by == F.lit(c), v))
    res = exact_quantiles(df, {k: e for k, (_, e) in spread.items()}, probs)
    return {spread[k][0]: q for k, q in res.items()}
