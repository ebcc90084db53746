"""Row-wise features: one projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions import rowwise
from riskframe.functions.frames import value_of
from riskframe.functions.scalars import add_all, at_least, col, flag, safe_div

DAYS_PER_YEAR = 365.25


def add_ratios(df: DataFrame, ratios: Sequence[tuple]) -> DataFrame:
    """``(name, numerator, denominator[, floor numerator too])``; denominators are floored at 1."""
    exprs = {}
    for name, num, den, *floor_num in ratios:
        top = at_least(col(num).cast("double"), 1.0) if floor_num and floor_num[0] else col(num).cast("double")
        exprs[name] = top / at_least(col(den).cast("double"), 1.0)
    return df.withColumns(exprs)


def financial_ratios(df: DataFrame, income: str, credit: str, annuity: str, members: str, children: str) -> DataFrame:
    return add_ratios(df, [
        ("CREDIT_INCOME_RATIO", credit, income),
        ("ANNUITY_INCOME_RATIO", annuity, income),
        ("CREDIT_ANNUITY_RATIO", credit, annuity),
        ("INCOME_PER_PERSON", income, members, True),
        ("PAYMENT_RATE", annuity, credit, True),
        ("CHILDREN_RATIO", children, members),
    ])


def goods_ratios(df: DataFrame, credit: str, goods: str, annuity: str) -> DataFrame:
    """Goods value against credit, credit above goods, and duration in annuities."""
    c = at_least(col(credit).cast("double"), 1.0)
    a = at_least(col(annuity).cast("double"), 1.0)
    out = {}
    if goods in df.columns:
        g = at_least(F.coalesce(col(goods), col(credit)).cast("double"), 1.0)
        out = {"GOODS_PRICE_CREDIT_RATIO": g / c, "CREDIT_OVER_GOODS": at_least(c - g, 0.0)}
    return df.withColumns({**out, "CREDIT_DURATION_MONTHS": c / a})


def day_offsets(df: DataFrame, years: Mapping[str, str], ratio: tuple[str, str, str] | None = None) -> DataFrame:
    """``years``: output -> column of negative day offsets (absent columns are skipped);
    ``ratio``: (output, numerator output, denominator output), guarded by 1e-8."""
    out = df.withColumns({n: -col(c).cast("double") / F.lit(DAYS_PER_YEAR)
                          for n, c in years.items() if c in df.columns})
    if ratio:
        name, num, den = ratio
        out = out.withColumn(name, safe_div(F.col(num), F.col(den) + F.lit(1e-8)))
    return out


def floored_ratios(df: DataFrame, ratios: Sequence[tuple[str, str, str, float]]) -> DataFrame:
    """``(name, numerator, denominator, floor of the denominator)``."""
    return df.withColumns({n: col(a).cast("double") / at_least(col(b).cast("double"), float(f)) for n, a, b, f in ratios})


def row_stats(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """Mean, min, max and sample std over the columns present in the table; std null -> 0."""
    have = [value_of(df, c) for c in cols if c in df.columns]
    if not have:
        return df
    return df.withColumns({
        f"{prefix}_MEAN": rowwise.row_mean(have), f"{prefix}_MIN": rowwise.row_min(have),
        f"{prefix}_MAX": rowwise.row_max(have), f"{prefix}_STD": F.coalesce(rowwise.row_std(have), F.lit(0.0))})


def row_stats_ext(df: DataFrame, cols: Sequence[str], prefix: str, per: str | None = None) -> DataFrame:
    """Row product, number of nulls and, with ``per``, mean / max(per, 0.01)."""
    have = [value_of(df, c) for c in cols if c in df.columns]
    out = {f"{prefix}_PROD": rowwise.row_product(have), f"{prefix}_N_MISS": rowwise.row_nulls(have)}
    if per:
        out[f"{prefix}_PER"] = rowwise.row_mean(have) / at_least(col(per).cast("double"), 0.01)
    return df.withColumns(out)


def prefix_sums(df: DataFrame, families: Mapping[str, str]) -> DataFrame:
    """``families``: output -> column prefix; nulls count as 0; empty families are skipped."""
    out = {}
    for name, prefix in families.items():
        cols = [c for c in df.columns if c.startswith(prefix)]
        if cols:
            out[name] = add_all([F.coalesce(value_of(df, c), F.lit(0)) for c in cols])
    return df.withColumns(out) if out else df


def prefix_zero_counts(df: DataFrame, families: Mapping[str, str], subsets: Mapping[str, Sequence[str]] = ()) -> DataFrame:
    """Zeros per family, and sums of named subsets."""
    out = {}
    for name, prefix in families.items():
        cols = [c for c in df.columns if c.startswith(prefix)]
        if cols:
            out[name] = add_all([flag(col(c) == 0) for c in cols])
    for name, cols in dict(subsets).items():
        out[name] = add_all([F.coalesce(value_of(df, c), F.lit(0)) for c in cols if c in df.columns])
    return df.withColumns(out)


def safe_rate(df: DataFrame, name: str, events: str, exposure: str) -> DataFrame:
    """events / max(exposure, 1); absent columns count as 0."""
    e = col(events).cast("double") if events in df.columns else F.lit(0.0)
    x = col(exposure).cast("double") if exposure in df.columns else F.lit(0.0)
    return df.withColumn(name, e / at_least(x, 1.0))


def interactions(df: DataFrame, specs: Sequence[tuple[str, Sequence[str], callable]]) -> DataFrame:
    """``(name, needed columns, f(*columns))``; skipped when an input is absent."""
    have = set(df.columns)
    out = {n: fn(*[col(c).cast("double") for c in need]) for n, need, fn in specs if set(need) <= have}
    return df.withColumns(out) if out else df


def cross_table_features(df: DataFrame, income: str, credit: str, debt: str, total_credit: str,
                         refusal_rate: str, credit_income: str, on_time: str, late_share: str) -> DataFrame:
    """Interactions over joined child aggregates."""
    one = lambda c: at_least(c, 1.0)
    return interactions(df, [
        ("TOTAL_DEBT_TO_INCOME", [debt, credit, income], lambda d, c, i: (d + c) / one(i)),
        ("BUREAU_DEBT_TO_NEW_CREDIT", [debt, credit], lambda d, c: d / one(c)),
        ("COMPOUND_RISK_SCORE", [refusal_rate, credit_income], lambda r, c: r * c),
        ("PAYMENT_RELIABILITY", [on_time, late_share], lambda t, l: t * (F.lit(1.0) - l)),
        ("BUREAU_COVERAGE_RATIO", [total_credit, credit], lambda t, c: t / one(c)),
    ])


def payment_features(df: DataFrame, due: str, paid: str, due_day: str, paid_day: str) -> DataFrame:
    """Payment ratio, days early (+) or late (-), days late, and on-time (null counts as late)."""
    early = (col(due_day) - col(paid_day)).cast("double")
    return df.withColumns({
        "payment_ratio": col(paid).cast("double") / at_least(col(due).cast("double"), 1.0),
        "days_early_late": early,
        "days_late": at_least(-early, 0.0),
        "paid_on_time": F.coalesce(early >= 0, F.lit(False)),
    })
