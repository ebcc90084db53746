"""Cleaning that is learned on the training split and replayed on any table.

``fit_cleaning`` returns a small artefact; ``apply_cleaning`` turns it into
literals of one projection, so cleaning a batch or a stream needs no shuffle and
never looks at the data it cleans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.functions.frames import (
    dtype_of, long_form, numeric_columns, small_table, spread, string_columns, value_of, wide_agg,
)
from riskframe.functions.scalars import add_all, at_most, clamp, col, flag, safe_div, to_whole
from riskframe.operators.correlate import moment_exprs, strong_pairs
from riskframe.operators.quantiles import exact_quantiles

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class CleaningConfig:
    id_columns: tuple[str, ...]
    target: str
    missing_threshold: float = 0.45
    corr_threshold: float = 0.9
    near_constant_threshold: float = 0.95
    sentinels: tuple[tuple[str, str, float], ...] = ()  # (column, flag column, sentinel)
    zero_fill: tuple[str, ...] = ()
    constant_fill: Mapping[str, str] = field(default_factory=dict)
    median_fill: tuple[str, ...] = ()
    median_int: tuple[str, ...] = ()
    cast_int: tuple[str, ...] = ()
    bounds: Mapping[str, tuple] = field(default_factory=dict)

    def protected(self) -> set[str]:
        """Columns the structural drops must keep."""
        return ({*self.id_columns, self.target, *self.median_fill, *self.median_int, *self.zero_fill,
                 *self.constant_fill} | {f for _, f, _ in self.sentinels})


@dataclass
class CleaningArtifact:
    drop_missing: list[str] = field(default_factory=list)
    drop_corr: list[str] = field(default_factory=list)
    drop_near_constant: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple] = field(default_factory=dict)

    @property
    def dropped(self) -> list[str]:
        return [*self.drop_missing, *self.drop_corr, *self.drop_near_constant]

    def table(self, spark: SparkSession) -> DataFrame:
        """Long form: ``kind, column_name, value_double, value_string``."""
        rows = [("drop_missing", c, None, None) for c in self.drop_missing]
        rows += [("drop_corr", c, None, None) for c in self.drop_corr]
        rows += [("drop_near_constant", c, None, None) for c in self.drop_near_constant]
        rows += [("median", c, None if v is None else float(v), None) for c, v in self.medians.items()]
        rows += [("mode", c, None, v) for c, v in self.modes.items()]
        for c, (lo, hi) in self.bounds.items():
            rows += [("bound_min", c, float(lo), None)] if lo is not None else []
            rows += [("bound_max", c, float(hi), None)] if hi is not None else []
        return small_table(spark, rows, "kind string, column_name string, value_double double, value_string string")

    @classmethod
    def from_table(cls, table: DataFrame) -> CleaningArtifact:
        a = cls()
        for r in table.orderBy("kind", "column_name").collect():
            if r.kind == "drop_missing":
                a.drop_missing.append(r.column_name)
            elif r.kind == "drop_corr":
                a.drop_corr.append(r.column_name)
            elif r.kind == "drop_near_constant":
                a.drop_near_constant.append(r.column_name)
            elif r.kind == "median":
                a.medians[r.column_name] = r.value_double
            elif r.kind == "mode":
                a.modes[r.column_name] = r.value_string
            else:
                lo, hi = a.bounds.get(r.column_name, (None, None))
                a.bounds[r.column_name] = (r.value_double, hi) if r.kind == "bound_min" else (lo, r.value_double)
        return a


# --- single steps -----------------------------------------------------------

def split_sentinel(df: DataFrame, column: str, flag_column: str, sentinel) -> DataFrame:
    """Flag the placeholder, then turn it into null. A missing column changes nothing."""
    if column not in df.columns:
        return df
    c = col(column)
    return df.withColumns({flag_column: flag(c == F.lit(sentinel)).cast("long"),
                           column: F.when(c != F.lit(sentinel), c)})


def missing_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return spread(df, list(cols), {"missing_share": lambda c: F.avg(flag(value_of(df, c).isNull()))},
                  name="column_name")


def high_missing(df: DataFrame, threshold: float, protected: set[str] = frozenset()) -> DataFrame:
    use = [c for c in df.columns if c not in protected]
    return missing_shares(df, use).where(F.col("missing_share") > threshold)


def high_correlation(df: DataFrame, threshold: float, protected: set[str] = frozenset(),
                     moments: dict | None = None) -> DataFrame:
    """The later column of every pair above the threshold, each once."""
    cols = numeric_columns(df, protected)
    return (strong_pairs(df, cols, threshold, moments).groupBy(F.col("right_feature").alias("column_name"))
            .agg(F.max(F.abs("r")).alias("max_abs_corr")))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, value, n`` over present values, one shuffle for all columns."""
    if not cols:
        return small_table(df.sparkSession, [], "column_name string, value string, n long")
    return (long_form(df, {c: value_of(df, c).cast("string") for c in cols}, name="column_name")
            .where("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n")))


def _hash_key(df: DataFrame, c: str) -> Column:
    """52 hash bits of a present value; they survive the sketch's double arithmetic unchanged."""
    return F.when(value_of(df, c).isNotNull(), F.shiftright(F.xxhash64(value_of(df, c)), 12))


def dominance_exprs(df: DataFrame, cols: Sequence[str], threshold: float) -> dict[str, Column]:
    """Per column a sketch of the hashed values at the ranks a value of that share must cover."""
    probes = [1.0 - threshold + 2e-4, 0.5, threshold - 2e-4]
    return {f"d:{c}": F.percentile_approx(_hash_key(df, c), probes, 10_000) for c in cols}


def near_constant(df: DataFrame, threshold: float, protected: set[str] = frozenset(),
                  sketch: dict | None = None) -> DataFrame:
    """Columns whose most frequent present value covers at least ``threshold``.

    Under any order such a value covers all ranks between 1 - threshold and threshold. A sketch of the
    hashed values names the only candidate and rules most columns out; a second scan counts the candidates
    exactly. No value is shuffled. Thresholds near one half and below count all values.
    ``sketch`` may bring the values of ``dominance_exprs`` from an earlier pass.
    """
    use = [c for c in df.columns if c not in protected]
    spark = df.sparkSession
    schema = "column_name string, top_share double"

    def counted(cols: Sequence[str]) -> DataFrame:
        shares = value_counts(df, cols).groupBy("column_name").agg(safe_div(F.max("n"), F.sum("n")).alias("top_share"))
        return shares.where(F.col("top_share") >= threshold)

    if use and threshold <= 0.51:
        return counted(use)
    sketch = sketch or (wide_agg(df, dominance_exprs(df, use, threshold)) if threshold <= 1.0 else {})
    found = {}
    for c in use:
        ranks = sketch.get(f"d:{c}")
        if ranks and len(set(ranks)) == 1:
            found[c] = ranks[0]
    if not found:
        return small_table(spark, [], schema)
    hit = lambda c: F.when(_hash_key(df, c) == F.lit(found[c]), value_of(df, c).cast("string"))
    rows = spread(df, list(found), {
        "top_share": lambda c: safe_div(F.count(hit(c)), F.count(value_of(df, c))),
        "first_value": lambda c: F.min(hit(c)), "last_value": lambda c: F.max(hit(c))}, name="column_name").where(
        F.col("top_share") >= threshold).collect()
    sure = small_table(spark, [(r.column_name, r.top_share) for r in rows if r.first_value == r.last_value], schema)
    mixed = [r.column_name for r in rows if r.first_value != r.last_value]  # two values under one hash
    return sure.unionByName(counted(mixed)) if mixed else sure


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, float | None]:
    q = exact_quantiles(df, {c: value_of(df, c) for c in cols}, [0.5], approx)
    return {c: v[0] for c, v in q.items()}


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, mode_value, n``: most frequent present value, ties to the smallest."""
    order = F.struct(-F.col("n"), F.col("value"))
    return (value_counts(df, cols).groupBy("column_name")
            .agg(F.min_by("value", order).alias("mode_value"), F.max("n").alias("n")))


# --- fit and replay ---------------------------------------------------------

def fit_cleaning(train: DataFrame, cfg: CleaningConfig, approx_medians: bool = False) -> CleaningArtifact:
    """Learns drops, fills and bounds; every structural step sees only the survivors of the one before."""
    df = train
    for c, f, s in cfg.sentinels:
        df = split_sentinel(df, c, f, s)
    keep = cfg.protected()
    art = CleaningArtifact()
    order = {c: i for i, c in enumerate(df.columns)}
    # one pass feeds all three structural steps
    open_cols = [c for c in df.columns if c not in keep]
    first = {f"n:{c}": F.avg(flag(value_of(df, c).isNull())) for c in open_cols}
    first |= moment_exprs(df, numeric_columns(df, keep))
    if 0.51 < cfg.near_constant_threshold <= 1.0:
        first |= dominance_exprs(df, open_cols, cfg.near_constant_threshold)
    seen = wide_agg(df, first)
    art.drop_missing = [c for c in open_cols if (seen[f"n:{c}"] or 0.0) > cfg.missing_threshold]
    df = df.drop(*art.drop_missing)
    if cfg.corr_threshold < 1.0:
        art.drop_corr = sorted(r.column_name for r in high_correlation(df, cfg.corr_threshold, keep, seen).collect())
    df = df.drop(*art.drop_corr)
    art.drop_near_constant = sorted(
        (r.column_name for r in near_constant(df, cfg.near_constant_threshold, keep, seen).collect()), key=order.get)
    df = df.drop(*art.drop_near_constant)

    outside = {*cfg.id_columns, cfg.target}
    art.medians = {c: v for c, v in medians(df, numeric_columns(df, outside), approx_medians).items() if v is not None}
    text = string_columns(df, outside)
    art.modes = {r.column_name: r.mode_value for r in modes(df, text).collect()} if text else {}
    art.bounds = {c: tuple(b) for c, b in cfg.bounds.items() if c in df.columns}
    return art


def clean_columns(df: DataFrame, art: CleaningArtifact, cfg: CleaningConfig) -> dict[str, Column]:
    """The cleaned expression of every surviving column."""
    types = dict(df.dtypes)
    exprs: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    spot = {c: (f, s) for c, f, s in cfg.sentinels}
    for name in df.columns:
        c = value_of(df, name)
        if name in spot:
            flag_name, s = spot[name]
            flags[flag_name] = flag(c == F.lit(s)).cast("long")
            c = F.when(c != F.lit(s), c)
        exprs[name] = c
    for name, e in flags.items():
        exprs[name] = e
        types[name] = "bigint"
    for name in art.dropped:
        exprs.pop(name, None)

    whole = set()
    for name, c in exprs.items():
        kind = types[name]
        if name in cfg.zero_fill:
            c = F.coalesce(c, F.lit(0).cast(kind))
        if name in cfg.constant_fill:
            c = F.coalesce(c, F.lit(cfg.constant_fill[name]))
        if name in cfg.median_int and name in art.medians:
            c = to_whole(F.coalesce(c.cast("double"), F.lit(float(round(art.medians[name])))))
            whole.add(name)
        if name in art.medians and name not in whole:
            m = float(art.medians[name])
            if kind in _INTEGRAL and m.is_integer():
                c = F.coalesce(c, F.lit(int(m)).cast(kind))
            else:
                c = F.coalesce(c.cast("double"), F.lit(m))
        if name in art.modes:
            c = F.coalesce(c, F.lit(art.modes[name]))
        if name in art.bounds:
            # whole bounds keep an integral column integral
            whole_type = kind in _INTEGRAL or name in whole
            c = clamp(c, *[int(b) if b is not None and whole_type and float(b).is_integer() else b for b in art.bounds[name]])
        if name in cfg.cast_int:
            c = to_whole(c)
        exprs[name] = c
    return exprs


def apply_cleaning(df: DataFrame, art: CleaningArtifact, cfg: CleaningConfig) -> DataFrame:
    """One projection: sentinel, drops, zero / constant / median / mode fills, bounds, integer casts."""
    return df.select(*[e.alias(n) for n, e in clean_columns(df, art, cfg).items()])


def null_audit(df: DataFrame) -> DataFrame:
    """One row: null cells left, and the columns that hold any."""
    cols = df.columns
    per = missing_counts(df, cols)
    return per.agg(F.sum("null_count").alias("null_cells"), F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"))


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return spread(df, list(cols), {"null_count": lambda c: F.count_if(value_of(df, c).isNull())}, name="column_name")


# --- outliers, labels, flags --------------------------------------------------

def outlier_stats(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Quartiles, fences at k interquartile ranges, P99, maximum and rows outside the fences."""
    q = exact_quantiles(df, {c: value_of(df, c) for c in cols}, [0.25, 0.75, 0.99])
    fit = {c: v for c, v in q.items() if v[0] is not None}
    if not fit:
        return small_table(df.sparkSession, [], "column_name string, " + ", ".join(
            f"{n} {'long' if n == 'n_outliers' else 'double'}" for n in (
                "q1", "q3", "p99", "iqr", "low_fence", "high_fence", "max_value", "n_outliers", "outlier_percent")))
    fences = {c: (v[0] - k * (v[1] - v[0]), v[1] + k * (v[1] - v[0])) for c, v in fit.items()}
    lit = lambda i: (lambda c: F.max(F.lit(float(fit[c][i]))))
    return spread(df, list(fit), {
        "q1": lit(0), "q3": lit(1), "p99": lit(2),
        "iqr": lambda c: F.max(F.lit(float(fit[c][1] - fit[c][0]))),
        "low_fence": lambda c: F.max(F.lit(float(fences[c][0]))),
        "high_fence": lambda c: F.max(F.lit(float(fences[c][1]))),
        "max_value": lambda c: F.max(value_of(df, c).cast("double")),
        "n_outliers": lambda c: F.count_if((value_of(df, c) < fences[c][0]) | (value_of(df, c) > fences[c][1])),
        "outlier_percent": lambda c: 100.0 * safe_div(
            F.count_if((value_of(df, c) < fences[c][0]) | (value_of(df, c) > fences[c][1])), F.count(value_of(df, c))),
    }, name="column_name")


def fit_caps(train: DataFrame, cols: Sequence[str], prob: float = 0.99) -> dict[str, float]:
    q = exact_quantiles(train, {c: value_of(train, c) for c in cols}, [prob])
    return {c: v[0] for c, v in q.items() if v[0] is not None}


def winsorize(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: at_most(value_of(df, c).cast("double"), cap) for c, cap in caps.items() if c in df.columns})


def cap_audit(tables: Mapping[str, DataFrame], caps: Mapping[str, float]) -> DataFrame:
    """Rows above the cap per table and column."""
    out = None
    for name, df in tables.items():
        part = spread(df, list(caps), {
            "cap": lambda c: F.max(F.lit(float(caps[c]))),
            "rows_capped": lambda c, d=df: F.count_if(value_of(d, c) > F.lit(caps[c]))}, name="column_name")
        part = part.withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def relabel(df: DataFrame, to_null: Mapping[str, Sequence[str]] = (), rename: Mapping[str, Mapping[str, str]] = (),
            null_label: Mapping[str, str] = ()) -> DataFrame:
    """Category repairs in one projection: value -> null, value -> label, null -> label."""
    to_null, rename, null_label = dict(to_null), dict(rename), dict(null_label)
    exprs = {}
    for name in {*to_null, *rename, *null_label} & set(df.columns):
        c = col(name)
        if name in to_null:
            c = F.when(~c.isin(list(to_null[name])), c)
        for old, new in rename.get(name, {}).items():
            c = F.when(c == F.lit(old), F.lit(new)).otherwise(c)
        if name in null_label:
            c = F.coalesce(c, F.lit(null_label[name]))
        exprs[name] = c
    return df.withColumns(exprs) if exprs else df


def drop_fixed(df: DataFrame, bases: Sequence[str] = (), suffixes: Sequence[str] = (),
               names: Sequence[str] = ()) -> DataFrame:
    """Drops base+suffix families and a plain list; absent names are ignored."""
    return df.drop(*[b + s for s in suffixes for b in bases], *names)


def binary_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, is_flag``: present values are only 0 and 1."""
    return spread(df, list(cols), {
        "is_flag": lambda c: F.coalesce(F.bool_and(value_of(df, c).isin(0, 1)), F.lit(True))}, name="column_name")


def impute_by_kind(train: DataFrame, table: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Train median for continuous columns, train mode for 0/1 flags and categories."""
    numeric = numeric_columns(train, skip)
    flags = [r.column_name for r in binary_flags(train, numeric).collect() if r.is_flag]
    mids = medians(train, [c for c in numeric if c not in flags])
    text = string_columns(train, skip)
    ones = wide_agg(train, {c: F.count_if(value_of(train, c) == 1) * 2 > F.count(value_of(train, c)) for c in flags})
    common = {r.column_name: r.mode_value for r in modes(train, text).collect()} if text else {}
    exprs = {}
    for c, m in mids.items():
        if m is not None:
            exprs[c] = F.coalesce(value_of(table, c).cast("double"), F.lit(float(m)))
    for c, one in ones.items():
        exprs[c] = F.coalesce(value_of(table, c), F.lit(1 if one else 0).cast(dtype_of(table, c)))
    for c, m in common.items():
        exprs[c] = F.coalesce(col(c), F.lit(m))
    return table.withColumns({c: e for c, e in exprs.items() if c in table.columns})


def audit_log(df: DataFrame, steps: Sequence[tuple[str, str, str, Mapping[str, Column]]]) -> DataFrame:
    """One row per step from one pass: ``(step, phase, description, {column: rows-touched condition})``.

    A step without conditions (a structural drop) reports zero rows; give it the
    dropped columns with a ``None`` condition to count them.
    """
    exprs = {}
    for s, (_, _, _, touched) in enumerate(steps):
        for c, cond in touched.items():
            if cond is not None:
                exprs[f"{s}|{c}"] = F.count_if(F.coalesce(cond, F.lit(False)))
    per = spread(df, list(exprs), {"n": lambda k: exprs[k]}, name="k") if exprs else None
    plan = small_table(df.sparkSession, [
        (i, s, p, d, sum(c is None for c in t.values())) for i, (s, p, d, t) in enumerate(steps)],
        "pos int, step string, phase string, description string, dropped int")
    hits = per.select(F.split("k", r"\|")[0].cast("int").alias("pos"), "n").groupBy("pos").agg(
        F.sum("n").alias("rows_affected"), F.count_if(F.col("n") > 0).alias("touched"))
    return plan.join(hits, "pos", "left").select(
        "step", "phase", "description", F.coalesce("rows_affected", F.lit(0)).alias("rows_affected"),
        (F.coalesce("touched", F.lit(0)) + F.col("dropped")).cast("long").alias("columns_affected"))


def clean_child_table(df: DataFrame, zero_fill: Sequence[str] = (), sentinel_columns: Sequence[str] = (),
                      sentinel=365243) -> DataFrame:
    """Null amounts to 0 and placeholder days to null on a child table."""
    exprs = {c: F.coalesce(value_of(df, c), F.lit(0).cast(dtype_of(df, c))) for c in zero_fill if c in df.columns}
    exprs.update({c: F.when(col(c) != F.lit(sentinel), col(c)) for c in sentinel_columns if c in df.columns})
    return df.withColumns(exprs) if exprs else df
