"""Declarative quality rules: report, gate, quarantine.

Every row-level rule becomes a conditional sum, so a whole suite is one scan.
Only uniqueness needs a shuffle, and the samples in the report come from a
top-n per rule that is cut inside each task before rows move.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.frames import dtype_of, small_table, spread, value_of
from riskframe.functions.scalars import add_all, col, flag, safe_div
from riskframe.sources.staging import stage

SAMPLE_ROWS = 20
BETWEEN, IN_SET, DISTINCT_IN_SET, UNIQUE, NOT_NULL, ROW_COUNT, COLUMN_COUNT = (
    "between", "in_set", "distinct_in_set", "unique", "not_null", "row_count", "column_count")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str = ""
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    mostly: float = 1.0
    name: str = field(default="")

    @property
    def id(self) -> str:
        return self.name or f"{self.kind}:{self.column}"

    @property
    def layer(self) -> str:
        return "schema" if self.kind in (UNIQUE, NOT_NULL, ROW_COUNT, COLUMN_COUNT) else "business"

    def text(self) -> str:
        if self.kind == BETWEEN:
            if self.low is not None and self.high is not None:
                return f"[{self.low}, {self.high}]"
            return f">= {self.low}" if self.low is not None else f"<= {self.high}"
        if self.kind in (IN_SET, DISTINCT_IN_SET):
            return ("{" + ", ".join(str(v) for v in self.values) + "}" if len(self.values) <= 6
                    else f"{len(self.values)} allowed values")
        if self.kind in (ROW_COUNT, COLUMN_COUNT):
            return f"= {int(self.low)}"
        return "-"


def between(column: str, low=None, high=None, mostly: float = 1.0) -> Rule:
    return Rule(BETWEEN, column, low, high, mostly=mostly)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Rule:
    return Rule(IN_SET, column, values=tuple(values), mostly=mostly)


def distinct_in_set(column: str, values: Sequence) -> Rule:
    return Rule(DISTINCT_IN_SET, column, values=tuple(values))


def unique(column: str) -> Rule:
    return Rule(UNIQUE, column)


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def row_count(n: int) -> Rule:
    return Rule(ROW_COUNT, low=n)


def column_count(n: int) -> Rule:
    return Rule(COLUMN_COUNT, low=n)


def suite_from_config(numeric: Mapping[str, Mapping] = (), categorical: Mapping[str, Sequence] = (),
                      target: Mapping[str, Sequence] = (), unique_columns: Iterable[str] = ()) -> list[Rule]:
    """Rules from the configuration form: bounds per column, value sets per column, keys.

    Leave ``target`` out for a table without labels.
    """
    rules = [between(c, b.get("min_value"), b.get("max_value")) for c, b in dict(numeric).items()]
    rules += [distinct_in_set(c, v) for c, v in {**dict(categorical), **dict(target)}.items()]
    rules += [unique(c) for c in unique_columns]
    return rules + [not_null(c) for c in dict(target)]


def casefold(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Upper-cases string columns in a copy used for validation."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.upper(col(c)) for c in columns if types.get(c) == "string"})


def _set_literals(df: DataFrame, rule: Rule, fold: bool) -> list:
    if dtype_of(df, rule.column) == "string":
        return sorted({str(v).upper() if fold else str(v) for v in rule.values})
    return [v for v in rule.values if not isinstance(v, str)]


def _tested(df: DataFrame, rule: Rule, fold: bool) -> Column:
    v = value_of(df, rule.column)
    return F.upper(v) if fold and dtype_of(df, rule.column) == "string" else v


def violation(df: DataFrame, rule: Rule, fold: bool = False) -> Column:
    """Row-level condition that is true where the rule is broken (null values never break a range or a set)."""
    v = _tested(df, rule, fold)
    if rule.kind == NOT_NULL:
        return v.isNull()
    if rule.kind == BETWEEN:
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (v < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (v > F.lit(rule.high))
    else:
        bad = ~v.isin(_set_literals(df, rule, fold))
    return F.coalesce(v.isNotNull() & bad, F.lit(False))


def duplicate_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: all rows, rows with a key, and rows whose key occurs more than once."""
    keyed = F.col("k").isNotNull()
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0))
    return (df.groupBy(col(column).alias("k")).count()
            .agg(total(F.lit(True)).alias("n_rows"), total(keyed).alias("n_present"),
                 total(keyed & (F.col("count") > 1)).alias("n_bad")))


def rule_counts(df: DataFrame, rules: Sequence[Rule], fold: bool = False) -> DataFrame:
    """One row per rule: ``rule, n_rows, n_present, n_bad``. Rules on absent columns are left out."""
    have = set(df.columns)
    rowwise = [r for r in rules if r.kind in (BETWEEN, IN_SET, DISTINCT_IN_SET, NOT_NULL) and r.column in have]
    parts = []
    if rowwise:
        by_id = {r.id: r for r in rowwise}
        parts.append(spread(df, list(by_id), {
            "n_rows": lambda r: F.count(F.lit(1)),
            "n_present": lambda r: (F.count(F.lit(1)) if by_id[r].kind == NOT_NULL
                                    else F.count(value_of(df, by_id[r].column))),
            "n_bad": lambda r: F.count_if(violation(df, by_id[r], fold)),
        }, name="rule"))
    for r in rules:
        if r.kind == UNIQUE and r.column in have:
            parts.append(duplicate_rows(df, r.column).select(
                F.lit(r.id).alias("rule"), "n_rows", "n_present", "n_bad"))
        if r.kind == ROW_COUNT:
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(r.id).alias("rule"), "n_rows", F.col("n_rows").alias("n_present"),
                F.when(F.col("n_rows") == int(r.low), 0).otherwise(1).cast("long").alias("n_bad")))
        if r.kind == COLUMN_COUNT:
            wrong = 0 if len(df.columns) == int(r.low) else 1
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(r.id).alias("rule"), "n_rows", F.col("n_rows").alias("n_present"),
                F.lit(wrong).cast("long").alias("n_bad")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violation_samples(df: DataFrame, rules: Sequence[Rule], fold: bool = False, n: int = SAMPLE_ROWS) -> DataFrame:
    """``rule, sample``: the n smallest offending values per row-level rule."""
    have = set(df.columns)
    items = [F.struct(F.lit(r.id).alias("rule"),
                      F.when(violation(df, r, fold), F.coalesce(col(r.column).cast("string"), F.lit("null"))).alias("v"))
             for r in rules if r.kind in (BETWEEN, IN_SET, NOT_NULL) and r.column in have]
    if not items:
        return small_table(df.sparkSession, [], "rule string, sample array<string>")
    bad = df.select(F.inline(F.array(*items))).where("v is not null")
    w = Window.partitionBy("rule").orderBy("v")
    return (bad.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .groupBy("rule").agg(F.sort_array(F.collect_list("v")).alias("sample")))


def observed_values(df: DataFrame, rules: Sequence[Rule], fold: bool = False) -> DataFrame:
    """``rule, value, n, allowed``: every value that the column of a set rule holds."""
    have = set(df.columns)
    use = [r for r in rules if r.kind == DISTINCT_IN_SET and r.column in have]
    items = [F.struct(F.lit(r.id).alias("rule"), _tested(df, r, fold).cast("string").alias("v"),
                      violation(df, r, fold).alias("bad")) for r in use]
    if not items:
        return small_table(df.sparkSession, [], "rule string, value string, n long, allowed boolean")
    return (df.select(F.inline(F.array(*items))).where("v is not null")
            .groupBy("rule", F.col("v").alias("value"), (~F.col("bad")).alias("allowed")).agg(F.count("*").alias("n"))
            .select("rule", "value", "n", "allowed"))


def distinct_samples(df: DataFrame, rules: Sequence[Rule], fold: bool = False) -> DataFrame:
    """``rule, n_distinct, n_outside, seen``: what a set rule found in its column, all values included.

    A set rule is meant for columns of few values; ``observed_values`` lists those of any column in long form.
    """
    return observed_values(df, rules, fold).groupBy("rule").agg(
        F.count("*").alias("n_distinct"), F.count_if(~F.col("allowed")).alias("n_outside"),
        F.sort_array(F.collect_list("value")).alias("seen"))


def rule_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    rows = [(i, r.id, r.kind, r.column, float(r.mostly), r.layer, r.text()) for i, r in enumerate(rules)]
    return small_table(df.sparkSession, rows,
                       "pos int, rule string, kind string, column string, mostly double, layer string, rule_text string")


def evaluate_rules(df: DataFrame, rules: Sequence[Rule], fold: bool = False) -> DataFrame:
    """Counts and verdict per rule, absent columns as failures."""
    counted = rule_table(df, rules).join(rule_counts(df, rules, fold), "rule", "left")
    share_ok = 1.0 - safe_div(F.col("n_bad"), F.col("n_present"))
    ok = F.when(F.col("n_bad").isNull(), False).when(F.col("n_present") == 0, True).otherwise(
        (F.col("n_bad") == 0) | (share_ok >= F.col("mostly")))
    return counted.withColumn("success", ok)


def quality_report(df: DataFrame, rules: Sequence[Rule], fold: bool = True) -> DataFrame:
    """One row per rule. Set rules are verdicts on the column, so they carry no row counts."""
    res = (evaluate_rules(df, rules, fold)
           .join(violation_samples(df, rules, fold), "rule", "left")
           .join(distinct_samples(df, rules, fold), "rule", "left"))
    on_column = F.col("kind") == DISTINCT_IN_SET
    return res.select(
        F.col("kind").alias("expectation_type"), "column", "success",
        F.when(~on_column, F.col("n_rows")).alias("element_count"),
        F.when(~on_column, F.col("n_bad")).alias("unexpected_count"),
        F.when(~on_column, 100.0 * safe_div(F.col("n_bad"), F.col("n_present"))).alias("unexpected_percent"),
        F.concat_ws(",", "seen").alias("observed_value"),
        F.concat_ws(",", "sample").alias("partial_unexpected_list"))


class QualityGateError(ValueError):
    """Raised when a report holds failed rules."""


def quality_gate(df: DataFrame, report: DataFrame, report_path: str | None = None) -> DataFrame:
    """The table itself when every rule passed, else an error that lists all failures.

    The report is written before the verdict; it has one row per rule.
    """
    if report_path:
        report.write.mode("overwrite").parquet(report_path)
        report = report.sparkSession.read.parquet(report_path)
    failed = report.where(~F.col("success"))
    rows = failed.collect()
    if rows:
        lines = "\n".join(f"{r.expectation_type}({r.column}): {r.unexpected_count}" for r in rows)
        raise QualityGateError(f"{len(rows)} quality rule(s) failed:\n{lines}")
    return df


def quality_summary(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        F.count("*").alias("evaluated"), F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        (100.0 * F.avg(flag(F.col("success")))).alias("success_percent"))


def tidy_report(evaluated: DataFrame) -> DataFrame:
    share = F.format_string("%.2f", F.round(100.0 * safe_div(F.col("n_bad"), F.col("n_present")), 2))
    return evaluated.select(
        "layer", "column", F.col("kind").alias("expectation"), F.col("rule_text").alias("constraint_text"),
        F.when(F.col("success"), "PASS").otherwise("FAIL").alias("status"),
        F.when(F.col("success"), "-").otherwise(
            F.concat(F.col("n_bad").cast("string"), F.lit(" rows ("), share, F.lit("%)"))).alias("violations"),
    ).orderBy("layer", "status", "column")


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two evaluated suites side by side, one row per rule in either."""
    b = before.select("rule", F.col("success").alias("success_before"), F.col("n_bad").alias("bad_before"))
    a = after.select("rule", F.col("success").alias("success_after"), F.col("n_bad").alias("bad_after"))
    return b.join(a, "rule", "full")


def count_checks(df: DataFrame, checks: Mapping[str, Column], ok: str = "OK", bad: str = "CHECK") -> DataFrame:
    """Named predicates -> violation counts and a status."""
    return spread(df, list(checks), {"violations": lambda n: F.count_if(checks[n])}, name="check_name").withColumn(
        "status", F.when(F.col("violations") == 0, ok).otherwise(bad))


def tolerated_counts(tables: Sequence[tuple[str, DataFrame, Mapping[str, tuple[Column, str]]]]) -> DataFrame:
    """Counts of known, accepted anomalies: ``(table name, table, {check: (condition, reason)})``."""
    out = None
    for name, df, checks in tables:
        reasons = F.create_map(*[x for k, (_, why) in checks.items() for x in (F.lit(k), F.lit(why))])
        part = spread(df, list(checks), {"n_rows": lambda n, c=checks: F.count_if(c[n][0])}, name="check_name")
        part = part.select(F.lit(name).alias("table_name"), "check_name", "n_rows",
                           reasons[F.col("check_name")].alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out


def nan_inf_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing and infinite cells per feature."""
    def inf(c):
        v = col(c).cast("double")
        return F.count_if(F.abs(v) == F.lit(float("inf")))
    return spread(df, list(cols), {
        "n_missing": lambda c: F.count_if(value_of(df, c).isNull()), "n_infinite": inf})


def tag_violations(df: DataFrame, rules: Sequence[Rule], fold: bool = True) -> DataFrame:
    """Adds ``broken_rules``: the ids of the row-level rules a row breaks."""
    have = set(df.columns)
    marks = [F.when(violation(df, r, fold), F.lit(r.id)) for r in rules
             if r.kind in (BETWEEN, IN_SET, DISTINCT_IN_SET, NOT_NULL) and r.column in have]
    out = df
    for r in rules:
        if r.kind == UNIQUE and r.column in have:
            twice = (df.where(col(r.column).isNotNull()).groupBy(col(r.column)).count()
                     .where("count > 1").select(col(r.column), F.lit(r.id).alias(f"__dup_{r.column}")))
            out = out.join(twice, r.column, "left")
            marks.append(F.col(f"__dup_{r.column}"))
    tagged = out.withColumn("broken_rules", F.array_compact(F.array(*marks)))
    return tagged.select(*df.columns, "broken_rules")


def quarantine(df: DataFrame, rules: Sequence[Rule], fold: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid rows, offending rows with their broken rules)."""
    tagged = stage(tag_violations(df, rules, fold), "tagged")  # evaluated once for both sides
    return (tagged.where(F.size("broken_rules") == 0).drop("broken_rules"),
            tagged.where(F.size("broken_rules") > 0))
