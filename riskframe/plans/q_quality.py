"""Quality rules on the applicant and child views."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean, quality as q
from riskframe.plans.registry import query
from riskframe.plans.settings import APP_NUMERIC, APP_RULES, CLEANING, SEGMENTS, SENTINEL
from riskframe.plans.views import staged, table, view
from riskframe.sources.staging import fresh_path

SEG = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD')"


def _counts(df, rules, fold=False):
    return q.evaluate_rules(df, rules, fold).select("rule", "n_rows", "n_present", "n_bad", "success")


@query("dq_between", """
SELECT 'between:cnt_a' AS rule, count(*) AS n_rows, count(cnt_a) AS n_present, count_if(cnt_a < 1 OR cnt_a > 18)::BIGINT AS n_bad,
 count_if(cnt_a < 1 OR cnt_a > 18) = 0 AS success FROM v_app
UNION ALL SELECT 'between:amt_b', count(*), count(amt_b), count_if(amt_b < 1000)::BIGINT, count_if(amt_b < 1000) = 0 FROM v_app
UNION ALL SELECT 'between:days_emp', count(*), count(days_emp), count_if(days_emp > 0)::BIGINT, count_if(days_emp > 0) = 0 FROM v_app
""", ["v_app"])
def dq_between(spark, sf):
    return _counts(view(spark, sf, "v_app"), [q.between("cnt_a", 1, 18), q.between("amt_b", 1000), q.between("days_emp", high=0)])


@query("dq_distinct_in_set", f"""
SELECT 'distinct_in_set:segment' AS rule, count(DISTINCT segment) AS n_distinct,
 count(DISTINCT CASE WHEN upper(segment) NOT IN {SEG} THEN segment END) AS n_outside FROM v_app
UNION ALL SELECT 'distinct_in_set:nation', count(DISTINCT nation),
 count(DISTINCT CASE WHEN nation NOT IN ('NATION_1', 'NATION_2') THEN nation END) FROM v_app
UNION ALL SELECT 'distinct_in_set:near_const', count(DISTINCT near_const), 0 FROM v_app""", ["v_app"])
def dq_distinct_in_set(spark, sf):
    rules = [q.distinct_in_set("segment", SEGMENTS), q.distinct_in_set("nation", ["nation_1", "Nation_2"]),
             q.distinct_in_set("near_const", [0, 1])]
    return q.distinct_samples(view(spark, sf, "v_app"), rules, fold=True).select("rule", "n_distinct", "n_outside")


@query("dq_unique", """
WITH d AS (SELECT child_id, count(*) AS c FROM v_hist GROUP BY child_id), a AS (SELECT id, count(*) AS c FROM v_app GROUP BY id)
SELECT 'v_hist.child_id' AS key_name, sum(c)::BIGINT AS n_rows, sum(CASE WHEN c > 1 THEN c ELSE 0 END)::BIGINT AS n_bad FROM d
UNION ALL SELECT 'v_app.id', sum(c)::BIGINT, sum(CASE WHEN c > 1 THEN c ELSE 0 END)::BIGINT FROM a""", ["v_hist", "v_app"])
def dq_unique(spark, sf):
    hist, app = view(spark, sf, "v_hist"), view(spark, sf, "v_app")
    return (q.duplicate_rows(hist, "child_id").select(F.lit("v_hist.child_id").alias("key_name"), "n_rows", "n_bad")
            .unionByName(q.duplicate_rows(app, "id").select(F.lit("v_app.id").alias("key_name"), "n_rows", "n_bad")))


@query("dq_not_null", """
SELECT 'not_null:nation' AS rule, count(*) AS n_rows, count(*) AS n_present, count_if(nation IS NULL)::BIGINT AS n_bad,
 count_if(nation IS NULL) = 0 AS success FROM v_app
UNION ALL SELECT 'not_null:target', count(*), count(*), count_if(target IS NULL)::BIGINT, count_if(target IS NULL) = 0 FROM v_app""", ["v_app"])
def dq_not_null(spark, sf):
    return _counts(view(spark, sf, "v_app"), [q.not_null("nation"), q.not_null("target")])


@query("dq_in_set_mostly", """
WITH c AS (SELECT count(*) AS n, count(nation) AS p, count_if(nation = 'NATION_3')::BIGINT AS b, count_if(status = 'O')::BIGINT AS o
 FROM v_app LEFT JOIN (SELECT NULL AS status) ON TRUE)
SELECT 'loose' AS rule, n AS n_rows, p AS n_present, b AS n_bad, 1 - b / p >= 0.9 AS success FROM c
UNION ALL SELECT 'strict', n, p, b, 1 - b / p >= 0.999 FROM c""", ["v_app"])
def dq_in_set_mostly(spark, sf):
    allowed = [f"NATION_{i}" for i in range(25) if i != 3]
    rules = [q.Rule(q.IN_SET, "nation", values=tuple(allowed), mostly=0.9, name="loose"),
             q.Rule(q.IN_SET, "nation", values=tuple(allowed), mostly=0.999, name="strict")]
    return _counts(view(spark, sf, "v_app"), rules)


@query("dq_between_mostly", """
SELECT 'sentinel' AS rule, count(days_emp) AS n_present, count_if(days_emp > 0)::BIGINT AS n_bad,
 1 - count_if(days_emp > 0) / count(days_emp) >= 0.999 AS success FROM v_app
UNION ALL SELECT 'price', count(amt_b), count_if(amt_b < 100000)::BIGINT, 1 - count_if(amt_b < 100000) / count(amt_b) >= 0.5 FROM v_app""", ["v_app"])
def dq_between_mostly(spark, sf):
    rules = [q.Rule(q.BETWEEN, "days_emp", high=0, mostly=0.999, name="sentinel"),
             q.Rule(q.BETWEEN, "amt_b", low=100000, mostly=0.5, name="price")]
    return _counts(view(spark, sf, "v_app"), rules).select("rule", "n_present", "n_bad", "success")


@query("dq_table_shape", """
SELECT 'row_count:' AS rule, count(*) AS n_rows, TRUE AS success FROM v_app
UNION ALL SELECT 'column_count:', count(*), TRUE FROM v_app
UNION ALL SELECT 'wrong', count(*), FALSE FROM v_app""", ["v_app"])
def dq_table_shape(spark, sf):
    app = view(spark, sf, "v_app")
    customers = table(spark, sf, "customer").count()
    rules = [q.row_count(customers), q.column_count(14), q.Rule(q.ROW_COUNT, low=customers + 1, name="wrong")]
    return q.evaluate_rules(app, rules).select("rule", "n_rows", "success")


@query("dq_no_nan_inf", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count_if({c} IS NULL)::BIGINT AS n_missing, count_if(abs({c}) = 'inf'::DOUBLE)::BIGINT AS n_infinite FROM v_app"
    for c in APP_NUMERIC) + ")", ["v_app"])
def dq_no_nan_inf(spark, sf):
    return q.nan_inf_counts(view(spark, sf, "v_app"), APP_NUMERIC)


@query("dq_casefold", f"""
SELECT id, upper(segment) AS segment, flag_yn, upper(segment) IN {SEG} AS known FROM v_app""", ["v_app"])
def dq_casefold(spark, sf):
    app = view(spark, sf, "v_app").select("id", F.initcap("segment").alias("segment"), "flag_yn")
    return q.casefold(app, ["segment", "near_const"]).withColumn("known", F.col("segment").isin([s.upper() for s in SEGMENTS]))


def _rowwise_sql(kind, col, present, bad, show):
    return f"""SELECT '{kind}' AS expectation_type, '{col}' AS "column", count_if({bad}) = 0 AS success, count(*) AS element_count,
 count_if({bad})::BIGINT AS unexpected_count, 100.0 * count_if({bad}) / {present} AS unexpected_percent, '' AS observed_value,
 coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT {show} AS v FROM v_app WHERE {bad} ORDER BY v LIMIT 20)), '') AS partial_unexpected_list
 FROM v_app"""


def _set_sql(col, bad):
    return f"""SELECT 'distinct_in_set', '{col}', count_if({bad}) = 0, NULL, NULL, NULL,
 (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM v_app WHERE {col} IS NOT NULL)), '' FROM v_app"""


REPORT_SQL = " UNION ALL ".join([
    _rowwise_sql("between", "cnt_a", "count(cnt_a)", "(cnt_a < 1 OR cnt_a > 18)", "CAST(cnt_a AS VARCHAR)"),
    _rowwise_sql("between", "amt_a", "count(amt_a)", "(amt_a < 1)", "CAST(amt_a AS VARCHAR)"),
    _rowwise_sql("between", "days_emp", "count(days_emp)", "(days_emp > 0)", "CAST(days_emp AS VARCHAR)"),
    _rowwise_sql("between", "amt_b", "count(amt_b)", "(amt_b < 1000 OR amt_b > 600000)", "CAST(amt_b AS VARCHAR)"),
    "SELECT 'between', 'not_there', FALSE, NULL, NULL, NULL, '', ''",
    _set_sql("segment", f"upper(segment) NOT IN {SEG}"),
    _set_sql("flag_yn", "flag_yn <> 'Y'"),
    _set_sql("near_const", "near_const NOT IN (0, 1)"),
    _set_sql("target", "target NOT IN (0, 1)"),
    "SELECT 'unique', 'id', max(c) = 1, sum(c)::BIGINT, sum(CASE WHEN c > 1 THEN c ELSE 0 END)::BIGINT, "
    "100.0 * sum(CASE WHEN c > 1 THEN c ELSE 0 END) / sum(c), '', '' FROM (SELECT count(*) AS c FROM v_app GROUP BY id)",
    _rowwise_sql("not_null", "target", "count(*)", "(target IS NULL)", "'null'"),
    _rowwise_sql("not_null", "nation", "count(*)", "(nation IS NULL)", "'null'"),
])


@query("dq_report", REPORT_SQL, ["v_app"], doubles="unexpected_percent")
def dq_report(spark, sf):
    return q.quality_report(view(spark, sf, "v_app"), APP_RULES)


@query("dq_observed_values", """
SELECT 'nations' AS rule, upper(nation) AS value, count(*) AS n, upper(nation) IN ('FRANCE', 'GERMANY', 'JAPAN') AS allowed FROM v_app WHERE nation IS NOT NULL GROUP BY 2
UNION ALL SELECT 'segments', upper(segment), count(*), TRUE FROM v_app WHERE segment IS NOT NULL GROUP BY 2""", ["v_app"])
def dq_observed_values(spark, sf):
    rules = [q.distinct_in_set("nation", ["FRANCE", "GERMANY", "JAPAN"]), q.distinct_in_set("segment", SEGMENTS)]
    names = {r.id: n for r, n in zip(rules, ("nations", "segments"))}
    found = q.observed_values(view(spark, sf, "v_app"), rules, fold=True)
    return found.withColumn("rule", F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("rule")))


@query("dq_gate", "SELECT id, target, cnt_a, segment FROM v_app", ["v_app"])
def dq_gate(spark, sf):
    app = view(spark, sf, "v_app")
    rules = [q.between("amt_a", 1), q.distinct_in_set("segment", SEGMENTS), q.unique("id"), q.not_null("target")]
    passed = q.quality_gate(app, q.quality_report(app, rules), fresh_path(spark, "report"))
    return passed.select("id", "target", "cnt_a", "segment")


@query("dq_summary", """
SELECT 12::BIGINT AS evaluated, s::BIGINT AS successful, (12 - s)::BIGINT AS unsuccessful, 100.0 * s / 12 AS success_percent FROM (
SELECT (count_if(cnt_a < 1 OR cnt_a > 18) = 0)::INT + (count_if(amt_a < 1) = 0)::INT + (count_if(days_emp > 0) = 0)::INT
 + (count_if(amt_b < 1000 OR amt_b > 600000) = 0)::INT + (count_if(flag_yn <> 'Y') = 0)::INT + (count_if(nation IS NULL) = 0)::INT
 + (count(DISTINCT id) = count(*))::INT + 4 AS s FROM v_app)""", ["v_app"], doubles="success_percent")
def dq_summary(spark, sf):
    return q.quality_summary(q.evaluate_rules(view(spark, sf, "v_app"), APP_RULES, fold=True))


@query("dq_report_tidy", """
WITH c AS (SELECT count_if(cnt_a < 1 OR cnt_a > 18)::BIGINT AS a, count(cnt_a) AS an, count_if(days_emp > 0)::BIGINT AS d, count(*) AS n,
 count_if(nation IS NULL)::BIGINT AS m, count_if(flag_yn <> 'Y')::BIGINT AS f FROM v_app)
SELECT 'business' AS layer, 'cnt_a' AS "column", 'between' AS expectation, '[1, 18]' AS constraint_text,
 CASE WHEN a = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
 CASE WHEN a = 0 THEN '-' ELSE printf('%d rows (%.2f%%)', a, round(100.0::DOUBLE * a / an, 2)) END AS violations FROM c
UNION ALL SELECT 'business', 'days_emp', 'between', '<= 0', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END,
 CASE WHEN d = 0 THEN '-' ELSE printf('%d rows (%.2f%%)', d, round(100.0::DOUBLE * d / n, 2)) END FROM c
UNION ALL SELECT 'business', 'flag_yn', 'distinct_in_set', '{Y}', CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END,
 CASE WHEN f = 0 THEN '-' ELSE printf('%d rows (%.2f%%)', f, round(100.0::DOUBLE * f / n, 2)) END FROM c
UNION ALL SELECT 'schema', 'nation', 'not_null', '-', CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END,
 CASE WHEN m = 0 THEN '-' ELSE printf('%d rows (%.2f%%)', m, round(100.0::DOUBLE * m / n, 2)) END FROM c
UNION ALL SELECT 'schema', 'target', 'not_null', '-', 'PASS', '-'""", ["v_app"])
def dq_report_tidy(spark, sf):
    rules = [q.between("cnt_a", 1, 18), q.between("days_emp", high=0), q.distinct_in_set("flag_yn", ["Y"]),
             q.not_null("nation"), q.not_null("target")]
    return q.tidy_report(q.evaluate_rules(view(spark, sf, "v_app"), rules))


@query("dq_pre_post", """
SELECT 'between:days_emp' AS rule, count_if(days_emp > 0) = 0 AS success_before, count_if(days_emp > 0)::BIGINT AS bad_before,
 TRUE AS success_after, 0::BIGINT AS bad_after FROM v_app
UNION ALL SELECT 'not_null:nation', count_if(nation IS NULL) = 0, count_if(nation IS NULL)::BIGINT, TRUE, 0 FROM v_app
UNION ALL SELECT 'not_null:cnt_a', count_if(cnt_a IS NULL) = 0, count_if(cnt_a IS NULL)::BIGINT, TRUE, 0 FROM v_app
UNION ALL SELECT 'in_set:flag_yn', NULL, NULL, TRUE, 0""", ["v_app"])
def dq_pre_post(spark, sf):
    app = staged(spark, sf, "v_app")
    rules = [q.between("days_emp", high=0), q.not_null("nation"), q.not_null("cnt_a")]
    cleaned = clean.apply_cleaning(app, clean.fit_cleaning(app, CLEANING), CLEANING)
    return q.before_after(q.evaluate_rules(app, rules),
                          q.evaluate_rules(cleaned, [*rules, q.in_set("flag_yn", ["Y", "N"])]))


@query("dq_range_checks", """
SELECT 'positive employment' AS check_name, count_if(days_emp > 0)::BIGINT AS violations,
 CASE WHEN count_if(days_emp > 0) = 0 THEN 'OK' ELSE 'CHECK' END AS status FROM v_app
UNION ALL SELECT 'amount not positive', count_if(amt_a <= 0)::BIGINT, CASE WHEN count_if(amt_a <= 0) = 0 THEN 'OK' ELSE 'CHECK' END FROM v_app
UNION ALL SELECT 'max below mean', count_if(amt_c < amt_b)::BIGINT, CASE WHEN count_if(amt_c < amt_b) = 0 THEN 'OK' ELSE 'CHECK' END FROM v_app""", ["v_app"])
def dq_range_checks(spark, sf):
    return q.count_checks(view(spark, sf, "v_app"), {
        "positive employment": F.col("days_emp") > 0, "amount not positive": F.col("amt_a") <= 0,
        "max below mean": F.col("amt_c") < F.col("amt_b")})


@query("dq_exclusion_counts", """
SELECT 'applicants' AS table_name, 'no orders' AS check_name, count_if(cnt_a IS NULL)::BIGINT AS n_rows, 'no history yet' AS reason FROM v_app
UNION ALL SELECT 'history', 'no discount', count_if(disc IS NULL)::BIGINT, 'discount never granted' FROM v_hist
UNION ALL SELECT 'history', 'negative due', count_if(due < 0)::BIGINT, 'refund' FROM v_hist""", ["v_app", "v_hist"])
def dq_exclusion_counts(spark, sf):
    return q.tolerated_counts([
        ("applicants", view(spark, sf, "v_app"), {"no orders": (F.col("cnt_a").isNull(), "no history yet")}),
        ("history", view(spark, sf, "v_hist"), {"no discount": (F.col("disc").isNull(), "discount never granted"),
                                                "negative due": (F.col("due") < 0, "refund")})])


QUARANTINE_SQL = """
SELECT id, concat_ws(',', CASE WHEN cnt_a < 1 OR cnt_a > 18 THEN 'between:cnt_a' END, CASE WHEN days_emp > 0 THEN 'between:days_emp' END,
 CASE WHEN nation IS NULL THEN 'not_null:nation' END) AS broken, NOT (coalesce(cnt_a < 1 OR cnt_a > 18, FALSE) OR days_emp > 0 OR nation IS NULL) AS valid
FROM v_app"""


@query("dq_quarantine", QUARANTINE_SQL, ["v_app"])
def dq_quarantine(spark, sf):
    rules = [q.between("cnt_a", 1, 18), q.between("days_emp", high=0), q.unique("id"), q.not_null("nation")]
    good, bad = q.quarantine(view(spark, sf, "v_app"), rules)
    return good.select("id", F.lit("").alias("broken"), F.lit(True).alias("valid")).unionByName(
        bad.select("id", F.concat_ws(",", "broken_rules").alias("broken"), F.lit(False).alias("valid")))
