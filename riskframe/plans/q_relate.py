"""Child aggregation, joins, set operations and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import encode, relate as r
from riskframe.plans.q_features import G, PAID, payments
from riskframe.plans.q_sources import h
from riskframe.plans.registry import query
from riskframe.plans.settings import SEED
from riskframe.plans.views import table, view
from riskframe.sources import tables as t

M = r.Measure
STATUS = """bb AS (SELECT child_id, count(step) AS bb_months_count, min(step) AS bb_months_min, count_if(status IN ('1','2','3','4','5'))::BIGINT AS bb_n_dpd,
 count_if(status IN ('4','5'))::BIGINT AS bb_n_dpd_def, count_if(status IN ('1','2','3','4','5')) / greatest(count(step), 1) AS bb_dpd_ratio,
 count_if(status IN ('4','5')) / greatest(count(step), 1) AS bb_dpd_def_ratio FROM v_hist GROUP BY child_id)"""


def history(spark, sf):
    return r.status_history(view(spark, sf, "v_hist"), "child_id", "step", "status", ("1", "2", "3", "4", "5"), ("4", "5"))


@query("agg_status_history", f"WITH {STATUS} SELECT * FROM bb", ["v_hist"], doubles="bb_dpd_ratio bb_dpd_def_ratio")
def agg_status_history(spark, sf):
    return history(spark, sf)


CREDIT = [
    M("credit_n", "count", "child_id"), M("credit_n_open", "count_in", "status", ("O",)),
    M("credit_n_closed", "count_in", "status", ("F",)), M("credit_n_pending", "count_in", "status", ("P",)),
    M("credit_n_urgent", "count_in", "kind", ("1-URGENT",)), M("credit_avg_days", "mean", "days"), M("credit_max_days", "max", "days"),
    M("credit_min_days", "min", "days"), M("credit_sum", "sum", "amt"), M("credit_avg", "mean", "amt"), M("credit_max", "max", "amt"),
    M("credit_bb_months_avg", "mean", "bb_months_count"), M("credit_bb_n_dpd", "sum", "bb_n_dpd"),
    M("credit_bb_n_dpd_def", "sum", "bb_n_dpd_def"), M("credit_bb_dpd_ratio_max", "max", "bb_dpd_ratio")]
CREDIT_SQL = f"""{STATUS}, credit AS (SELECT id, count(child_id) AS credit_n, count_if(status = 'O')::BIGINT AS credit_n_open, count_if(status = 'F')::BIGINT AS credit_n_closed,
 count_if(status = 'P')::BIGINT AS credit_n_pending, count_if(kind = '1-URGENT')::BIGINT AS credit_n_urgent, avg(days) AS credit_avg_days, max(days) AS credit_max_days,
 min(days) AS credit_min_days, coalesce(sum(amt), 0) AS credit_sum, avg(amt) AS credit_avg, max(amt) AS credit_max, avg(bb_months_count) AS credit_bb_months_avg,
 coalesce(sum(bb_n_dpd), 0)::BIGINT AS credit_bb_n_dpd, coalesce(sum(bb_n_dpd_def), 0)::BIGINT AS credit_bb_n_dpd_def, max(bb_dpd_ratio) AS credit_bb_dpd_ratio_max,
 count_if(status = 'O') / greatest(count(child_id), 1) AS credit_open_ratio, coalesce(sum(bb_n_dpd), 0) / greatest(avg(bb_months_count), 1) AS credit_late_ratio
 FROM v_child LEFT JOIN bb USING (child_id) GROUP BY id)"""
CREDIT_DOUBLES = "credit_avg_days credit_sum credit_avg credit_max credit_bb_months_avg credit_bb_dpd_ratio_max credit_open_ratio credit_late_ratio"


def credit(spark, sf):
    child = r.join_feature_tables(view(spark, sf, "v_child"), "child_id", history(spark, sf))
    return r.aggregate_children(child, "id", CREDIT, [
        ("credit_open_ratio", "credit_n_open", "credit_n"), ("credit_late_ratio", "credit_bb_n_dpd", "credit_bb_months_avg")])


@query("agg_child_with_history", f"WITH {CREDIT_SQL} SELECT * FROM credit", ["v_hist", "v_child"], doubles=CREDIT_DOUBLES, digits=4)
def agg_child_with_history(spark, sf):
    return credit(spark, sf)


PRIOR = [
    M("prev_n", "count", "child_id"), M("prev_n_approved", "count_in", "status", ("F",)), M("prev_n_refused", "count_in", "status", ("O",)),
    M("prev_n_cancelled", "count_in", "status", ("P",)), M("prev_n_a", "count_in", "kind", ("1-URGENT",)), M("prev_n_b", "count_in", "kind", ("2-HIGH", "3-MEDIUM")),
    M("prev_n_c", "count_in", "kind", ("5-LOW",)), M("prev_avg", "mean", "amt"), M("prev_max", "max", "amt"), M("prev_avg_days", "mean", "days"),
    M("prev_min_days", "min", "days"), M("prev_n_big", "count_above", "amt", 200000.0)]
PRIOR_SQL = """prior AS (SELECT *, prev_n_refused / greatest(prev_n, 1) AS prev_refusal_rate, prev_n_approved / greatest(prev_n, 1) AS prev_approval_rate,
 prev_avg / greatest(prev_max, 1) AS prev_size_ratio FROM (SELECT id, count(child_id) AS prev_n, count_if(status = 'F')::BIGINT AS prev_n_approved,
 count_if(status = 'O')::BIGINT AS prev_n_refused, count_if(status = 'P')::BIGINT AS prev_n_cancelled, count_if(kind = '1-URGENT')::BIGINT AS prev_n_a,
 count_if(kind IN ('2-HIGH', '3-MEDIUM'))::BIGINT AS prev_n_b, count_if(kind = '5-LOW')::BIGINT AS prev_n_c, avg(amt) AS prev_avg, max(amt) AS prev_max,
 avg(days) AS prev_avg_days, min(days) AS prev_min_days, count_if(amt > 200000)::BIGINT AS prev_n_big FROM v_child GROUP BY id))"""


def prior(spark, sf):
    return r.aggregate_children(view(spark, sf, "v_child"), "id", PRIOR, [
        ("prev_refusal_rate", "prev_n_refused", "prev_n"), ("prev_approval_rate", "prev_n_approved", "prev_n"), ("prev_size_ratio", "prev_avg", "prev_max")])


@query("agg_prior_applications", f"WITH {PRIOR_SQL} SELECT * FROM prior", ["v_child"],
       doubles="prev_avg prev_max prev_avg_days prev_refusal_rate prev_approval_rate prev_size_ratio")
def agg_prior_applications(spark, sf):
    return prior(spark, sf)


SUPP = "(SELECT l_suppkey AS sid, l_orderkey AS contract, l_linenumber AS month, l_quantity AS dpd, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS dpd_def, l_returnflag AS status, l_extendedprice AS balance, l_extendedprice * (1 + l_tax) AS lim, -l_extendedprice * l_discount AS payment FROM lineitem)"


def _monthly(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("sid"), F.col("l_orderkey").alias("contract"), F.col("l_linenumber").alias("month"), F.col("l_quantity").alias("dpd"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("dpd_def"), F.col("l_returnflag").alias("status"), F.col("l_extendedprice").alias("balance"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("lim"), (-F.col("l_extendedprice") * F.col("l_discount")).alias("payment"))


@query("agg_monthly_snapshots", f"""SELECT *, n_dpd / greatest(n_months, 1) AS dpd_ratio, n_done / greatest(n_months, 1) AS done_ratio FROM (
SELECT sid, count(DISTINCT contract) AS n_contracts, count(month) AS n_months, max(month) AS last_month, count_if(status = 'R')::BIGINT AS n_done,
 max(dpd) AS max_dpd, avg(dpd) AS avg_dpd, sum(dpd) AS sum_dpd, max(dpd_def) AS max_dpd_def, avg(dpd_def) AS avg_dpd_def,
 count_if(dpd > 25)::BIGINT AS n_dpd, count_if(dpd_def > 0.05)::BIGINT AS n_dpd_def FROM {SUPP} GROUP BY sid)""",
       doubles="max_dpd avg_dpd sum_dpd max_dpd_def avg_dpd_def dpd_ratio done_ratio")
def agg_monthly_snapshots(spark, sf):
    return r.aggregate_children(_monthly(spark, sf), "sid", [
        M("n_contracts", "nunique", "contract"), M("n_months", "count", "month"), M("last_month", "max", "month"), M("n_done", "count_in", "status", ("R",)),
        M("max_dpd", "max", "dpd"), M("avg_dpd", "mean", "dpd"), M("sum_dpd", "sum", "dpd"), M("max_dpd_def", "max", "dpd_def"), M("avg_dpd_def", "mean", "dpd_def"),
        M("n_dpd", "count_above", "dpd", 25.0), M("n_dpd_def", "count_above", "dpd_def", 0.05)],
        [("dpd_ratio", "n_dpd", "n_months"), ("done_ratio", "n_done", "n_months")])


PAY_SQL = f"""pay AS (SELECT *, n_on_time / greatest(n_payments, 1) AS on_time_ratio,
 greatest(1 - total_paid / greatest(total_due, 1), 0) AS underpayment FROM (
 SELECT h.child_id, count(h.child_id) AS n_payments, count(DISTINCT h.step) AS n_steps, avg(payment_ratio) AS avg_payment_ratio, min(payment_ratio) AS min_payment_ratio,
 count_if(paid_on_time)::BIGINT AS n_on_time, avg(days_late) AS avg_days_late, max(days_late) AS max_days_late, sum(due) AS total_due, sum(paid) AS total_paid,
 avg(days_early_late) AS avg_early_late FROM (SELECT child_id, step, due, paid, paid / {G('due')} AS payment_ratio, early AS days_early_late,
 CASE WHEN -early < 0 THEN 0 ELSE -early END AS days_late, coalesce(early >= 0, FALSE) AS paid_on_time
 FROM (SELECT *, (10 - CASE WHEN disc IS NULL THEN NULL ELSE qty END)::DOUBLE AS early FROM v_hist)) h GROUP BY h.child_id))"""


@query("agg_payments", f"WITH {PAY_SQL} SELECT * FROM pay", ["v_hist"],
       doubles="avg_payment_ratio min_payment_ratio avg_days_late max_days_late total_due total_paid avg_early_late on_time_ratio underpayment")
def agg_payments(spark, sf):
    out = r.aggregate_children(payments(spark, sf), "child_id", [
        M("n_payments", "count", "child_id"), M("n_steps", "nunique", "step"), M("avg_payment_ratio", "mean", "payment_ratio"), M("min_payment_ratio", "min", "payment_ratio"),
        M("n_on_time", "count_true", "paid_on_time"), M("avg_days_late", "mean", "days_late"), M("max_days_late", "max", "days_late"),
        M("total_due", "sum", "due"), M("total_paid", "sum", "paid"), M("avg_early_late", "mean", "days_early_late")],
        [("on_time_ratio", "n_on_time", "n_payments"), ("paid_share", "total_paid", "total_due")])
    return out.withColumn("underpayment", r.at_least(1.0 - F.col("paid_share"), 0.0)).drop("paid_share")


@query("agg_card_balance", f"""SELECT *, n_dpd / greatest(n_months, 1) AS dpd_ratio, avg_payment / greatest(abs(avg_balance), 1) AS payment_balance FROM (
SELECT sid, count(DISTINCT contract) AS n_contracts, count(month) AS n_months, avg(balance) AS avg_balance, max(balance) AS max_balance, avg(lim) AS avg_limit,
 avg(balance / {G('lim')}) AS avg_use, max(balance / {G('lim')}) AS max_use, avg(payment) AS avg_payment, count_if(dpd > 25)::BIGINT AS n_dpd FROM {SUPP} GROUP BY sid)""",
       doubles="avg_balance max_balance avg_limit avg_use max_use avg_payment dpd_ratio payment_balance")
def agg_card_balance(spark, sf):
    cards = _monthly(spark, sf).withColumn("use", F.col("balance") / r.at_least(F.col("lim"), 1.0))
    return r.aggregate_children(cards, "sid", [
        M("n_contracts", "nunique", "contract"), M("n_months", "count", "month"), M("avg_balance", "mean", "balance"), M("max_balance", "max", "balance"),
        M("avg_limit", "mean", "lim"), M("avg_use", "mean", "use"), M("max_use", "max", "use"), M("avg_payment", "mean", "payment"), M("n_dpd", "count_above", "dpd", 25.0)],
        [("dpd_ratio", "n_dpd", "n_months"), ("payment_balance", "avg_payment", "avg_balance", "abs")])


@query("agg_children_compact", """SELECT id, count(child_id) AS n, count_if(status = 'O')::BIGINT AS n_refused, avg(amt) AS avg_amt,
 count_if(status = 'O') / greatest(count(child_id), 1) AS refusal_rate FROM v_child GROUP BY id""", ["v_child"], doubles="avg_amt refusal_rate")
def agg_children_compact(spark, sf):
    return r.aggregate_children(view(spark, sf, "v_child"), "id", [M("n", "count", "child_id"), M("n_refused", "count_in", "status", ("O",)), M("avg_amt", "mean", "amt")],
                                [("refusal_rate", "n_refused", "n")])


@query("agg_children_per_parent", "SELECT count(*) AS n_parents, avg(c) AS mean_children FROM (SELECT count(*) AS c FROM v_child GROUP BY id)", ["v_child"], doubles="mean_children")
def agg_children_per_parent(spark, sf):
    return r.children_per_parent(view(spark, sf, "v_child"), "id")


@query("auto_aggregate", """
WITH k AS (SELECT id, arg_min(kind, struct_pack(n := -n, v := kind)) AS mode FROM (SELECT id, kind, count(*) AS n FROM v_child GROUP BY id, kind) GROUP BY id),
s AS (SELECT id, arg_min(status, struct_pack(n := -n, v := status)) AS mode FROM (SELECT id, status, count(*) AS n FROM v_child GROUP BY id, status) GROUP BY id)
SELECT v_child.id, count(*) AS o_count, sum(amt) AS o_sum_amt, avg(amt) AS o_mean_amt, min(amt) AS o_min_amt, max(amt) AS o_max_amt, stddev_samp(amt) AS o_std_amt,
 CASE WHEN count(amt) > 2 THEN skewness(amt) END AS o_skew_amt, sum(days)::DOUBLE AS o_sum_days, avg(days) AS o_mean_days, min(days)::DOUBLE AS o_min_days,
 max(days)::DOUBLE AS o_max_days, stddev_samp(days) AS o_std_days, CASE WHEN count(days) > 2 THEN skewness(days) END AS o_skew_days, avg((amt > 100000)::INT) AS o_percent_true_big,
 count(DISTINCT status) AS o_num_unique_status, any_value(s.mode) AS o_mode_status, count(DISTINCT kind) AS o_num_unique_kind, any_value(k.mode) AS o_mode_kind
FROM v_child JOIN k ON k.id = v_child.id JOIN s ON s.id = v_child.id GROUP BY v_child.id""", ["v_child"],
       doubles="o_sum_amt o_mean_amt o_min_amt o_max_amt o_std_amt o_skew_amt o_sum_days o_mean_days o_min_days o_max_days o_std_days o_skew_days o_percent_true_big", digits=5)
def auto_aggregate(spark, sf):
    child = view(spark, sf, "v_child").withColumn("big", F.col("amt") > 100000)
    return r.auto_aggregate(child, "id", "o", skip=["child_id"])


JOINED = f"""WITH {CREDIT_SQL}, {PRIOR_SQL} SELECT v_app.id, target, {{}} FROM v_app LEFT JOIN credit ON credit.id = v_app.id LEFT JOIN prior ON prior.id = v_app.id"""
JCOLS = ["credit_n", "credit_sum", "credit_bb_n_dpd", "credit_open_ratio", "prev_n", "prev_refusal_rate"]


def joined(spark, sf):
    return r.join_feature_tables(view(spark, sf, "v_app"), "id", credit(spark, sf), prior(spark, sf))


@query("join_feature_tables", JOINED.format(", ".join(JCOLS)), ["v_app", "v_hist", "v_child"], doubles="credit_sum credit_open_ratio prev_refusal_rate", digits=4)
def join_feature_tables(spark, sf):
    return joined(spark, sf).select("id", "target", *JCOLS)


@query("join_fill_history", JOINED.format(", ".join(f"coalesce({c}, 0) AS {c}" for c in JCOLS) + ", amt_c"), ["v_app", "v_hist", "v_child"],
       doubles="credit_sum credit_open_ratio prev_refusal_rate amt_c", digits=4)
def join_fill_history(spark, sf):
    return r.fill_history(joined(spark, sf), JCOLS).select("id", "target", *JCOLS, "amt_c")


@query("semi_join_keys", f"SELECT child_id, id, amt FROM v_child WHERE id IN (SELECT id FROM v_app WHERE {h()}::DOUBLE / 1152921504606846976::DOUBLE < 0.1)",
       ["v_app", "v_child"], doubles="amt")
def semi_join_keys(spark, sf):
    parents = t.scan_sampled(view(spark, sf, "v_app"), "id", share=0.1, seed=SEED)
    return r.keep_known_keys(view(spark, sf, "v_child").select("child_id", "id", "amt"), parents, "id")


@query("lookup_map", """WITH m AS (SELECT segment, avg(target) AS rate FROM v_app WHERE segment <> 'BUILDING' GROUP BY segment)
SELECT id, v_app.segment, coalesce(rate, -1) AS rate FROM v_app LEFT JOIN m ON m.segment = v_app.segment""", ["v_app"], doubles="rate")
def lookup_map(spark, sf):
    app = view(spark, sf, "v_app").select("id", "segment", "target")
    rates = app.where("segment <> 'BUILDING'").groupBy("segment").agg(F.avg("target").alias("rate"))
    return r.lookup(app.drop("target"), rates, "segment", "rate", "rate", -1.0)


@query("union_splits", """SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE target END::INTEGER AS target, amt_a,
 CASE WHEN id % 4 > 1 THEN 'train' WHEN id % 4 = 1 THEN 'validation' ELSE 'test' END AS split FROM v_app""", ["v_app"], doubles="amt_a")
def union_splits(spark, sf):
    app = view(spark, sf, "v_app").select("id", "target", "amt_a")
    return r.union_splits({"train": app.where("id % 4 > 1"), "validation": app.where("id % 4 = 1"), "test": app.where("id % 4 = 0").drop("target")})


@query("column_set_difference", """
SELECT 'missing' AS side, 'amt' AS column_name, count(amt) AS n_present FROM v_child UNION ALL SELECT 'missing', 'days', count(days) FROM v_child
UNION ALL SELECT 'missing', 'id', count(id) FROM v_child UNION ALL SELECT 'missing', 'kind', count(kind) FROM v_child
UNION ALL SELECT 'extra', 'disc', count(disc) FROM v_hist UNION ALL SELECT 'extra', 'due', count(due) FROM v_hist UNION ALL SELECT 'extra', 'paid', count(paid) FROM v_hist
UNION ALL SELECT 'extra', 'qty', count(qty) FROM v_hist UNION ALL SELECT 'extra', 'step', count(step) FROM v_hist""", ["v_child", "v_hist"])
def column_set_difference(spark, sf):
    from riskframe.functions.frames import spread
    a, b = view(spark, sf, "v_child"), view(spark, sf, "v_hist")
    missing, extra = r.column_difference(a, b)
    return (spread(a, missing, {"n_present": F.count}, name="column_name").withColumn("side", F.lit("missing"))
            .unionByName(spread(b, extra, {"n_present": F.count}, name="column_name").withColumn("side", F.lit("extra"))))


@query("sort_nulls_last", "SELECT id, half_missing FROM v_app ORDER BY half_missing DESC NULLS LAST", ["v_app"], doubles="half_missing")
def sort_nulls_last(spark, sf):
    return r.sort_nulls_last(view(spark, sf, "v_app").select("id", "half_missing"), "half_missing")


@query("top_k", "SELECT id, days_emp FROM v_app ORDER BY abs(days_emp) DESC, id LIMIT 25", ["v_app"])
def top_k(spark, sf):
    return r.top_k(view(spark, sf, "v_app").select("id", "days_emp"), "days_emp", 25, absolute=True, tie=["id"])


@query("cumulative_best", """
SELECT trial, strategy, score, max(score) OVER (PARTITION BY strategy ORDER BY trial ROWS UNBOUNDED PRECEDING) AS best_so_far FROM (
SELECT datediff('day', TIMESTAMP '2024-01-01', ts) AS trial, event_type AS strategy, round(avg(value), 6) AS score FROM events GROUP BY 1, 2)""", doubles="score best_so_far")
def cumulative_best(spark, sf):
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    trials = table(spark, sf, "events").groupBy(day.alias("trial"), F.col("event_type").alias("strategy")).agg(F.round(F.avg("value"), 6).alias("score"))
    return r.cumulative_best(trials, "trial", "score", "strategy")
