"""Splits, samples and folds."""

from __future__ import annotations

from riskframe.operators import split as s
from riskframe.plans.q_sources import h
from riskframe.plans.registry import query
from riskframe.plans.settings import SEED
from riskframe.plans.views import staged, view


def quota_sql(total: str, name: str = "k") -> str:
    """Largest-remainder quota of ``total`` rows per class."""
    return f"""SELECT target, (floor(ex) + CASE WHEN row_number() OVER (ORDER BY ex - floor(ex) DESC, target) <= t - sum(floor(ex)) OVER ()
 THEN 1 ELSE 0 END)::BIGINT AS {name} FROM (SELECT target, count(*) * ({total}) / sum(count(*)) OVER () AS ex, {total} AS t
 FROM v_app, (SELECT count(*) AS n FROM v_app) GROUP BY target, n)"""


RANKED = f"""SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY {h()}, id) AS rn,
 row_number() OVER (ORDER BY {h()}, id) AS rn_all, count(*) OVER (PARTITION BY target) AS c FROM v_app"""
SPLIT = f"""WITH q AS ({quota_sql('ceil(0.2::DOUBLE * n)')}), r AS ({RANKED}),
s AS (SELECT id, r.target, CASE WHEN rn <= k THEN 'validation' ELSE 'train' END AS split FROM r JOIN q ON r.target = q.target)"""


@query("split_stratified", SPLIT + " SELECT id, target, split FROM s", ["v_app"])
def split_stratified(spark, sf):
    return s.stratified_split(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 0.2, SEED)


@query("split_random", f"""WITH r AS ({RANKED}) SELECT id, CASE WHEN rn_all <= ceil(0.2::DOUBLE * (SELECT count(*) FROM v_app))
 THEN 'validation' ELSE 'train' END AS split FROM r""", ["v_app"])
def split_random(spark, sf):
    return s.stratified_split(staged(spark, sf, "v_app").select("id"), "id", None, 0.2, SEED)


@query("split_three_way", f"""WITH a AS ({quota_sql('ceil(0.15::DOUBLE * n)', 'k1')}), b AS ({quota_sql('ceil(0.3::DOUBLE * n)', 'k2')}),
 r AS ({RANKED}) SELECT id, r.target, CASE WHEN rn <= k1 THEN 'test' WHEN rn <= k2 THEN 'validation' ELSE 'train' END AS split
 FROM r JOIN a ON a.target = r.target JOIN b ON b.target = r.target""", ["v_app"])
def split_three_way(spark, sf):
    return s.three_way_split(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 0.15, 0.15, SEED)


@query("split_balance_report", SPLIT + " SELECT split, count(*) AS n_rows, avg(target) AS positive_rate FROM s GROUP BY split",
       ["v_app"], doubles="positive_rate")
def split_balance_report(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "target")
    return s.split_balance(s.stratified_split(app, "id", "target", 0.2, SEED), "target")


@query("sample_stratified_cap", f"""WITH q AS ({quota_sql('500')}), r AS ({RANKED})
 SELECT id, r.target FROM r JOIN q ON r.target = q.target WHERE rn <= k""", ["v_app"])
def sample_stratified_cap(spark, sf):
    return s.sample_stratified_cap(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 500, SEED)


@query("sample_n", f"WITH r AS ({RANKED}) SELECT id, target FROM r WHERE rn_all <= 333", ["v_app"])
def sample_n(spark, sf):
    return s.sample_exact(staged(spark, sf, "v_app").select("id", "target"), "id", 333, SEED)


@query("fold_kfold", f"SELECT child_id, ({h('child_id')} % 5)::INTEGER AS fold FROM v_child", ["v_child"])
def fold_kfold(spark, sf):
    return s.hash_folds(view(spark, sf, "v_child").select("child_id"), "child_id", 5, SEED)


@query("fold_stratified", f"WITH r AS ({RANKED}) SELECT id, target, ((rn - 1) * 4 // c)::INTEGER AS fold FROM r", ["v_app"])
def fold_stratified(spark, sf):
    return s.stratified_folds(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 4, SEED)


@query("fold_repeated", " UNION ALL ".join(f"""SELECT id, target, {r}::INTEGER AS repeat,
 ((row_number() OVER (PARTITION BY target ORDER BY {h('id', SEED + r)}, id) - 1) * 3 // count(*) OVER (PARTITION BY target))::INTEGER AS fold
 FROM v_app""" for r in (1, 2)), ["v_app"])
def fold_repeated(spark, sf):
    return s.repeated_folds(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 3, 2, SEED)


@query("split_holdout", SPLIT + " SELECT id, target, CASE WHEN split = 'train' THEN 'fit' ELSE 'holdout' END AS part FROM s", ["v_app"])
def split_holdout(spark, sf):
    return s.holdout_split(staged(spark, sf, "v_app").select("id", "target"), "id", "target", 0.2, SEED)
