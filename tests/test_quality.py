import pytest
from pyspark.sql import functions as F

from riskframe.operators import quality as q


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, 5.0, "f", 0), (2, 1.0, "M", 1), (3, None, None, 0), (4, 10.0, "F", 1), (5, float("nan"), "m", 0)],
        "id long, amt double, sex string, y int")


RULES = q.suite_from_config({"amt": {"min_value": 1, "max_value": 10}}, {"sex": ["F", "M"]}, {"y": [0, 1]}, ["id"])


def verdicts(df, rules=RULES, fold=True):
    return {r.rule: r.success for r in q.evaluate_rules(df, rules, fold).collect()}


def test_clean_table_passes_with_bounds_included(table):
    assert all(verdicts(table).values())


@pytest.mark.parametrize("change, broken", [
    ({"amt": "0.99"}, "between:amt"), ({"amt": "10.01"}, "between:amt"), ({"sex": "'X'"}, "distinct_in_set:sex"),
    ({"y": "2"}, "distinct_in_set:y"), ({"id": "1"}, "unique:id"), ({"y": "null"}, "not_null:y")])
def test_each_rule_fires_alone(table, change, broken):
    (c, v), = change.items()
    bad = table.withColumn(c, F.when(F.col("id") == 2, F.expr(v)).otherwise(F.col(c)))
    got = verdicts(bad)
    assert [r for r, ok in got.items() if not ok] == [broken]


def test_case_matters_without_folding(table):
    assert not verdicts(table, fold=False)["distinct_in_set:sex"]


def test_absent_column_fails_the_rule_not_the_job(table):
    assert verdicts(table, [q.between("gone", 0), q.unique("id")]) == {"between:gone": False, "unique:id": True}


def test_every_member_of_a_duplicate_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "id long")
    row = q.duplicate_rows(df, "id").first()
    assert (row.n_rows, row.n_present, row.n_bad) == (5, 4, 3)


def test_report_shape_and_sample(table):
    bad = table.withColumn("amt", F.lit(99.0))
    rows = {r.expectation_type + ":" + r.column: r for r in q.quality_report(bad, RULES).collect()}
    r = rows["between:amt"]
    assert (r.element_count, r.unexpected_count, r.unexpected_percent) == (5, 5, 100.0)
    assert r.partial_unexpected_list == "99.0,99.0,99.0,99.0,99.0"
    assert rows["distinct_in_set:sex"].element_count is None and rows["distinct_in_set:sex"].observed_value == "F,M"


def test_gate_keeps_the_report_and_raises(spark, table, tmp_path):
    path = str(tmp_path / "report")
    bad = table.withColumn("amt", F.lit(-1.0))
    with pytest.raises(q.QualityGateError):
        q.quality_gate(bad, q.quality_report(bad, RULES), path)
    assert spark.read.parquet(path).where("not success").count() == 1
    assert q.quality_gate(table, q.quality_report(table, RULES)).count() == 5


def test_quarantine_partitions_the_rows(table):
    good, bad = q.quarantine(table, [q.between("amt", 2), q.not_null("sex"), q.unique("id")])
    assert good.count() + bad.count() == 5
    assert {r.id: sorted(r.broken_rules) for r in bad.collect()} == {2: ["between:amt"], 3: ["not_null:sex"]}


def test_tolerance(table):
    assert verdicts(table, [q.between("amt", 2, mostly=0.6)])["between:amt"]
    assert not verdicts(table, [q.between("amt", 2, mostly=0.9)])["between:amt"]
