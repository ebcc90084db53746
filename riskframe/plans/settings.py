"""Settings of the registered queries on the test-table views."""

from __future__ import annotations

from riskframe.operators.clean import CleaningConfig
from riskframe.operators import quality as q

SEED = 42
APP_NUMERIC = ["days_emp", "half_missing", "cnt_a", "amt_a", "amt_a_dup", "amt_b", "amt_c", "near_const"]
APP_TEXT = ["segment", "nation", "region", "flag_yn"]
SENTINEL = 365243

SEGMENTS = ["Automobile", "Building", "Furniture", "Machinery", "Household"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

APP_RULES = [
    q.between("cnt_a", 1, 18),
    q.between("amt_a", 1, None),
    q.between("days_emp", None, 0),
    q.between("amt_b", 1000, 600000),
    q.between("not_there", 0, 1),
    q.distinct_in_set("segment", SEGMENTS),
    q.distinct_in_set("flag_yn", ["Y"]),
    q.distinct_in_set("near_const", [0, 1]),
    q.distinct_in_set("target", [0, 1]),
    q.unique("id"),
    q.not_null("target"),
    q.not_null("nation"),
]

CLEANING = CleaningConfig(
    id_columns=("id",), target="target",
    sentinels=(("days_emp", "days_emp_anom", SENTINEL),),
    zero_fill=("cnt_a",), constant_fill={"nation": "Unknown"}, median_fill=("days_emp",), median_int=("amt_c",),
    cast_int=("days_emp",), bounds={"amt_b": (60000.0, 400000.0), "cnt_a": (0.0, None)},
)

BINARY = {"flag_yn": {"N": 0, "Y": 1}}
REGION_RULES = {"region_ASIA": ("region", "ASIA"), "region_EUROPE": ("region", "EUROPE"),
                "segment_BUILDING": ("segment", "BUILDING"), "other_X": ("no_column", "X")}
