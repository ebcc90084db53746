"""Settings for credit applications and their six child tables.

Everything here is configuration of the generic operators; other data needs other settings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskframe.functions.scalars import at_least, col
from riskframe.operators import features, quality as q, relate
from riskframe.operators.clean import CleaningConfig, clean_child_table
from riskframe.operators.relate import Measure as M

# --- fixed values: columns, rules and labels of the credit tables -----------------------------

ID, TARGET = "SK_ID_CURR", "TARGET"
SENTINEL = 365243

NUMERIC_RULES = {
    "AMT_INCOME_TOTAL": {"min_value": 1},
    "AMT_CREDIT": {"min_value": 1},
    "DAYS_BIRTH": {"max_value": -1},
    "CNT_CHILDREN": {"min_value": 0},
    "EXT_SOURCE_2": {"min_value": 0, "max_value": 1},
    "EXT_SOURCE_3": {"min_value": 0, "max_value": 1},
    "AMT_ANNUITY": {"min_value": 1},
    "AMT_GOODS_PRICE": {"min_value": 1},
    "DAYS_EMPLOYED": {"max_value": SENTINEL},
    "OBS_60_CNT_SOCIAL_CIRCLE": {"min_value": 0},
    **{f"AMT_REQ_CREDIT_BUREAU_{p}": {"min_value": 0} for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")},
    "HOUR_APPR_PROCESS_START": {"min_value": 0, "max_value": 23},
    "REGION_POPULATION_RELATIVE": {"min_value": 0},
    "OBS_30_CNT_SOCIAL_CIRCLE": {"min_value": 0},
    "DEF_30_CNT_SOCIAL_CIRCLE": {"min_value": 0},
    "DEF_60_CNT_SOCIAL_CIRCLE": {"min_value": 0},
    "DAYS_LAST_PHONE_CHANGE": {"max_value": 0},
    "DAYS_REGISTRATION": {"max_value": 0},
    "DAYS_ID_PUBLISH": {"max_value": 0},
    "CNT_FAM_MEMBERS": {"min_value": 1},
}

ORGANIZATIONS = (
    ["Advertising", "Agriculture", "Bank"] + [f"Business Entity Type {i}" for i in range(1, 4)]
    + ["Cleaning", "Construction", "Culture", "Electricity", "Emergency", "Government", "Hotel", "Housing"]
    + [f"Industry: type {i}" for i in range(1, 14)]
    + ["Insurance", "Kindergarten", "Legal Services", "Medicine", "Military", "Mobile", "Other", "Police", "Postal", "Realtor",
       "Religion", "Restaurant", "School", "Security", "Security Ministries", "Self-employed", "Services", "Telecom"]
    + [f"Trade: type {i}" for i in range(1, 8)] + [f"Transport: type {i}" for i in range(1, 5)] + ["University", "XNA"])

VALUE_SETS = {
    "CODE_GENDER": ["F", "M", "XNA"],
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
    "FLAG_OWN_CAR": ["Y", "N"],
    "FLAG_OWN_REALTY": ["Y", "N"],
    "NAME_TYPE_SUITE": ["Children", "Family", "Group of people", "Other_A", "Other_B", "Spouse, partner", "Unaccompanied"],
    "NAME_INCOME_TYPE": ["Businessman", "Commercial associate", "Maternity leave", "Pensioner", "State servant", "Student",
                         "Unemployed", "Working"],
    "NAME_EDUCATION_TYPE": ["Academic degree", "Higher education", "Incomplete higher", "Lower secondary",
                            "Secondary / secondary special"],
    "NAME_FAMILY_STATUS": ["Civil marriage", "Married", "Separated", "Single / not married", "Unknown", "Widow"],
    "NAME_HOUSING_TYPE": ["Co-op apartment", "House / apartment", "Municipal apartment", "Office apartment", "Rented apartment",
                          "With parents"],
    "OCCUPATION_TYPE": ["Accountants", "Cleaning staff", "Cooking staff", "Core staff", "Drivers", "HR staff",
                        "High skill tech staff", "IT staff", "Laborers", "Low-skill Laborers", "Managers", "Medicine staff",
                        "Private service staff", "Realty agents", "Sales staff", "Secretaries", "Security staff",
                        "Waiters/barmen staff"],
    "ORGANIZATION_TYPE": ORGANIZATIONS,
    "WEEKDAY_APPR_PROCESS_START": ["FRIDAY", "MONDAY", "SATURDAY", "SUNDAY", "THURSDAY", "TUESDAY", "WEDNESDAY"],
    "REGION_RATING_CLIENT": [1, 2, 3],
    **{f"FLAG_DOCUMENT_{i}": [0, 1] for i in range(2, 22)},
    **{c: [0, 1] for c in (
        "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL",
        "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
        "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY")},
}
TARGET_SETS = {TARGET: [0, 1]}

CLEANING = CleaningConfig(
    id_columns=(ID,), target=TARGET, missing_threshold=0.45, corr_threshold=0.9, near_constant_threshold=0.95,
    sentinels=(("DAYS_EMPLOYED", "DAYS_EMPLOYED_ANOM", SENTINEL),),
    zero_fill=("AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR",
               "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"),
    constant_fill={"OCCUPATION_TYPE": "Unknown"},
    median_fill=("AMT_ANNUITY", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_EMPLOYED"),
    median_int=("CNT_FAM_MEMBERS", "DAYS_LAST_PHONE_CHANGE"),
    cast_int=("DAYS_EMPLOYED", "DAYS_REGISTRATION", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
              "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", "AMT_REQ_CREDIT_BUREAU_MON",
              "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR"),
    bounds={c: (b.get("min_value"), b.get("max_value")) for c, b in NUMERIC_RULES.items()},
)

EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
BINARY = {"FLAG_OWN_CAR": {"N": 0, "Y": 1}, "FLAG_OWN_REALTY": {"N": 0, "Y": 1}}
TARGET_ENCODED = ["OCCUPATION_TYPE", "ORGANIZATION_TYPE"]
ONE_HOT_LIMIT, SMOOTHING, FOLDS = 10, 10, 5

SERVING_ONE_HOT = {
    "NAME_CONTRACT_TYPE_Cash_loans": ("NAME_CONTRACT_TYPE", "Cash loans"),
    "NAME_CONTRACT_TYPE_Revolving_loans": ("NAME_CONTRACT_TYPE", "Revolving loans"),
    "CODE_GENDER_F": ("CODE_GENDER", "F"),
    "CODE_GENDER_M": ("CODE_GENDER", "M"),
    "NAME_INCOME_TYPE_Pensioner": ("NAME_INCOME_TYPE", "Pensioner"),
    "NAME_INCOME_TYPE_Working": ("NAME_INCOME_TYPE", "Working"),
    "NAME_EDUCATION_TYPE_Higher_education": ("NAME_EDUCATION_TYPE", "Higher education"),
    "NAME_EDUCATION_TYPE_Secondary_/_secondary_special": ("NAME_EDUCATION_TYPE", "Secondary / secondary special"),
    "NAME_FAMILY_STATUS_Married": ("NAME_FAMILY_STATUS", "Married"),
}

GRIDS = {
    "RandomForestClassifier": {"n_estimators": [300], "max_depth": [10, 16], "min_samples_split": [10], "max_features": ["sqrt"]},
    "HistGradientBoostingClassifier": {"max_iter": [400], "learning_rate": [0.05], "max_depth": [3, 6], "l2_regularization": [0.0, 1.0]},
    "LGBMClassifier": {"n_estimators": [600], "learning_rate": [0.03], "num_leaves": [31, 63], "colsample_bytree": [0.8]},
    "GradientBoostingClassifier": {"n_estimators": [120], "learning_rate": [0.1], "max_depth": [3], "subsample": [0.8]},
    "WOELogisticRegression": {"woe__n_bins": [10, 20], "clf__C": [0.1, 1.0]},
}

HOUSING_BASES = ["APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "ELEVATORS", "ENTRANCES", "FLOORSMAX", "LANDAREA",
                 "LIVINGAREA", "NONLIVINGAREA"]
REDUNDANT = ["OBS_60_CNT_SOCIAL_CIRCLE", "REGION_RATING_CLIENT_W_CITY"]
WINSORIZED = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]

FEATURE_GROUPS = {"bureau_": "bureau", "prev_": "previous_application", "pos_": "pos_cash_balance",
                  "inst_": "installments_payments", "cc_": "credit_card_balance"}
FEATURE_METHODS = [
    ("financial_ratio", ["CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_ANNUITY_RATIO", "INCOME_PER_PERSON", "PAYMENT_RATE",
                         "CHILDREN_RATIO", "GOODS_PRICE_CREDIT_RATIO", "CREDIT_OVER_GOODS", "CREDIT_DURATION_MONTHS"], [], []),
    ("days_transform", ["AGE_YEARS", "EMPLOYED_YEARS", "REGISTRATION_YEARS", "ID_PUBLISH_YEARS", "PHONE_CHANGE_YEARS",
                        "EMPLOYED_TO_AGE_RATIO", "REG_TO_PUBLISH_RATIO"], [], []),
    ("ext_source_aggregate", ["EXT_SOURCE_MEAN", "EXT_SOURCE_STD", "EXT_SOURCE_MIN", "EXT_SOURCE_MAX", "EXT_SOURCE_PROD",
                              "EXT_SOURCE_N_MISS", "EXT_MEAN_CREDIT_RATIO"], [], []),
    ("cross_table_interaction", ["TOTAL_DEBT_TO_INCOME", "BUREAU_DEBT_TO_NEW_CREDIT", "COMPOUND_RISK_SCORE", "PAYMENT_RELIABILITY",
                                 "BUREAU_COVERAGE_RATIO"], [], []),
    ("target_encoding", [], [], ["_TE"]),
    ("secondary_table_aggregate", [], list(FEATURE_GROUPS), []),
    ("flag_aggregate", [], ["FLAG_", "DOCS", "BUREAU_INQ", "SOCIAL"], []),
]

CHILD_RULES = {
    "bureau": [q.between("AMT_CREDIT_SUM", 0), q.between("DAYS_CREDIT", high=0),
               q.distinct_in_set("CREDIT_ACTIVE", ["Active", "Bad debt", "Closed", "Sold"]),
               q.distinct_in_set("CREDIT_CURRENCY", [f"currency {i}" for i in range(1, 5)]), q.unique("SK_ID_BUREAU")],
    "bureau_balance": [q.between("MONTHS_BALANCE", high=0), q.distinct_in_set("STATUS", ["0", "1", "2", "3", "4", "5", "C", "X"])],
    "previous_application": [q.between("AMT_CREDIT", 0), q.between("AMT_APPLICATION", 0), q.between("AMT_ANNUITY", 0), q.unique("SK_ID_PREV")],
    "pos_cash_balance": [q.between("MONTHS_BALANCE", high=-1), q.between("CNT_INSTALMENT", 1), q.between("CNT_INSTALMENT_FUTURE", 0)],
    "installments_payments": [q.between("AMT_INSTALMENT", 0), q.between("AMT_PAYMENT", 0), q.between("DAYS_INSTALMENT", high=-1)],
    "credit_card_balance": [q.between("MONTHS_BALANCE", high=-1), q.between("AMT_CREDIT_LIMIT_ACTUAL", 0)],
}

# --- end of fixed values ------------------------------------------------------------------------


def application_rules(labelled: bool = True) -> list[q.Rule]:
    return q.suite_from_config(NUMERIC_RULES, VALUE_SETS, TARGET_SETS if labelled else {}, [ID])


def gold_rules(n_rows: int, n_columns: int) -> list[q.Rule]:
    """Checks on the finished feature table."""
    spans = {"AGE_YEARS": (18, 75), "EXT_SOURCE_MEAN": (0, 1), "EXT_SOURCE_MIN": (0, 1), "EXT_SOURCE_MAX": (0, 1),
             "CREDIT_INCOME_RATIO": (0, 100), "ANNUITY_INCOME_RATIO": (0, 5), "PAYMENT_RATE": (0, 1)}
    return [q.row_count(n_rows), q.column_count(n_columns), *[q.between(c, lo, hi, 0.99) for c, (lo, hi) in spans.items()]]


def application_features(df: DataFrame) -> DataFrame:
    """Stateless features of a cleaned application table."""
    out = features.financial_ratios(df, "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "CNT_CHILDREN")
    out = features.day_offsets(out, {
        "AGE_YEARS": "DAYS_BIRTH", "EMPLOYED_YEARS": "DAYS_EMPLOYED", "REGISTRATION_YEARS": "DAYS_REGISTRATION",
        "ID_PUBLISH_YEARS": "DAYS_ID_PUBLISH", "PHONE_CHANGE_YEARS": "DAYS_LAST_PHONE_CHANGE"},
        ("EMPLOYED_TO_AGE_RATIO", "EMPLOYED_YEARS", "AGE_YEARS"))
    out = features.row_stats(out, EXTERNAL_SCORES, "EXT_SOURCE")
    return features.prefix_sums(out, {"DOCS_COUNT": "FLAG_DOCUMENT_", "BUREAU_INQUIRIES_TOTAL": "AMT_REQ_CREDIT_BUREAU_"})


def bureau_features(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    history = relate.status_history(balance, "SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS", ("1", "2", "3", "4", "5"), ("4", "5"))
    status = lambda out, v: M(out, "count_in", "CREDIT_ACTIVE", (v,))
    return relate.aggregate_children(relate.join_feature_tables(bureau, "SK_ID_BUREAU", history), ID, [
        M("bureau_n_credits", "count", "SK_ID_BUREAU"), status("bureau_n_active", "Active"), status("bureau_n_closed", "Closed"),
        status("bureau_n_bad_debt", "Bad debt"), M("bureau_n_prolonged", "sum", "CNT_CREDIT_PROLONG"),
        M("bureau_avg_days_credit", "mean", "DAYS_CREDIT"), M("bureau_max_days_credit", "max", "DAYS_CREDIT"),
        M("bureau_avg_credit_enddate", "mean", "DAYS_CREDIT_ENDDATE"), M("bureau_total_credit_sum", "sum", "AMT_CREDIT_SUM"),
        M("bureau_avg_credit_sum", "mean", "AMT_CREDIT_SUM"), M("bureau_max_credit_sum", "max", "AMT_CREDIT_SUM"),
        M("bureau_total_credit_debt", "sum", "AMT_CREDIT_SUM_DEBT"), M("bureau_total_overdue", "sum", "AMT_CREDIT_SUM_OVERDUE"),
        M("bureau_max_overdue_ever", "max", "AMT_CREDIT_MAX_OVERDUE"), M("bureau_max_overdue_days", "max", "CREDIT_DAY_OVERDUE"),
        M("bureau_avg_annuity", "mean", "AMT_ANNUITY"), M("bureau_bb_months_avg", "mean", "bb_months_count"),
        M("bureau_bb_n_dpd_total", "sum", "bb_n_dpd"), M("bureau_bb_n_dpd_def_total", "sum", "bb_n_dpd_def"),
        M("bureau_bb_dpd_ratio_max", "max", "bb_dpd_ratio")],
        [("bureau_active_ratio", "bureau_n_active", "bureau_n_credits"),
         ("bureau_debt_credit_ratio", "bureau_total_credit_debt", "bureau_total_credit_sum")])


def previous_features(prev: DataFrame) -> DataFrame:
    days = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
    prev = clean_child_table(prev, ["AMT_ANNUITY"], days, SENTINEL)
    status = lambda out, v: M(out, "count_in", "NAME_CONTRACT_STATUS", (v,))
    kind = lambda out, v: M(out, "count_in", "NAME_CONTRACT_TYPE", (v,))
    share = lambda out, num: (out, num, "prev_n_applications")
    return relate.aggregate_children(prev, ID, [
        M("prev_n_applications", "count", "SK_ID_PREV"), status("prev_n_approved", "Approved"), status("prev_n_refused", "Refused"),
        status("prev_n_cancelled", "Canceled"), kind("prev_n_consumer", "Consumer loans"), kind("prev_n_cash", "Cash loans"),
        kind("prev_n_revolving", "Revolving loans"), M("prev_avg_credit", "mean", "AMT_CREDIT"), M("prev_max_credit", "max", "AMT_CREDIT"),
        M("prev_avg_annuity", "mean", "AMT_ANNUITY"), M("prev_avg_application", "mean", "AMT_APPLICATION"),
        M("prev_max_application", "max", "AMT_APPLICATION"), M("prev_avg_down_payment", "mean", "AMT_DOWN_PAYMENT"),
        M("prev_avg_days_decision", "mean", "DAYS_DECISION"), M("prev_min_days_decision", "min", "DAYS_DECISION"),
        M("prev_avg_cnt_payment", "mean", "CNT_PAYMENT"), M("prev_avg_rate_down_payment", "mean", "RATE_DOWN_PAYMENT"),
        M("prev_n_insured", "sum", "NFLAG_INSURED_ON_APPROVAL")],
        [share("prev_refusal_rate", "prev_n_refused"), share("prev_approval_rate", "prev_n_approved"),
         ("prev_credit_app_ratio", "prev_avg_credit", "prev_avg_application"), share("prev_consumer_ratio", "prev_n_consumer"),
         share("prev_revolving_ratio", "prev_n_revolving")])


def pos_features(pos: DataFrame) -> DataFrame:
    return relate.aggregate_children(pos, ID, [
        M("pos_n_contracts", "nunique", "SK_ID_PREV"), M("pos_n_months", "count", "MONTHS_BALANCE"), M("pos_last_month", "max", "MONTHS_BALANCE"),
        M("pos_avg_instalment", "mean", "CNT_INSTALMENT"), M("pos_avg_instalment_future", "mean", "CNT_INSTALMENT_FUTURE"),
        M("pos_n_completed", "count_in", "NAME_CONTRACT_STATUS", ("Completed",)), M("pos_n_active", "count_in", "NAME_CONTRACT_STATUS", ("Active",)),
        M("pos_max_dpd", "max", "SK_DPD"), M("pos_avg_dpd", "mean", "SK_DPD"), M("pos_sum_dpd", "sum", "SK_DPD"),
        M("pos_max_dpd_def", "max", "SK_DPD_DEF"), M("pos_avg_dpd_def", "mean", "SK_DPD_DEF"),
        M("pos_n_dpd_months", "count_above", "SK_DPD", 0), M("pos_n_dpd_def_months", "count_above", "SK_DPD_DEF", 0)],
        [("pos_dpd_ratio", "pos_n_dpd_months", "pos_n_months"), ("pos_completed_ratio", "pos_n_completed", "pos_n_months")])


def installment_features(inst: DataFrame) -> DataFrame:
    inst = features.payment_features(clean_child_table(inst, ["AMT_PAYMENT"]), "AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT")
    out = relate.aggregate_children(inst, ID, [
        M("inst_n_payments", "count", "SK_ID_PREV"), M("inst_n_contracts", "nunique", "SK_ID_PREV"), M("inst_avg_payment_ratio", "mean", "payment_ratio"),
        M("inst_min_payment_ratio", "min", "payment_ratio"), M("inst_n_on_time", "count_true", "paid_on_time"), M("inst_avg_days_late", "mean", "days_late"),
        M("inst_max_days_late", "max", "days_late"), M("inst_total_instalment", "sum", "AMT_INSTALMENT"), M("inst_total_payment", "sum", "AMT_PAYMENT"),
        M("inst_avg_days_early_late", "mean", "days_early_late")],
        [("inst_on_time_ratio", "inst_n_on_time", "inst_n_payments"), ("__paid", "inst_total_payment", "inst_total_instalment")])
    return out.withColumn("inst_underpayment", at_least(1.0 - F.col("__paid"), 0.0)).drop("__paid")


def card_features(cards: DataFrame) -> DataFrame:
    cards = cards.withColumn("balance_limit_ratio", col("AMT_BALANCE") / at_least(col("AMT_CREDIT_LIMIT_ACTUAL").cast("double"), 1.0))
    return relate.aggregate_children(cards, ID, [
        M("cc_n_contracts", "nunique", "SK_ID_PREV"), M("cc_n_months", "count", "MONTHS_BALANCE"), M("cc_avg_balance", "mean", "AMT_BALANCE"),
        M("cc_max_balance", "max", "AMT_BALANCE"), M("cc_avg_credit_limit", "mean", "AMT_CREDIT_LIMIT_ACTUAL"),
        M("cc_avg_utilisation", "mean", "balance_limit_ratio"), M("cc_max_utilisation", "max", "balance_limit_ratio"),
        M("cc_avg_drawings", "mean", "AMT_DRAWINGS_CURRENT"), M("cc_avg_payment", "mean", "AMT_PAYMENT_CURRENT"),
        M("cc_avg_receivable", "mean", "AMT_TOTAL_RECEIVABLE"), M("cc_max_dpd", "max", "SK_DPD"), M("cc_avg_dpd", "mean", "SK_DPD"),
        M("cc_n_dpd_months", "count_above", "SK_DPD", 0), M("cc_n_dpd_def_months", "count_above", "SK_DPD_DEF", 0)],
        [("cc_dpd_ratio", "cc_n_dpd_months", "cc_n_months"), ("cc_payment_balance", "cc_avg_payment", "cc_avg_balance", "abs")])


def with_child_features(app: DataFrame, children: Mapping[str, DataFrame]) -> DataFrame:
    """Application rows with the aggregates of the child tables given (by table name), no history as 0,
    and the interactions across tables."""
    made: list[DataFrame] = []
    if "bureau" in children and "bureau_balance" in children:
        made.append(bureau_features(children["bureau"], children["bureau_balance"]))
    for name, build in (("previous_application", previous_features), ("pos_cash_balance", pos_features),
                        ("installments_payments", installment_features), ("credit_card_balance", card_features)):
        if name in children:
            made.append(build(children[name]))
    joined = relate.join_feature_tables(app, ID, *made)
    filled = relate.fill_history(joined, [c for t in made for c in t.columns if c != ID])
    return features.cross_table_features(filled, "AMT_INCOME_TOTAL", "AMT_CREDIT", "bureau_total_credit_debt", "bureau_total_credit_sum",
                                         "prev_refusal_rate", "CREDIT_INCOME_RATIO", "inst_on_time_ratio", "pos_dpd_ratio")
