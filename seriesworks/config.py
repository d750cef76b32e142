"""Defaults shared by the operators."""

from __future__ import annotations

# --------------------------------------------------------------------------
# Column lists, names, windows, thresholds and model parameters
# that must be equal for results to be equal.
# --------------------------------------------------------------------------

SALES_COLUMNS = [
    "gcode", "create_dt", "qty", "invoice_price", "cust_name", "code", "gname",
    "mfr_custno", "mfr_name", "pack_l", "pack_m", "purchase_price",
    "invoice_wholesale_price", "whs_attr_code", "pzwh", "prod_dt", "valid_dt",
    "sale_area_id", "contno", "purchase_tax_rate", "invoice_tax_rate",
]

PRODUCT_COLUMNS = [
    "gcode", "prod_cat1", "prod_cat2", "prod_cat3", "finance_prod_cat1",
    "finance_prod_cat2", "retail_prod_cat1", "retail_prod_cat2",
    "retail_prod_cat3", "dosage_form_code", "dosage_form",
    "retail_dosage_form", "holder_name", "pzwh", "registration_no",
    "license_no", "management_rule", "herbal_name", "prod_sale_name",
    "sale_catalog_type", "is_self_purchase", "rebate_type",
    "maintenance_type", "priority_maintenance_type", "trace_code_type",
    "is_disassembly", "unit", "spn", "model", "units_per_pkg", "pkg_length",
    "pkg_width", "pkg_height", "small_pkg_length", "small_pkg_width",
    "small_pkg_height", "pkg_material", "basic_drug_type", "gpo_type",
    "is_high_value_consumable", "med_ins_catalog_type",
    "is_national_negotiation", "strategic_type", "is_essential_sale",
    "stimulant_type", "is_special_compound", "emergency_type",
    "epidemic_prevention", "value_level", "prescription_type", "origin",
    "trademark", "bar", "medicare_code", "product_series", "is_reserve",
    "storage_condition", "usage", "status", "attr_json",
]


CSV_DATE_COLUMNS = ["date", "create_dt", "prod_dt", "valid_dt"]

SERIES_RENAMES = {
    "create_dt": "date",
    "qty": "sales_quantity",
    "gcode": "drug_id",
    "cust_name": "hospital_id",
}

KEYS = ("drug_id", "hospital_id")
DATE = "date"
TARGET = "sales_quantity"

DATE_FEATURES = [
    "year", "month", "day", "dayofweek", "quarter", "is_weekend",
    "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
]
LAGS = [1, 2, 3, 7, 14, 30]
WINDOWS = [7, 14, 30, 90]
STATISTICS = ["mean", "std", "min", "max", "median"]
DIFF_PERIODS = [1, 7]
HOLIDAY_DISTANCE_CAP = 999
HOLIDAY_NEAR_DAYS = 3
RATIO_EPSILON = 1e-5

OUTLIER_THRESHOLD = 3.0
WINSOR_LIMITS = (0.01, 0.99)
SEQUENCE_IN, SEQUENCE_OUT = 30, 1

TEST_SIZE = 0.2
VALIDATION_SHARE = 0.1
CV_FOLDS = 5
MIN_POINTS = 100
CV_INITIAL_DAYS, CV_PERIOD_DAYS, CV_HORIZON_DAYS = 365, 90, 30
FORECAST_HORIZON = 30
SELECT_THRESHOLD = 0.01

DRIFT_LEVEL = 0.05
DRIFT_BINS = 10
PERFORMANCE_TOLERANCE = 0.1
RMSE_ALERT = 100.0
RESIDUAL_BINS = 50
STALE_YEAR = 2000

AUTO_MIN_RECORDS, AUTO_TOP_PRODUCTS, AUTO_TOP_CUSTOMERS = 500, 20, 10

BOOSTING_PARAMS = {
    "objective": "regression",
    "metric": "rmse",
    "boosting_type": "gbdt",
    "num_leaves": 31,
    "learning_rate": 0.05,
    "feature_fraction": 0.9,
    "bagging_fraction": 0.8,
    "bagging_freq": 5,
    "max_depth": -1,
    "min_data_in_leaf": 20,
    "lambda_l1": 0.0,
    "lambda_l2": 0.0,
    "min_gain_to_split": 0.0,
    "random_state": 42,
    "num_boost_round": 1000,
    "early_stopping_rounds": 50,
}

SEARCH_SPACE = {
    "num_leaves": (20, 100),
    "learning_rate": (0.01, 0.3),
    "feature_fraction": (0.6, 1.0),
    "bagging_fraction": (0.6, 1.0),
    "max_depth": (3, 12),
    "min_data_in_leaf": (10, 50),
}

# (name, period in days, order)
SEASONALITIES = [("yearly", 365.25, 10), ("weekly", 7.0, 3), ("monthly", 30.5, 5)]

ENSEMBLE_WEIGHTS = {"lightgbm": 0.5, "xgboost": 0.3, "prophet": 0.2}

FEATURE_VIEWS = {
    "sales_features": {
        "keys": ["gcode", "cust_name"],
        "timestamp": "create_dt",
        "ttl_days": 365,
        "fields": {
            "sales_quantity_lag_1": "float",
            "sales_quantity_lag_7": "float",
            "sales_quantity_lag_30": "float",
            "sales_quantity_rolling_7_mean": "float",
            "sales_quantity_rolling_14_mean": "float",
            "sales_quantity_rolling_30_mean": "float",
            "sales_quantity_rolling_7_std": "float",
            "sales_quantity_rolling_30_std": "float",
            "month": "bigint",
            "dayofweek": "bigint",
            "quarter": "bigint",
            "is_weekend": "bigint",
        },
    },
    "drug_info_features": {
        "keys": ["gcode"],
        "timestamp": "event_timestamp",
        "ttl_days": 3650,
        "fields": {
            "prod_cat1": "string",
            "prod_cat2": "string",
            "dosage_form": "string",
            "holder_name": "string",
            "pzwh": "string",
        },
    },
}
