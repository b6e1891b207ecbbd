"""Column lists, defaults and other fixed values shared by the whole library."""

from __future__ import annotations

# The raw event columns, in file order.
EVENT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)

# Event types that survive cleaning by default, in funnel order.
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")

# Cells read as missing (the default list of pandas' CSV reader).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Text cells that count as missing after stripping.
EMPTY_TEXT = ("", "nan", "None")

# Count column of the daily table for each event type.
COUNT_COLUMNS = {
    "view": "views",
    "cart": "carts",
    "remove_from_cart": "removals",
    "purchase": "purchases",
}

# Daily counts that get trailing sums.
ROLLED_COLUMNS = ("views", "carts", "purchases")

ROLLING_WINDOW = 7
TARGET = "purchases_next_day"

# Model inputs, in model order.
FEATURES = (
    "views",
    "carts",
    "removals",
    "purchases",
    "views_7d",
    "carts_7d",
    "purchases_7d",
)

# Model names in listing order; ties on the error keep this order.
BASELINES = ("lag1", "ma7", "hist_mean")
TREE_MODELS = ("random_forest", "gbt_depthwise", "gbt_leafcap")
MODELS = BASELINES + TREE_MODELS
# Models of this library's own: bags by key, second-order and leaf-wise boosting.
KEYED_MODELS = ("forest_keyed", "gbt_second_order", "gbt_leafwise")

SEED = 42

# Default tree settings.
MODEL_DEFAULTS = {
    "random_forest": {
        "n_estimators": 100,
        "max_depth": 12,
        "min_samples_leaf": 5,
        "max_features": "all",
    },
    "gbt_depthwise": {
        "n_estimators": 200,
        "max_depth": 8,
        "learning_rate": 0.1,
        "subsample": 0.8,
        "colsample": 0.8,
    },
    "gbt_leafcap": {
        "n_estimators": 200,
        "max_depth": 8,
        "num_leaves": 31,
        "learning_rate": 0.1,
        "colsample": 0.8,
    },
}

MODEL_DEFAULTS["forest_keyed"] = MODEL_DEFAULTS["random_forest"]
MODEL_DEFAULTS["gbt_second_order"] = {
    **MODEL_DEFAULTS["gbt_depthwise"],
    "reg_lambda": 1.0,
    "min_child_weight": 1.0,
}
MODEL_DEFAULTS["gbt_leafwise"] = {
    **MODEL_DEFAULTS["gbt_leafcap"],
    "reg_lambda": 0.0,
    "min_child_samples": 20,
}

# Parameter values that the search draws from.
SEARCH_SPACES = {
    "random_forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [8, 10, 12, 15, None],
        "min_samples_leaf": [2, 5, 10],
        "max_features": ["sqrt", "log2", 0.5],
    },
    "gbt_depthwise": {
        "n_estimators": [100, 200, 300],
        "learning_rate": [0.05, 0.1, 0.2],
        "max_depth": [4, 6, 8],
        "subsample": [0.7, 0.8, 1.0],
        "colsample": [0.7, 0.8, 1.0],
    },
    "gbt_leafcap": {
        "n_estimators": [100, 200, 300],
        "learning_rate": [0.05, 0.1, 0.2],
        "num_leaves": [31, 63, 127],
        "subsample": [0.7, 0.8, 1.0],
        "min_child_samples": [10, 20, 50],
    },
}

SEARCH_DRAWS = 12
SEARCH_FOLDS = 3

# The three experiment set-ups.
EXPERIMENTS = {
    "e1": {"train_days": 23, "test_days": 7},
    "e2": {"train_end": "2019-10-30", "test_start": "2019-11-01", "test_days": 7},
    "e_final": {"train_end": "2019-11-15", "test_start": "2019-11-16", "test_days": 14},
}

# Notes of lookups and reports that have no data.
NO_DATA = "no data for this product/date combination"
NO_GOLD = "no gold rows for date {date}"
NO_VIEWS = "no products with views >= {views} on {date}"

ATTRIBUTION_ROWS = 5000
ATTRIBUTION_BACKGROUND = 50
