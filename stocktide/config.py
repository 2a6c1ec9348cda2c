"""Settings of a demand study: table layouts, windows, feature groups and model parameters.

A `Settings` object is immutable and validated when it is built, so a job that starts runs
with a consistent schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Column layouts of the three raw tables and of the long panel.
ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
CALENDAR_COLUMNS = (
    "d", "date", "wm_yr_wk", "weekday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
)
PRICE_COLUMNS = ("store_id", "item_id", "wm_yr_wk", "sell_price")
PANEL_COLUMNS = (
    "item_id", "dept_id", "cat_id", "store_id", "state_id", "date", "wm_yr_wk", "d",
    "sales", "sell_price", "weekday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2", "snap",
)
REQUIRED_PANEL_COLUMNS = ("item_id", "store_id", "date", "d", "sales", "sell_price", "snap")

# Expected row counts of the full retail data set.
EXPECTED_ROWS = {
    "calendar": 1969,
    "prices": 6841121,
    "sales_wide": 30490,
    "sales_melted": 59181090,
}

# The series key, the forecast horizon and the last training day index.
SERIES_KEYS = ("item_id", "store_id")
HORIZON = 28
TRAINING_CUTOFF = 1913
N_FOLDS = 3
NO_EVENT = "No Event"

# The twelve aggregation levels, in the order the series id is spelled.
HIERARCHY_LEVELS: dict[str, tuple[str, ...]] = {
    "total": (),
    "state": ("state_id",),
    "store": ("store_id",),
    "category": ("cat_id",),
    "department": ("dept_id",),
    "state_category": ("state_id", "cat_id"),
    "state_department": ("state_id", "dept_id"),
    "store_category": ("store_id", "cat_id"),
    "store_department": ("store_id", "dept_id"),
    "item": ("item_id",),
    "state_item": ("item_id", "state_id"),
    "item_store": ("item_id", "store_id"),
}

# Target encodings and the columns they are keyed by.
ENCODINGS: dict[str, tuple[str, ...]] = {
    "item": ("item_id",),
    "store": ("store_id",),
    "item_store": ("item_id", "store_id"),
    "store_dept": ("store_id", "dept_id"),
    "store_cat": ("store_id", "cat_id"),
}

# Model feature groups.
FEATURE_GROUPS: dict[str, tuple[str, ...]] = {
    "ids": ("item_id", "store_id", "state_id", "cat_id", "dept_id"),
    "weekly_pattern": ("day_of_week", "is_weekend"),
    "year": ("year",),
    "seasonality_month": ("month",),
    "seasonality_week": ("week_of_year",),
    "seasonality_dom": ("day_of_month",),
    "events": ("event_name_1", "event_type_1"),
    "snap": ("snap",),
    "price_level": (
        "sell_price", "price_max", "price_min", "price_mean", "price_norm",
        "price_unique_count",
    ),
    "price_change": ("price_weekly_change", "price_change_m", "price_change_y"),
    "lags": (
        "lag_28", "lag_29", "lag_30", "lag_31", "lag_32", "lag_33", "lag_34", "lag_35",
        "lag_56",
    ),
    "rolling_mean": (
        "rolling_mean_7", "rolling_mean_28", "rolling_mean_56",
        "rolling_positive_mean_7", "rolling_positive_mean_28",
        "rolling_positive_median_28", "rolling_positive_std_28", "rolling_positive_max_28",
    ),
    "intermittency": (
        "rolling_positive_rate_7", "rolling_positive_rate_28", "rolling_zero_rate_28",
        "days_since_last_sale",
    ),
    "enc_item_store": (
        "enc_item_mean", "enc_item_std", "enc_item_store_mean", "enc_item_store_std",
        "enc_store_mean", "enc_store_std", "enc_store_dept_mean", "enc_store_dept_std",
        "enc_store_cat_mean", "enc_store_cat_std",
    ),
    "trends_position": (
        "trend_28_vs_long", "trend_7_vs_28", "trend_28_vs_56", "item_vs_dept",
        "item_vs_cat",
    ),
}
CATEGORICAL_FEATURES = (
    "item_id", "store_id", "state_id", "cat_id", "dept_id", "weekday",
    "event_name_1", "event_type_1",
)
EXCLUDED_FEATURES = ("year", "weekday")

# Boosted-tree settings of the published runs and the tree counts tried.
GLOBAL_TREES = {
    "tweedie_variance_power": 1.1,
    "learning_rate": 0.1,
    "num_iterations": 500,
    "num_leaves": 64,
    "min_data_in_leaf": 2000,
    "max_bin": 63,
    "bagging_fraction": 1.0,
    "feature_fraction": 1.0,
    "seed": 42,
}
STORE_TREES = {
    "tweedie_variance_power": 1.1,
    "learning_rate": 0.05,
    "num_iterations": 2000,
    "num_leaves": 63,
    "min_data_in_leaf": 300,
    "max_bin": 63,
    "bagging_fraction": 0.8,
    "feature_fraction": 0.8,
    "lambda_l2": 0.1,
    "seed": 42,
}
TREE_GRID = (100, 200, 300, 400, 500, 750, 1000, 1500, 2000)
STORE_TREE_GRID = (50, 100, 150, 200, 250, 300, 400)
# Trees of the store models behind the published hold-out forecasts; the larger count above belongs to an earlier grid.
STORE_ROUNDS = 200

# Seeds, boosting rounds at most and trials of the search. Trials are more than its pruning rule waits for.
SEEDS = (1, 2, 3)
SEARCH_ROUNDS = 3000
N_TRIALS = 30

# Search ranges (low, high, log scale).
SEARCH_SPACE = {
    "num_leaves": (31, 255, True),
    "min_data_in_leaf": (100, 5000, True),
    "feature_fraction": (0.4, 1.0, False),
    "bagging_fraction": (0.4, 1.0, False),
    "lambda_l2": (1e-3, 10.0, True),
    "tweedie_variance_power": (1.05, 1.5, False),
}
#: The ranges that each learner reads.
TREE_SPACE = {k: SEARCH_SPACE[k] for k in ("num_leaves", "min_data_in_leaf", "feature_fraction", "bagging_fraction")}
GLM_SPACE = {k: SEARCH_SPACE[k] for k in ("lambda_l2", "tweedie_variance_power")}

#: Places of a linear model's vector that each id column is hashed to.
ID_WIDTH = 256


class SettingsError(ValueError):
    """A settings value is missing, repeated or contradictory."""


def _check_columns(name: str, columns: tuple[str, ...]) -> None:
    if not columns:
        raise SettingsError(f"{name} must not be empty")
    if any(not c.strip() for c in columns):
        raise SettingsError(f"{name} holds a blank column name")
    if len(set(columns)) != len(columns):
        raise SettingsError(f"{name} holds a repeated column name")


@dataclass(frozen=True)
class Settings:
    """One demand study. All fields are checked on construction."""

    id_columns: tuple[str, ...] = ID_COLUMNS
    calendar_columns: tuple[str, ...] = CALENDAR_COLUMNS
    price_columns: tuple[str, ...] = PRICE_COLUMNS
    panel_columns: tuple[str, ...] = PANEL_COLUMNS
    series_keys: tuple[str, ...] = SERIES_KEYS
    horizon: int = HORIZON
    training_cutoff: int = TRAINING_CUTOFF
    n_folds: int = N_FOLDS
    start_year: int = 2015
    end_year: int = 2016
    expected_rows: dict[str, int] = field(default_factory=lambda: dict(EXPECTED_ROWS))

    def __post_init__(self) -> None:
        for name in ("id_columns", "calendar_columns", "price_columns", "panel_columns"):
            _check_columns(name, getattr(self, name))
        absent = set(REQUIRED_PANEL_COLUMNS) - set(self.panel_columns)
        if absent:
            raise SettingsError(f"panel_columns lacks {sorted(absent)}")
        if set(self.series_keys) != set(SERIES_KEYS):
            raise SettingsError("series_keys must be item_id and store_id")
        if self.start_year >= self.end_year:
            raise SettingsError("start_year must be before end_year")
        for name in ("horizon", "training_cutoff", "n_folds", "start_year", "end_year"):
            if getattr(self, name) <= 0:
                raise SettingsError(f"{name} must be positive")
        if any(n <= 0 for n in self.expected_rows.values()):
            raise SettingsError("expected row counts must be positive")


def model_features(
    groups: dict[str, tuple[str, ...]] = FEATURE_GROUPS,
    *,
    exclude: tuple[str, ...] = EXCLUDED_FEATURES,
    drop_group: str | None = None,
) -> list[str]:
    """Flatten feature groups into a feature list, less single exclusions and one whole group."""
    return [
        name
        for group, names in groups.items()
        if group != drop_group
        for name in names
        if name not in exclude
    ]
