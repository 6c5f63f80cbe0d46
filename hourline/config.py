"""Constants of the domain and the options every operator takes as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# They decide results and must not change.
TIMEZONE = "Europe/Budapest"
EPOCH_DAY = "2015-01-01"
LAG_HOURS = (24, 48, 168)
HORIZONS = (24, 168)
MIN_TRAINING_ROWS = 720
NULL_RATE_WARNING = 0.1
FEATURE_NULL_WARNING = 0.5
FILL_LIMIT = 3
CENTERED_ROWS = 72
DRIFT_SHARE = 0.15
COLUMN_DRIFT_THRESHOLD = 0.15
DRIFT_CONSECUTIVE = 3
DRIFT_MIN_ROWS = 100
CURRENT_WINDOW_DAYS = 7
REFERENCE_WINDOW_DAYS = 30
MAE_DEGRADATION = 1.20
MIN_ACTUALS = 24
COOLDOWN_HOURS = 24
PROMOTION_GAIN = 0.01
CV_FOLDS, CV_GAP, CV_TEST = 3, 168, 120
VAL_DAYS, TEST_DAYS = 5, 5
TARGET_MAPE = 5.0
TUNING_TRIALS = 25
MAX_RANGE_DAYS = 7
REBUILD_CHUNK_DAYS = 30

# Fixed values: (month, day) of the public holidays that keep their date.
FIXED_HOLIDAYS = (
    (1, 1), (3, 15), (5, 1), (8, 20), (10, 23), (11, 1), (12, 25), (12, 26),
)
# Days counted from Easter Sunday, with the first year they applied.
EASTER_HOLIDAYS = ((-2, 2017), (0, 1), (1, 1), (49, 1), (50, 1))

# The columns a model is trained on.
MODEL_FEATURES = (
    "temperature", "lag_24h", "lag_48h", "lag_168h",
    "rolling_7d_mean", "rolling_7d_std", "rolling_24h_mean",
    "hour_of_day", "day_of_week", "month", "is_weekend", "is_holiday",
    "humidity", "cloud_cover",
)
# Every column the feature matrix adds for modelling.
FEATURE_COLUMNS = (
    "hour_of_day", "day_of_week", "month", "quarter",
    "is_weekend", "is_holiday", "is_holiday_eve", "days_since_epoch",
    "lag_24h", "lag_48h", "lag_168h",
    "rolling_7d_mean", "rolling_7d_std", "rolling_24h_mean",
    "temperature", "temperature_lag_24h", "humidity", "cloud_cover",
)
WEATHER_COLUMNS = ("temperature", "humidity", "cloud_cover")


@dataclass(frozen=True)
class Rolling:
    """One trailing statistic: `name` = `stat` of the last `rows` rows once `min_rows` are known."""

    name: str
    stat: str
    rows: int
    min_rows: int


# The trailing statistics of the feature matrix.
ROLLING = (
    Rolling("rolling_7d_mean", "mean", 168, 72),
    Rolling("rolling_7d_std", "std", 168, 72),
    Rolling("rolling_24h_mean", "mean", 24, 12),
)


@dataclass(frozen=True)
class FeatureOptions:
    """Choices of the feature matrix; the defaults are the documented behaviour."""

    timezone: str = TIMEZONE
    lag_hours: tuple[int, ...] = LAG_HOURS
    rolling: tuple[Rolling, ...] = field(default=ROLLING)
    min_rows: int = MIN_TRAINING_ROWS
    eve_mode: str = "row"
    temperature_lag_time_exact: bool = False
    rows_per_slice: int = 4096
