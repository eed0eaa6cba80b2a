"""Names, value lists and run parameters shared by the operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- Fixed values: logical fields and the source headers accepted for each, best first. ---
FIELD_HEADERS: dict[str, tuple[str, ...]] = {
    "flight_date_raw": ("FlightDate", "FL_DATE"),
    "carrier": ("Reporting_Airline", "UniqueCarrier", "OP_UNIQUE_CARRIER"),
    "flight_number": ("Flight_Number_Reporting_Airline", "FlightNum", "OP_CARRIER_FL_NUM"),
    "origin": ("Origin",),
    "dest": ("Dest", "Destination"),
    "crs_dep_time_raw": ("CRSDepTime", "CRS_DEP_TIME"),
    "crs_arr_time_raw": ("CRSArrTime", "CRS_ARR_TIME"),
    "crs_elapsed_time_raw": ("CRSElapsedTime", "CRS_ELAPSED_TIME"),
    "distance_raw": ("Distance",),
    "arr_delay_raw": ("ArrDelay", "ARR_DELAY"),
    "cancelled_raw": ("Cancelled", "CANCELED"),
    "diverted_raw": ("Diverted",),
}

# --- Fixed values: accepted date formats, tried in this order. ---
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyyMMdd")

# --- Fixed values: outcomes of the cleaning ladder, in order of precedence. ---
INVALID_FLIGHT_DATE = "INVALID_FLIGHT_DATE"
OUTSIDE_PROJECT_DATE_RANGE = "OUTSIDE_PROJECT_DATE_RANGE"
CANCELLED = "CANCELLED"
DIVERTED = "DIVERTED"
MISSING_IDENTIFIER = "MISSING_IDENTIFIER"
INVALID_SCHEDULED_TIME = "INVALID_SCHEDULED_TIME"
INVALID_SCHEDULED_DURATION = "INVALID_SCHEDULED_DURATION"
INVALID_DISTANCE = "INVALID_DISTANCE"
MISSING_ARRIVAL_DELAY = "MISSING_ARRIVAL_DELAY"
MISSING_STATUS_FLAG = "MISSING_STATUS_FLAG"
ACCEPTED = "ACCEPTED"

# --- Fixed value: from this many minutes on an arrival is late. ---
LATE_MINUTES = 15.0

# --- Fixed values: what makes two accepted rows the same flight, and the fields that rank copies of one flight:
# the copy with the least values survives. ---
IDENTITY = ("flight_date", "carrier", "flight_number", "origin", "dest", "crs_dep_time")
COPY_ORDER = ("arr_delay", "crs_arr_time", "crs_elapsed_time", "distance")

# --- Fixed values: columns of the accepted table. ---
ACCEPTED_COLUMNS = (
    "flight_key",
    "flight_date",
    "carrier",
    "flight_number",
    "origin",
    "dest",
    "route",
    "crs_dep_time",
    "crs_arr_time",
    "crs_dep_minutes",
    "crs_arr_minutes",
    "crs_elapsed_time",
    "distance",
    "month",
    "day_of_week",
    "arr_delay",
    "label",
)

# --- Fixed values: entities with a history, and the model's input columns. ---
ENTITIES = ("carrier", "route", "origin", "dest")
CATEGORICAL_FEATURES = ("carrier", "origin", "dest", "route", "day_of_week_cat", "month_cat")
NUMERIC_FEATURES = (
    "crs_elapsed_time",
    "distance",
    "sched_dep_time_sin",
    "sched_dep_time_cos",
    "sched_arr_time_sin",
    "sched_arr_time_cos",
    "hist_carrier_delay_rate",
    "hist_route_delay_rate",
    "hist_origin_delay_rate",
    "hist_dest_delay_rate",
)

# --- Fixed values: columns of exported predictions. ---
PREDICTION_COLUMNS = (
    "flight_key",
    "flight_date",
    "carrier",
    "flight_number",
    "origin",
    "dest",
    "crs_dep_time",
    "crs_arr_time",
    "label",
    "probability_score",
    "prediction",
)

# --- Fixed values: split and class names used in the reports. ---
SPLITS = ("train", "validation", "test")
CLASS_NAMES = ("on_time_or_under_15_minutes_late", "at_least_15_minutes_late")

MINUTES_PER_DAY = 1440.0


@dataclass(frozen=True)
class SplitBounds:
    """Last days of the three chronological splits; every bound is inclusive."""

    # Fixed values.
    start: dt.date = dt.date(2023, 1, 1)
    train_end: dt.date = dt.date(2024, 12, 31)
    validation_end: dt.date = dt.date(2025, 6, 30)
    test_end: dt.date = dt.date(2025, 12, 31)

    def __post_init__(self) -> None:
        if self.start > self.train_end:
            raise ValueError(f"start {self.start} lies after the end of training {self.train_end}")
        if not self.train_end < self.validation_end < self.test_end:
            raise ValueError(
                "split ends must rise strictly: "
                f"{self.train_end}, {self.validation_end}, {self.test_end}"
            )


@dataclass(frozen=True)
class Smoothing:
    """Weight of the global rate in a smoothed entity rate, and the rate before any outcome."""

    # Fixed values.
    prior_weight: float = 20.0
    default_rate: float = 0.20

    def __post_init__(self) -> None:
        if not self.prior_weight > 0:
            raise ValueError(f"prior weight must be positive, got {self.prior_weight}")
        if not 0 <= self.default_rate <= 1:
            raise ValueError(f"default rate must lie in [0, 1], got {self.default_rate}")


@dataclass(frozen=True)
class ModelGrid:
    """L2 penalties and decision thresholds to try, and the solver's iteration limit."""

    # Fixed values.
    reg_params: tuple[float, ...] = (0.0, 0.001, 0.01, 0.1)
    thresholds: tuple[float, ...] = (
        0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70,
    )
    max_iterations: int = 100

    def __post_init__(self) -> None:
        if not self.reg_params or min(self.reg_params) < 0:
            raise ValueError(f"need one or more penalties, none negative: {self.reg_params}")
        if not self.thresholds or not all(0 < t < 1 for t in self.thresholds):
            raise ValueError(f"need one or more thresholds inside (0, 1): {self.thresholds}")


@dataclass(frozen=True)
class RunConfig:
    """Everything a full run needs besides its input."""

    bounds: SplitBounds = field(default_factory=SplitBounds)
    smoothing: Smoothing = field(default_factory=Smoothing)
    grid: ModelGrid = field(default_factory=ModelGrid)
    refit: bool = True
    save_models: bool = False
    export_predictions: bool = False
