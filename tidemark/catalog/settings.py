"""Parameters that the registered queries and their SQL twins share."""

from __future__ import annotations

# Prior weights whose route rates stand in for a grid of models.
PRIOR_WEIGHTS = (5.0, 20.0, 80.0)

# The decision threshold of the single-threshold queries: near the positive share of the data, so
# that all four outcomes occur.
TEST_THRESHOLD = 0.225

CURVE_POINTS = 101
TOP_ERRORS = 100

# Given coefficients for the fixed-coefficient score.
FIXED_INTERCEPT = -1.5
FIXED_WEIGHTS = {
    "distance": 0.0002,
    "sched_dep_time_sin": -0.2,
    "sched_dep_time_cos": 0.1,
    "hist_carrier_delay_rate": 1.5,
    "hist_route_delay_rate": 0.5,
}
