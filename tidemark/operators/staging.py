"""Typing raw text fields and tagging every row with exactly one outcome."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions.clock import is_hhmm
from tidemark.functions.parsing import code_text, first_date, is_blank, real_number, trimmed
from tidemark.functions.parsing import whole_number
from tidemark.operators.headers import resolve_fields


class Rule(NamedTuple):
    outcome: str
    applies: Column


def first_outcome(rules: Sequence[Rule], otherwise: str) -> Column:
    """The outcome of the first rule that applies; a rule that is null does not apply."""
    ladder = F
    for rule in rules:
        ladder = ladder.when(rule.applies, F.lit(rule.outcome))
    return ladder.otherwise(F.lit(otherwise))


def type_fields(raw: DataFrame) -> DataFrame:
    """Typed columns beside the raw text they came from; no row is dropped."""
    text = resolve_fields(raw)
    typed = {
        "flight_date": first_date("flight_date_raw", spec.DATE_FORMATS),
        "carrier": code_text("carrier"),
        "flight_number": trimmed("flight_number"),
        "origin": code_text("origin"),
        "dest": code_text("dest"),
        "crs_dep_time": whole_number("crs_dep_time_raw"),
        "crs_arr_time": whole_number("crs_arr_time_raw"),
        "crs_elapsed_time": real_number("crs_elapsed_time_raw"),
        "distance": real_number("distance_raw"),
        "arr_delay": real_number("arr_delay_raw"),
        "cancelled": real_number("cancelled_raw"),
        "diverted": real_number("diverted_raw"),
    }
    return text.withColumns(typed)


def rejection_rules(bounds: spec.SplitBounds) -> list[Rule]:
    """The ladder, in order of precedence."""
    c = F.col
    blank_identifier = F.lit(False)
    for name in ("carrier", "flight_number", "origin", "dest"):
        blank_identifier = blank_identifier | is_blank(c(name))
    return [
        Rule(spec.INVALID_FLIGHT_DATE, c("flight_date").isNull()),
        Rule(
            spec.OUTSIDE_PROJECT_DATE_RANGE,
            ~c("flight_date").between(F.lit(bounds.start), F.lit(bounds.test_end)),
        ),
        Rule(spec.CANCELLED, c("cancelled") == 1.0),
        Rule(spec.DIVERTED, c("diverted") == 1.0),
        Rule(spec.MISSING_IDENTIFIER, blank_identifier),
        Rule(
            spec.INVALID_SCHEDULED_TIME, ~(is_hhmm(c("crs_dep_time")) & is_hhmm(c("crs_arr_time")))
        ),
        Rule(spec.INVALID_SCHEDULED_DURATION, ~F.coalesce(c("crs_elapsed_time") > 0, F.lit(False))),
        Rule(spec.INVALID_DISTANCE, ~F.coalesce(c("distance") > 0, F.lit(False))),
        Rule(spec.MISSING_ARRIVAL_DELAY, c("arr_delay").isNull()),
        Rule(spec.MISSING_STATUS_FLAG, c("cancelled").isNull() | c("diverted").isNull()),
    ]


def stage(raw: DataFrame, bounds: spec.SplitBounds) -> DataFrame:
    """Typed rows, each with one ``rejection_reason``."""
    reason = first_outcome(rejection_rules(bounds), otherwise=spec.ACCEPTED)
    return type_fields(raw).withColumn("rejection_reason", reason)
