import datetime as dt

import pytest

from tidemark import spec
from tidemark.plans.run import configure, parse


def test_defaults_are_valid():
    config = spec.RunConfig()
    assert config.bounds.test_end == dt.date(2025, 12, 31)
    assert config.grid.reg_params == (0.0, 0.001, 0.01, 0.1)
    assert config.grid.thresholds[0] == 0.2 and len(config.grid.thresholds) == 11


@pytest.mark.parametrize(
    "make",
    [
        lambda: spec.SplitBounds(start=dt.date(2025, 1, 1), train_end=dt.date(2024, 1, 1)),
        lambda: spec.SplitBounds(validation_end=dt.date(2024, 12, 31)),
        lambda: spec.SplitBounds(test_end=dt.date(2025, 6, 30)),
        lambda: spec.Smoothing(prior_weight=0),
        lambda: spec.Smoothing(default_rate=1.5),
        lambda: spec.ModelGrid(reg_params=()),
        lambda: spec.ModelGrid(reg_params=(-0.1,)),
        lambda: spec.ModelGrid(thresholds=()),
        lambda: spec.ModelGrid(thresholds=(0.0, 0.5)),
        lambda: spec.ModelGrid(thresholds=(1.0,)),
    ],
)
def test_bad_parameters_are_refused(make):
    with pytest.raises(ValueError):
        make()


def test_start_may_equal_the_end_of_training():
    day = dt.date(2024, 12, 31)
    assert spec.SplitBounds(start=day).start == day


def test_models_and_predictions_are_written_only_when_asked():
    base = ["--input", "a.csv", "--output", "out"]
    plain = configure(parse(base))
    assert not plain.save_models and not plain.export_predictions and plain.refit
    asked = configure(
        parse([*base, "--save-models", "--export-test-predictions", "--no-refit",
               "--threshold-grid", "0.3,0.4"])
    )
    assert asked.save_models and asked.export_predictions and not asked.refit
    assert asked.grid.thresholds == (0.3, 0.4)
