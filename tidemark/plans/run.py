"""The whole job: CSV in, result tables, predictions and models out.

    spark-submit -m tidemark.plans.run --input 's3a://bucket/2023/*.csv' --output s3a://bucket/out
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark import spec
from tidemark.plans.cleaning import prepare
from tidemark.plans.reports import report_tables, summary_document
from tidemark.plans.training import fit_run
from tidemark.sources.committed import commit_run
from tidemark.sources.csv_files import read_csv
from tidemark.sources.shared import shared_area
from tidemark.sources.sinks import save_models, write_json, write_predictions, write_report


def run(raw: DataFrame, output: str, config: spec.RunConfig) -> dict[str, DataFrame]:
    """Run everything on raw records; returns the report tables as written.

    The results become the current ones of ``output`` together, at the end; see
    ``committed_folder``. Intermediate tables are deleted.
    """
    spark = raw.sparkSession
    reports: dict[str, DataFrame] = {}

    def write(folder: str) -> dict[str, DataFrame]:
        prepared = prepare(raw, config)
        fitted = fit_run(prepared.featured, config)
        tables = report_tables(prepared, fitted, config)
        for name, table in tables.items():
            # A model without mistakes has no error sample; any other empty table is an error.
            may_be_empty = name == "error_analysis_sample"
            path = f"{folder}/tables/{name}"
            if write_report(table, path, may_be_empty, one_file=name != "feature_coefficients"):
                reader = spark.read.schema(table.schema).option("header", True)
                reports[name] = reader.csv(path)
            else:
                reports[name] = spark.createDataFrame([], table.schema)
        results = dict(reports)
        saved = {"requested": False, "saved": False, "error": None}
        if config.save_models:
            saved = save_models(fitted.preprocessor, fitted.model, f"{folder}/models")
        if config.export_predictions:
            write_predictions(fitted.predictions, f"{folder}/predictions")
            results["predictions"] = spark.read.parquet(f"{folder}/predictions")
        write_json(summary_document(tables, fitted, config, saved), f"{folder}/metrics")
        results["metrics"] = spark.read.text(f"{folder}/metrics")
        return results

    with shared_area(spark):
        commit_run(spark, output, write)
    return reports


def _numbers(text: str) -> tuple[float, ...]:
    return tuple(float(part) for part in text.split(",") if part.strip())


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    # Option names are fixed values.
    bounds, smoothing, grid = spec.SplitBounds(), spec.Smoothing(), spec.ModelGrid()
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    add = parser.add_argument
    day = dt.date.fromisoformat
    add("--input", nargs="+", required=True, help="CSV paths or globs")
    add("--output", required=True, help="folder for the results")
    add("--start-date", type=day, default=bounds.start)
    add("--train-end-date", type=day, default=bounds.train_end)
    add("--validation-end-date", type=day, default=bounds.validation_end)
    add("--test-end-date", type=day, default=bounds.test_end)
    add("--historical-prior-weight", type=float, default=smoothing.prior_weight)
    add("--historical-default-rate", type=float, default=smoothing.default_rate)
    add("--regularization-grid", type=_numbers, default=grid.reg_params)
    add("--threshold-grid", type=_numbers, default=grid.thresholds)
    add("--max-iterations", type=int, default=grid.max_iterations)
    add("--no-refit", action="store_true", help="keep the model fitted on the training period")
    add("--save-models", action="store_true")
    add("--export-test-predictions", action="store_true")
    return parser.parse_args(arguments)


def configure(options: argparse.Namespace) -> spec.RunConfig:
    return spec.RunConfig(
        bounds=spec.SplitBounds(
            options.start_date,
            options.train_end_date,
            options.validation_end_date,
            options.test_end_date,
        ),
        smoothing=spec.Smoothing(
            options.historical_prior_weight, options.historical_default_rate
        ),
        grid=spec.ModelGrid(
            options.regularization_grid, options.threshold_grid, options.max_iterations
        ),
        refit=not options.no_refit,
        save_models=options.save_models,
        export_predictions=options.export_test_predictions,
    )


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    config = configure(options)
    spark = (
        SparkSession.builder.appName("tidemark")
        .config("spark.sql.session.timeZone", "UTC")
        # The models of a grid are fitted at the same time and share the executors evenly.
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    run(read_csv(spark, options.input), options.output, config)


if __name__ == "__main__":
    main()
