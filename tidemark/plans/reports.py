"""The result tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.baseline import compare, constant_baseline, majority_class
from tidemark.operators.errors import top_errors
from tidemark.operators.logistic import iterations
from tidemark.operators.ranking import roc_auc
from tidemark.operators.selection import best_per_group
from tidemark.operators.splits import (
    add_split,
    class_distribution,
    entity_coverage,
    split_frames,
    split_summary,
)
from tidemark.operators.sweep import (
    add_ratios,
    confusion_matrix,
    even_grid,
    precision_recall_points,
    roc_points,
    threshold_counts,
    threshold_metrics,
)
from tidemark.plans.cleaning import Prepared
from tidemark.plans.training import Fitted
from tidemark.sources.shared import save_shared

CURVE_POINTS = 101
TOP_COEFFICIENTS = 20


def baselines(featured: DataFrame, config: spec.RunConfig) -> tuple[DataFrame, DataFrame]:
    """Majority class of what the model was fitted on, judged on validation and on test."""
    frames = split_frames(featured.select("flight_date", "label"), config.bounds)
    train, validation, test = (frames[name] for name in spec.SPLITS)
    fitted_on = train.unionByName(validation) if config.refit else train
    return (
        constant_baseline(validation, majority_class(train).scalar()),
        constant_baseline(test, majority_class(fitted_on).scalar()),
    )


def report_tables(
    prepared: Prepared, fitted: Fitted, config: spec.RunConfig
) -> dict[str, DataFrame]:
    """Report name to table. None of them grows with the input, save for the top errors' limit."""
    best = fitted.best
    spark = prepared.featured.sparkSession
    settings = {
        "reg_param": F.lit(best["reg_param"]),
        "elastic_net_param": F.lit(0.0),
        "threshold": F.lit(best["threshold"]),
    }
    # Summary and coverage come from the histories: day totals with their row counts.
    daily = add_split(prepared.histories.daily, config.bounds)
    summary = save_shared(split_summary(daily, label="positives", weight="rows"), "summary")
    metrics = save_shared(
        threshold_metrics(fitted.predictions, [best["threshold"]])
        .drop("position")
        .withColumns({**settings, "roc_auc": roc_auc(fitted.predictions).scalar()}),
        "metrics",
    )
    curve = save_shared(
        add_ratios(threshold_counts(fitted.predictions, even_grid(CURVE_POINTS))), "curve"
    )
    validation_baseline, test_baseline = baselines(prepared.featured, config)
    selected = spark.createDataFrame([best], fitted.grid.withColumn(
        "threshold_at_grid_edge", F.lit(True)).schema)
    # The names of the tables are fixed values.
    test_rate = summary.filter("split = 'test'").select("delay_rate")
    return {
        "data_quality_summary": prepared.quality.orderBy("stage", "reason"),
        "split_summary": summary,
        "class_distribution": class_distribution(summary),
        "historical_feature_coverage": entity_coverage(prepared.histories, config.bounds),
        "model_selection_validation": fitted.grid.orderBy("position"),
        "model_selection_best": best_per_group(fitted.grid).orderBy("reg_param"),
        "selected_validation_metrics": compare(
            selected.drop("position"), validation_baseline, "validation"
        ),
        "final_test_metrics": compare(metrics, test_baseline, "test"),
        "final_test_confusion_matrix": confusion_matrix(metrics, spec.CLASS_NAMES),
        "feature_coefficients": fitted.coefficients,
        "top_feature_coefficients": fitted.coefficients.limit(TOP_COEFFICIENTS),
        "roc_curve": roc_points(curve),
        "precision_recall_curve": precision_recall_points(curve).withColumn(
            "prevalence", test_rate.scalar()
        ),
        "error_analysis_sample": top_errors(fitted.predictions),
    }


def summary_document(
    tables: dict[str, DataFrame], fitted: Fitted, config: spec.RunConfig, saved: dict[str, object]
) -> DataFrame:
    """One row: the run's settings, the chosen model and the headline metrics."""
    bounds, best = config.bounds, fitted.best

    def rows(name: str):
        table = tables[name]
        return table.agg(F.collect_list(F.struct(*table.columns))).scalar()

    period = {
        "start_date": bounds.start,
        "train_end_date": bounds.train_end,
        "validation_end_date": bounds.validation_end,
        "test_end_date": bounds.test_end,
    }
    chosen = {
        "type": "PySpark logistic regression",
        "reg_param": best["reg_param"],
        "elastic_net_param": 0.0,
        "classification_threshold": best["threshold"],
        "threshold_at_grid_edge": best["threshold_at_grid_edge"],
        "max_iterations": config.grid.max_iterations,
        "refit_on_train_plus_validation": config.refit,
        "intercept": float(fitted.model.intercept),
        "iterations_completed": iterations(fitted.model),
    }

    def literal(values: dict[str, object]):
        return F.struct(*[F.lit(value).alias(name) for name, value in values.items()])

    serialization = F.struct(
        F.lit(saved["requested"]).alias("requested"),
        F.lit(saved["saved"]).alias("saved"),
        F.lit(saved["error"]).cast("string").alias("error"),
    )
    return fitted.predictions.sparkSession.range(1).select(
        F.lit(spec.LATE_MINUTES).alias("late_minutes"),
        literal(period).alias("data_period"),
        literal(chosen).alias("selected_model"),
        serialization.alias("serialization"),
        rows("selected_validation_metrics").alias("validation"),
        rows("final_test_metrics").alias("test"),
        rows("split_summary").alias("split_summary"),
    )
