"""One named query per operator, over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import spec
from tidemark.catalog import bindings as bind
from tidemark.catalog.settings import (
    CURVE_POINTS,
    FIXED_INTERCEPT,
    FIXED_WEIGHTS,
    PRIOR_WEIGHTS,
    TEST_THRESHOLD,
    TOP_ERRORS,
)
from tidemark.operators.accepted import surrogate_key as key_of
from tidemark.operators.baseline import compare, constant_baseline, majority_class
from tidemark.operators.errors import top_errors
from tidemark.operators.features import add_cycle, add_schedule_features
from tidemark.operators.headers import resolve_fields
from tidemark.operators.history import (
    attach_history,
    day_totals,
    global_prior,
    histories,
    history_columns,
    history_table,
    prior_totals,
    prior_totals_by_range,
    prior_totals_of_rows,
    smoothed_rate,
)
from tidemark.operators.logistic import (
    DIRECTIONS,
    fit_logistic,
    fixed_score,
    score_rows,
    scored_grid_metrics,
)
from tidemark.operators.optimality import explained_score, is_flat
from tidemark.operators.preprocess import (
    SCALED,
    category_stages,
    fit_preprocessor,
    median_imputer,
    number_stages,
)
from tidemark.operators.quality import quality_report, reason_counts
from tidemark.operators.ranking import binned_roc_auc, roc_auc
from tidemark.operators.selection import best_per_group, select_best
from tidemark.operators.slots import attach_slots, exact_medians, saved_slots
from tidemark.operators.splits import (
    add_split,
    class_distribution,
    entity_coverage,
    split_frames,
    split_summary,
)
from tidemark.operators.staging import stage, type_fields
from tidemark.operators.sweep import (
    apply_threshold,
    confusion_matrix,
    even_grid,
    precision_recall_points,
    roc_points,
    threshold_metrics,
)
from tidemark.plans.reports import TOP_COEFFICIENTS
from tidemark.plans.training import fit_run
from tidemark.sources.csv_files import (
    file_manifest,
    header_check,
    narrow,
    read_csv,
    write_raw_csv,
)
from tidemark.sources.months import month_coverage
from tidemark.sources.shared import save_shared, shared_folder
from tidemark.sources.sinks import (
    load_models,
    save_models,
    write_json,
    write_predictions,
    write_report,
)

Query = Callable[[SparkSession, str], DataFrame]
THRESHOLDS = spec.ModelGrid().thresholds
COUNTS = ("true_positive", "false_positive", "true_negative", "false_negative")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so that two engines can be compared."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(f"`{name}`"), digits) for name in doubles})


# --- cleaning ---


def resolve_columns(spark, sf_dir):
    return resolve_fields(bind.flights_raw(spark, sf_dir))


def stage_types(spark, sf_dir):
    return type_fields(bind.flights_raw(spark, sf_dir)).select(
        "flight_date", "carrier", "flight_number", "origin", "dest", "crs_dep_time",
        "crs_arr_time", "crs_elapsed_time", "distance", "arr_delay", "cancelled", "diverted",
    )


def reject_reasons(spark, sf_dir):
    return reason_counts(bind.staged(spark, sf_dir))


def quality(spark, sf_dir):
    return quality_report(bind.staged(spark, sf_dir))


def accepted(spark, sf_dir):
    return bind.accepted(spark, sf_dir)


def surrogate_key(spark, sf_dir):
    return bind.accepted(spark, sf_dir).select("flight_key", *spec.IDENTITY)


# --- files ---


def _saved_raw(spark, sf_dir) -> DataFrame:
    """The raw records, joined once for all the CSV files made of them."""
    return save_shared(bind.flights_raw(spark, sf_dir), "raw")


def _csv_folder(spark, raw: DataFrame) -> str:
    """Two folders of CSV files under different headers and column orders."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    odd = F.col("Flight_Number_Reporting_Airline") % 2 == 1
    write_raw_csv(raw.filter(odd), f"{folder}/new")
    old_names = {header: aliases[-1] for aliases in spec.FIELD_HEADERS.values()
                 for header in aliases[:1]}
    old = raw.filter(~odd).withColumnsRenamed(old_names)
    write_raw_csv(old.select(*reversed(old.columns)), f"{folder}/old")
    return folder


def csv_scan(spark, sf_dir):
    """Files of different layouts below one path, read as one table."""
    return resolve_fields(read_csv(spark, [f"{_csv_folder(spark, _saved_raw(spark, sf_dir))}/*"]))


def narrow_source(spark, sf_dir):
    """A wide source cut down to the twelve fields and kept as Parquet."""
    wide = bind.flights_raw(spark, sf_dir).withColumns(
        {"Tail_Number": F.col("Origin"), "Taxi Out (min)": F.lit("12")}
    )
    return resolve_fields(save_shared(narrow(wide), "narrow"))


def _folder_name() -> F.Column:
    return F.regexp_extract("path", "/([a-z]+)/[^/]*$", 1).alias("folder")


def _rows_by_file(spark, folder: str) -> DataFrame:
    """Rows below the header line of every CSV file that has one."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text([f"{folder}/*"])
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path")
    return lines.groupBy(path).agg((F.count("*") - 1).alias("row_count"))


def checked_headers(spark, sf_dir):
    """Per folder, the rows of its files by what their headers lack."""
    raw = _saved_raw(spark, sf_dir)
    folder = _csv_folder(spark, raw)
    write_raw_csv(raw.drop("Distance"), f"{folder}/short")
    found = header_check(spark, [f"{folder}/*"]).join(_rows_by_file(spark, folder), "path")
    missing = F.coalesce(F.get("missing", F.lit(0)), F.lit("")).alias("first_missing")
    return found.groupBy(
        _folder_name(), "column_count", F.size("missing").alias("n_missing"), missing
    ).agg(F.sum("row_count").alias("row_count"))


def manifest(spark, sf_dir):
    """Per folder, the rows of the files listed, and whether each file that holds rows is listed
    once, with as many bytes as a reader finds lines for at least."""
    folder = _csv_folder(spark, _saved_raw(spark, sf_dir))
    listed = file_manifest(spark, [f"{folder}/*"])
    both = _rows_by_file(spark, folder).join(listed, "path", "left")
    return both.groupBy(_folder_name(), "column_count").agg(
        F.sum("row_count").alias("row_count"),
        (F.count_distinct("path") == F.count("bytes")).alias("listed_once"),
        F.min(F.col("bytes") > F.col("row_count") * F.col("column_count")).alias("filled"),
    )


def prediction_sink(spark, sf_dir):
    path = f"{shared_folder(spark)}/predictions-{uuid.uuid4().hex}"
    write_predictions(apply_threshold(test_rows(spark, sf_dir), TEST_THRESHOLD), path)
    return rounded(spark.read.parquet(path))


def months(spark, sf_dir):
    end = dt.date(bind.BOUNDS.test_end.year, 12, 31)
    return month_coverage(bind.accepted(spark, sf_dir), bind.BOUNDS.start, end)


# --- history ---


def daily_totals(spark, sf_dir):
    return day_totals(bind.accepted(spark, sf_dir), [])


def prior(spark, sf_dir):
    daily = save_shared(day_totals(bind.accepted(spark, sf_dir), []), "daily")
    return rounded(global_prior(daily, 0.2))


def entity_daily(spark, sf_dir):
    """Every entity's day totals."""
    rows = bind.saved_accepted(spark, sf_dir)
    parts = [
        day_totals(rows, [name]).select(
            F.lit(name).alias("entity"), F.col(name).alias("key"),
            "flight_date", "positives", "rows",
        )
        for name in spec.ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


def entity_history(name: str) -> Query:
    def query(spark, sf_dir):
        totals = save_shared(day_totals(bind.accepted(spark, sf_dir), [name]), "day-totals")
        return rounded(history_table(totals, name))

    return query


def history_range_frame(spark, sf_dir):
    totals = day_totals(bind.accepted(spark, sf_dir), ["route"])
    return prior_totals_by_range(totals, ["route"], "route")


def history_range_rows(spark, sf_dir):
    """The strictly earlier frame over the accepted rows themselves."""
    rows = bind.saved_accepted(spark, sf_dir).select("flight_key", "route", "flight_date", "label")
    found = prior_totals_of_rows(rows, ["route"], "route", save=save_shared)
    return found.drop("label")


def smoothed_rates(spark, sf_dir):
    rows = bind.with_history(bind.saved_accepted(spark, sf_dir))
    return rounded(rows.select("flight_key", *history_columns()))


# --- features and splits ---

WAVES = tuple(f"sched_{t}_time_{w}" for t in ("dep", "arr") for w in ("sin", "cos"))


def cyclical_time(spark, sf_dir):
    rows = add_schedule_features(bind.accepted(spark, sf_dir))
    return rounded(rows.select("flight_key", "crs_dep_minutes", "crs_arr_minutes", *WAVES))


def calendar_fields(spark, sf_dir):
    rows = add_schedule_features(bind.accepted(spark, sf_dir))
    return rows.select("flight_key", "month", "day_of_week", "month_cat", "day_of_week_cat")


def featured(spark, sf_dir):
    return rounded(
        bind.featured(spark, sf_dir).select(
            "flight_key", "flight_date", "carrier", "origin", "dest", "route",
            "crs_elapsed_time", "distance", "day_of_week_cat", "month_cat", "label", "split",
            *history_columns(), *WAVES,
        )
    )


def split_rows(spark, sf_dir):
    return add_split(bind.accepted(spark, sf_dir), bind.BOUNDS)


def chrono_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("flight_key", "flight_date", "split")


def summary(spark, sf_dir):
    return rounded(split_summary(split_rows(spark, sf_dir)))


def classes(spark, sf_dir):
    return rounded(class_distribution(split_summary(split_rows(spark, sf_dir))))


def coverage(spark, sf_dir):
    found = bind.saved_histories(bind.saved_accepted(spark, sf_dir))
    return rounded(entity_coverage(found, bind.BOUNDS))


def refit_union(spark, sf_dir):
    frames = split_frames(split_rows(spark, sf_dir), bind.BOUNDS)
    both = frames["train"].unionByName(frames["validation"])
    return both.select("flight_key", "flight_date", "label", "split")


# --- evaluation ---


def test_rows(spark, sf_dir):
    return bind.scored(spark, sf_dir).filter("split = 'test'")


def threshold_sweep(spark, sf_dir):
    return rounded(threshold_metrics(test_rows(spark, sf_dir), THRESHOLDS))


def evaluate(scored: DataFrame) -> DataFrame:
    """Metrics at one threshold with the area beside them, both from one written table."""
    scored = save_shared(scored.select("label", "probability_score"), "scored")
    metrics = threshold_metrics(scored, [TEST_THRESHOLD]).drop("position")
    return metrics.withColumn("roc_auc", roc_auc(scored).scalar())


def threshold_eval(spark, sf_dir):
    return rounded(evaluate(test_rows(spark, sf_dir)))


def thresholded(spark, sf_dir):
    rows = apply_threshold(test_rows(spark, sf_dir), TEST_THRESHOLD)
    return rounded(rows.select("flight_key", "label", "probability_score", "prediction"))


def roc_auc_exact(spark, sf_dir):
    return rounded(roc_auc(test_rows(spark, sf_dir)))


def roc_auc_binned(spark, sf_dir):
    """The evaluator's area over a curve of about a thousand points, for every split."""
    return rounded(binned_roc_auc(bind.scored(spark, sf_dir), by=["split"]))


def roc_curve(spark, sf_dir):
    metrics = threshold_metrics(test_rows(spark, sf_dir), even_grid(CURVE_POINTS))
    return rounded(roc_points(metrics))


def pr_curve(spark, sf_dir):
    rows = save_shared(
        test_rows(spark, sf_dir).select("label", "probability_score"), "scored"
    )
    points = precision_recall_points(threshold_metrics(rows, even_grid(CURVE_POINTS)))
    return rounded(points.withColumn("prevalence", rows.agg(F.avg("label")).scalar()))


def majority(spark, sf_dir):
    return majority_class(split_rows(spark, sf_dir).filter("split = 'train'"))


def baseline(rows: DataFrame) -> DataFrame:
    frames = split_frames(rows, bind.BOUNDS)
    return constant_baseline(frames["test"], majority_class(frames["train"]).scalar())


def baseline_metrics(spark, sf_dir):
    return rounded(baseline(bind.saved_accepted(spark, sf_dir)))


def confusion(spark, sf_dir):
    metrics = threshold_metrics(test_rows(spark, sf_dir), [TEST_THRESHOLD])
    return confusion_matrix(metrics, spec.CLASS_NAMES)


def metric_comparison(spark, sf_dir):
    rows = bind.saved_accepted(spark, sf_dir)
    joined = bind.with_history(rows, ["route"]).filter("split = 'test'")
    scored = joined.withColumn("probability_score", F.col("hist_route_delay_rate"))
    return rounded(compare(evaluate(scored), baseline(rows), "test"))


def weighted_grid(spark, sf_dir):
    """A validation grid of three prior weights times the default thresholds."""
    accepted = bind.saved_accepted(spark, sf_dir)
    rows = split_frames(accepted, bind.BOUNDS)["validation"]
    totals = save_shared(day_totals(accepted, ["route"]), "day-totals")
    rates = F.array(
        *[
            F.struct(
                F.lit(weight).alias("reg_param"),
                smoothed_rate("route", weight, "hist_global_delay_rate").alias(
                    "probability_score"
                ),
            )
            for weight in PRIOR_WEIGHTS
        ]
    )
    lookup = (
        totals.join(global_prior(totals, 0.2), "flight_date", "left")
        .join(prior_totals(totals, ["route"], "route"), ["route", "flight_date"], "left")
        .select("route", "flight_date", rates.alias("rates"))
    )
    scored = save_shared(
        rows.join(lookup, ["route", "flight_date"], "left").select("label", F.inline("rates")),
        "grid",
    )
    return rounded(scored_grid_metrics(scored, PRIOR_WEIGHTS, THRESHOLDS))


def best_by_group(spark, sf_dir):
    return best_per_group(weighted_grid(spark, sf_dir))


def best_row(spark, sf_dir):
    return select_best(weighted_grid(spark, sf_dir), THRESHOLDS)


def errors(spark, sf_dir):
    predicted = apply_threshold(test_rows(spark, sf_dir), TEST_THRESHOLD)
    return rounded(top_errors(predicted, TOP_ERRORS))


# --- preprocessing and models ---


MODEL_COLUMNS = ("label", *spec.CATEGORICAL_FEATURES, *spec.NUMERIC_FEATURES)


def _featured(
    spark, sf_dir, columns=(*spec.IDENTITY, "crs_arr_time", *MODEL_COLUMNS)
) -> DataFrame:
    """The columns named, written by split. The key, which is longer than all it is made of, is
    derived when it is read."""
    rows = bind.featured(spark, sf_dir).select(*dict.fromkeys(columns), "split")
    saved = save_shared(rows, "featured", by=["split"])
    if set(spec.IDENTITY) <= set(columns):
        return saved.withColumn("flight_key", key_of(spec.IDENTITY))
    return saved


def _scheduled(spark, sf_dir) -> DataFrame:
    """Accepted rows with their schedule features and split: all that the categories need."""
    rows = add_schedule_features(bind.saved_accepted(spark, sf_dir))
    return add_split(rows, bind.BOUNDS)


def _with_unseen(rows: DataFrame) -> DataFrame:
    """Test rows get category values that training has not seen."""
    test = F.col("split") == "test"
    return rows.withColumns(
        {
            name: F.when(test, F.concat(F.col(name), F.lit("?"))).otherwise(F.col(name))
            for name in spec.CATEGORICAL_FEATURES
        }
    )


def _per_category(columns: Callable[[str], list]) -> F.Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("feature"), F.col(name).alias("value"), *columns(name))
                for name in spec.CATEGORICAL_FEATURES
            ]
        )
    )


def _encoded_values(spark, sf_dir, stages: list) -> DataFrame:
    """Every distinct category value of all rows with its count, through stages fitted on training.

    A value stands in its own feature's column; the other columns are null.
    """
    rows = _scheduled(spark, sf_dir)
    fitted = Pipeline(stages=stages).fit(rows.filter("split = 'train'"))
    values = _with_unseen(rows).select(_per_category(lambda name: []))
    counted = values.groupBy("feature", "value").agg(F.count("*").alias("row_count"))
    alone = {
        name: F.when(F.col("feature") == name, F.col("value"))
        for name in spec.CATEGORICAL_FEATURES
    }
    return fitted.transform(counted.withColumns(alone))


def _own(columns: str) -> F.Column:
    """Of one column per category, that of the row's own feature."""
    return F.coalesce(
        *[
            F.when(F.col("feature") == name, F.col(columns.format(name)))
            for name in spec.CATEGORICAL_FEATURES
        ]
    )


def label_index(spark, sf_dir):
    rows = _encoded_values(spark, sf_dir, category_stages()[:1])
    return rows.select("feature", "value", _own("{}__index").alias("slot"), "row_count")


def one_hot_slots(spark, sf_dir):
    rows = _encoded_values(spark, sf_dir, category_stages())
    dense = {f"{name}__dense": vector_to_array(f"{name}__one_hot")
             for name in spec.CATEGORICAL_FEATURES}
    hot = rows.withColumns(dense).withColumn("hot", _own("{}__dense"))
    return hot.select(
        "feature", "value",
        (F.array_position("hot", 1.0) - 1).cast("int").alias("slot"),
        F.size("hot").alias("width"),
        "row_count",
    )


def ranked_slots(spark, sf_dir):
    """The slots of ``label_index`` from a table of ranks, joined to all rows."""
    rows = _scheduled(spark, sf_dir)
    slots = saved_slots(rows.filter("split = 'train'"))
    indexed = attach_slots(_with_unseen(rows), slots)
    pairs = indexed.select(_per_category(lambda name: [F.col(f"{name}__index").alias("slot")]))
    return pairs.groupBy("feature", "value", "slot").agg(F.count("*").alias("row_count"))


def _with_gaps(spark, sf_dir, columns) -> tuple[DataFrame, DataFrame]:
    """The training rows, and all rows; test rows of odd days of the month lose every number."""
    rows = _featured(spark, sf_dir, (*columns, *spec.NUMERIC_FEATURES))
    odd = (F.col("split") == "test") & (F.dayofmonth("flight_date") % 2 == 1)
    gaps = {name: F.when(~odd, F.col(name)) for name in spec.NUMERIC_FEATURES}
    return rows.filter("split = 'train'"), rows.withColumns(gaps)


def median_impute(spark, sf_dir):
    """Per number: what fills the missing ones, and rows filled and kept."""
    train, rows = _with_gaps(spark, sf_dir, ["flight_date"])
    numbers = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("feature"), F.col(name).alias("given"),
                         F.col(f"{name}__imputed").alias("used"))
                for name in spec.NUMERIC_FEATURES
            ]
        )
    )
    long = median_imputer(train).transform(rows).select(numbers)
    missing = F.col("given").isNull()
    return rounded(
        long.groupBy("feature").agg(
            F.min(F.when(missing, F.col("used"))).alias("least_fill"),
            F.max(F.when(missing, F.col("used"))).alias("most_fill"),
            F.count_if(missing).alias("n_filled"),
            F.count_if(F.col("given") == F.col("used")).alias("n_kept"),
        )
    )


def std_scale(spark, sf_dir):
    train, rows = _with_gaps(spark, sf_dir, spec.IDENTITY)
    values = vector_to_array(SCALED)
    scaled = Pipeline(stages=number_stages(train)).fit(train).transform(rows)
    return rounded(
        scaled.filter(F.col("distance").isNotNull()).select(
            "flight_key",
            *[values[i].alias(f"{name}_scaled") for i, name in enumerate(spec.NUMERIC_FEATURES)],
        )
    )


def score_fixed(spark, sf_dir):
    rows = bind.with_history(
        add_schedule_features(bind.saved_accepted(spark, sf_dir)), ["carrier", "route"]
    )
    score = fixed_score(FIXED_WEIGHTS, FIXED_INTERCEPT)
    return rounded(rows.select("flight_key", score.alias("probability_score")))


def _fitted(spark, sf_dir):
    return fit_run(_featured(spark, sf_dir), spec.RunConfig(bounds=bind.BOUNDS))


# A fitted coefficient is less than this away from the least loss along its slot.
FLAT = 0.03


def fit_select(spark, sf_dir):
    """The whole grid: what no model can change, that the rest is in range, and that every slot of
    the penalty's model is where its loss is flat."""
    fitted = _fitted(spark, sf_dir)
    flat = fitted.grid_gradients.groupBy("reg_param").agg(F.min(is_flat(FLAT)).alias("is_flat"))
    tp, fp, tn, fn = (F.col(n) for n in COUNTS)
    inside = F.lit(True)
    for name in ("accuracy", "precision", "recall", "f1", "specificity", "roc_auc"):
        inside = inside & F.col(name).between(0.0, 1.0)
    return fitted.grid.join(flat, "reg_param").select(
        "position", "reg_param", "threshold", "max_iterations", "row_count",
        (tp + fn).alias("positives"), (fp + tn).alias("negatives"), inside.alias("in_range"),
        "is_flat",
    )


def fit_gradients(spark, sf_dir):
    """Every slot of every penalty's model, with its mean over the training rows, and whether the
    loss is flat there."""
    found = _fitted(spark, sf_dir).grid_gradients
    return rounded(found.select("reg_param", "slot", "weight", is_flat(FLAT).alias("is_flat")))


def _number_scales(rows: DataFrame) -> DataFrame:
    """Median and deviation of every number, straight from the rows."""
    deviations = rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("feature"), F.col(name).alias("given"))
                    for name in spec.NUMERIC_FEATURES
                ]
            )
        )
    )
    deviations = deviations.groupBy("feature").agg(F.stddev_samp("given").alias("deviation"))
    return exact_medians(rows).join(deviations, "feature").select(
        "feature", F.col("value").alias("fill"), "deviation"
    )


def score_model(spark, sf_dir):
    """The scored test rows; of the score, that it is the one that the named coefficients give."""
    featured = _featured(spark, sf_dir)
    fitted = fit_run(featured, spec.RunConfig(bounds=bind.BOUNDS))
    test = explained_score(
        featured.filter("split = 'test'"), fitted.coefficients, fitted.model.intercept,
        _number_scales(featured.filter("split <> 'test'")),
    )
    rows = fitted.predictions.join(test.select("flight_key", "explained_score"), "flight_key")
    score = F.col("probability_score")
    threshold = F.lit(fitted.best["threshold"])
    return rows.select(
        *spec.PREDICTION_COLUMNS[:-2],
        (F.abs(score - F.col("explained_score")) < 1e-9).alias("is_explained"),
        (F.col("prediction") == (score >= threshold).cast("double")).alias("is_class"),
    )


def coefficient_table(spark, sf_dir):
    """Every slot's name and place; that sign, size and direction agree, and that the loss of the
    returned model is flat at the slot."""
    fitted = _fitted(spark, sf_dir)
    value, size = F.col("coefficient"), F.col("absolute_coefficient")
    sign = F.when(value > 0, DIRECTIONS[1]).when(value < 0, DIRECTIONS[-1]).otherwise(DIRECTIONS[0])
    gradient = fitted.gradients.select(
        F.col("slot").alias("feature_index"), F.col("coefficient").alias("fitted"),
        "gradient", "curvature",
    )
    return fitted.coefficients.join(gradient, "feature_index").select(
        "feature_index", "feature_name",
        ((size == F.abs(value)) & (F.col("direction") == sign)).alias("agrees"),
        ((value == F.col("fitted")) & is_flat(FLAT)).alias("is_flat"),
    )


def top_coefficients(spark, sf_dir):
    """The largest coefficients: as many as asked, none smaller than any left out."""
    table = save_shared(_fitted(spark, sf_dir).coefficients, "coefficients")
    top = table.orderBy(F.desc("absolute_coefficient"), "feature_index").limit(TOP_COEFFICIENTS)
    least = top.agg(F.min("absolute_coefficient")).scalar()
    return table.agg(
        F.sum((F.col("absolute_coefficient") > least).cast("long")).alias("above"),
        F.sum((F.col("absolute_coefficient") >= least).cast("long")).alias("reached"),
    ).select(
        (F.col("above") < TOP_COEFFICIENTS).alias("none_left_out"),
        (F.col("reached") >= TOP_COEFFICIENTS).alias("enough"),
    )


def calibration(spark, sf_dir):
    """An unpenalised fit with intercept scores its own rows, on average, at their positive share."""
    train = _featured(spark, sf_dir, MODEL_COLUMNS).filter("split = 'train'")
    preprocessor = fit_preprocessor(train)
    features = preprocessor.transform(train).select("label", "features")
    features = save_shared(features, "features")
    scored = score_rows(fit_logistic(features, 0.0), features)
    gap = F.abs(F.avg("probability_score") - F.avg("label"))
    return scored.agg(F.count("*").alias("row_count"), (gap < 0.001).alias("calibrated"))


def saved_models(spark, sf_dir):
    """Models saved, loaded and scored again give the same test rows and scores."""
    featured = _featured(spark, sf_dir)
    fitted = fit_run(featured, spec.RunConfig(bounds=bind.BOUNDS))
    folder = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    saved = save_models(fitted.preprocessor, fitted.model, folder)
    preprocessor, model = load_models(folder)
    test = featured.filter("split = 'test'")
    again = score_rows(model, preprocessor.transform(test)).select(
        "flight_key", F.col("probability_score").alias("again")
    )
    both = fitted.predictions.join(again, "flight_key")
    return both.agg(
        F.count("*").alias("row_count"),
        F.max(F.abs(F.col("again") - F.col("probability_score")) < 1e-12).alias("any_same"),
        F.min(F.abs(F.col("again") - F.col("probability_score")) < 1e-12).alias("all_same"),
    ).withColumn("saved", F.lit(saved["saved"]))


def validation_comparison(spark, sf_dir):
    """Model-free scores and the majority class beside each other on the validation split."""
    rows = bind.saved_accepted(spark, sf_dir)
    joined = bind.with_history(rows, ["route"]).filter("split = 'validation'")
    scored = joined.withColumn("probability_score", F.col("hist_route_delay_rate"))
    frames = split_frames(rows, bind.BOUNDS)
    constant = constant_baseline(frames["validation"], majority_class(frames["train"]).scalar())
    return rounded(compare(evaluate(scored), constant, "validation"))


def csv_sink(spark, sf_dir):
    """A report written as CSV and read back."""
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    write_report(reject_reasons(spark, sf_dir), path)
    schema = "rejection_reason string, row_count long"
    return spark.read.schema(schema).option("header", True).csv(path)


def json_sink(spark, sf_dir):
    """A table written as JSON lines, keys in order, and read back as text."""
    path = f"{shared_folder(spark)}/document-{uuid.uuid4().hex}"
    write_json(summary(spark, sf_dir).select("split", "row_count", "minimum_date"), path)
    return spark.read.text(path)


# --- events: the same operators on other columns ---


def events_global_prior(spark, sf_dir):
    daily = save_shared(day_totals(bind.events(spark, sf_dir), [], date="day"), "daily")
    return rounded(global_prior(daily, 0.2, date="day", rate="rate"))


def events_history(spark, sf_dir):
    rows = bind.events(spark, sf_dir)
    found = histories(rows, bind.EVENT_ENTITIES, date="day", rate="rate", save=save_shared)
    joined = attach_history(rows, found, date="day", rate="rate")
    columns = [c for c in history_columns(bind.EVENT_ENTITIES, "rate") if "global" not in c]
    return rounded(joined.select("event_id", *columns))


def events_cycle(spark, sf_dir):
    rows = bind.events(spark, sf_dir)
    cycled = add_cycle(rows, "second_of_day", "time", bind.DAY_SECONDS)
    return rounded(cycled.select("event_id", "time_sin", "time_cos"))


def queries() -> dict[str, Query]:
    return {
        "resolve_columns": resolve_columns,
        "stage_types": stage_types,
        "reject_reasons": reject_reasons,
        "quality_report": quality,
        "accepted_rows": accepted,
        "surrogate_key": surrogate_key,
        "csv_scan": csv_scan,
        "narrow_source": narrow_source,
        "file_manifest": manifest,
        "header_check": checked_headers,
        "prediction_sink": prediction_sink,
        "month_calendar": months,
        "daily_totals": daily_totals,
        "global_prior": prior,
        "entity_daily": entity_daily,
        **{f"history_{name}": entity_history(name) for name in spec.ENTITIES},
        "history_range_frame": history_range_frame,
        "history_range_rows": history_range_rows,
        "smoothed_rates": smoothed_rates,
        "cyclical_time": cyclical_time,
        "calendar_fields": calendar_fields,
        "featured_rows": featured,
        "chrono_split": chrono_split,
        "split_summary": summary,
        "class_distribution": classes,
        "history_coverage": coverage,
        "refit_union": refit_union,
        "threshold_sweep": threshold_sweep,
        "threshold_eval": threshold_eval,
        "apply_threshold": thresholded,
        "roc_auc_exact": roc_auc_exact,
        "roc_auc_binned": roc_auc_binned,
        "roc_curve": roc_curve,
        "pr_curve": pr_curve,
        "majority_class": majority,
        "constant_baseline": baseline_metrics,
        "confusion_matrix": confusion,
        "metric_comparison": metric_comparison,
        "grid_metrics": weighted_grid,
        "best_by_group": best_by_group,
        "select_best": best_row,
        "top_errors": errors,
        "label_index": label_index,
        "one_hot_slots": one_hot_slots,
        "rank_slots": ranked_slots,
        "median_impute": median_impute,
        "std_scale": std_scale,
        "score_fixed": score_fixed,
        "fit_select": fit_select,
        "fit_gradients": fit_gradients,
        "score_model": score_model,
        "coefficients": coefficient_table,
        "top_coefficients": top_coefficients,
        "calibration": calibration,
        "saved_models": saved_models,
        "validation_comparison": validation_comparison,
        "csv_sink": csv_sink,
        "json_sink": json_sink,
        "events_global_prior": events_global_prior,
        "events_history": events_history,
        "events_cycle": events_cycle,
    }
