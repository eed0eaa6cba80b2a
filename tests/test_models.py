import datetime as dt
import random
import re
import statistics
import threading
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import newton, slots
from tidemark.operators.accepted import unique_rows
from tidemark.operators.logistic import (
    carried,
    coefficients,
    fit_logistic,
    fit_penalties,
    fixed_score,
    grid_metrics,
    iterations,
    score_grid,
    score_rows,
    slot_names,
)
from tidemark.operators.optimality import explained_score, gradients, is_flat
from tidemark.operators.preprocess import fit_preprocessor, median_imputer
from tidemark.operators.slots import exact_medians
from tidemark.operators.staging import stage
from tidemark.plans.concurrent import side_by_side
from tidemark.sources.committed import committed_folder, committed_manifest
from tidemark.sources.csv_files import RAW_COLUMNS
from tidemark.sources.shared import save_shared, written
from tidemark.sources.sinks import load_models, save_models
from tidemark.spec import ModelGrid

CATEGORIES, NUMBERS = ["colour"], ["size", "flat"]
SCHEMA = "colour string, size double, flat double, label double"


def rows(seed, n=300, colours="rrrggb"):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        colour, size = rng.choice(colours), round(rng.uniform(0, 10), 3)
        made.append((colour, size, 5.0, float(rng.random() < (0.8 if colour == "r" else 0.2))))
    return made


@pytest.fixture(scope="module")
def fitted(spark):
    train = spark.createDataFrame(rows(1), SCHEMA).cache()
    return train, fit_preprocessor(train, CATEGORIES, NUMBERS)


def test_slots_follow_frequency_and_unseen_values_share_the_last(spark, fitted):
    _, preprocessor = fitted
    later = spark.createDataFrame(
        [("r", 1.0, 1.0, 0.0), ("g", 1.0, 1.0, 0.0), ("b", 1.0, 1.0, 0.0),
         ("new", 1.0, 1.0, 0.0), (None, 1.0, 1.0, 0.0)], SCHEMA)
    got = preprocessor.transform(later).select(vector_to_array("colour__one_hot")).collect()
    assert [r[0] for r in got] == [
        [1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [0, 0, 0, 1]
    ]


def test_numbers_are_filled_and_scaled_by_training_rows(spark, fitted):
    train, preprocessor = fitted
    sizes = [r["size"] for r in train.collect()]
    later = spark.createDataFrame([("r", None, 5.0, 0.0), ("r", 2.0, 5.0, 0.0)], SCHEMA)
    got = preprocessor.transform(later).select(vector_to_array("numeric_features_scaled")).collect()
    sd = statistics.stdev(sizes)
    filled = got[0][0][0] * sd
    below = sum(s < filled - 1e-9 for s in sizes) / len(sizes)
    assert below == pytest.approx(0.5, abs=0.01)
    assert got[1][0][0] == pytest.approx(2.0 / sd)
    # A column that does not vary carries nothing.
    assert got[1][0][1] == 0.0


def test_median_is_the_exact_lower_one(spark):
    df = spark.range(10000).selectExpr("double(id) AS x").union(
        spark.sql("SELECT CAST(NULL AS double)"))
    assert median_imputer(df, ["x"]).surrogateDF.first()["x"] == 4999.0


def test_names_and_coefficients(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    names = slot_names(preprocessor)
    assert names == ["colour__one_hot_r", "colour__one_hot_g", "colour__one_hot_b",
                     "colour__one_hot___unknown", "numeric__size", "numeric__flat"]
    model = fit_logistic(features, 0.0)
    table = coefficients(model, preprocessor).collect()
    sizes = [r["absolute_coefficient"] for r in table]
    assert sizes == sorted(sizes, reverse=True)
    by_name = {r["feature_name"]: r for r in table}
    assert by_name["colour__one_hot_r"]["direction"] == "higher_delay_risk"
    assert by_name["numeric__flat"]["direction"] == "neutral"
    assert [r["coefficient"] for r in sorted(table, key=lambda r: r["feature_index"])] == list(
        model.coefficients)
    assert [r["feature_index"] for r in table if r["coefficient"] == 0] == sorted(
        r["feature_index"] for r in table if r["coefficient"] == 0)


def test_scores_and_penalties(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    models = {reg: fit_logistic(features, reg, 50) for reg in (0.0, 0.1, 1.0)}
    norms = [float(sum(v * v for v in m.coefficients)) for m in models.values()]
    assert norms == sorted(norms, reverse=True)
    scored = score_rows(models[0.0], features)
    assert scored.filter("probability_score <= 0 OR probability_score >= 1").isEmpty()
    assert score_rows(models[0.0], features).columns.count("probability_score") == 1
    together = score_grid(models, features)
    alone = score_rows(models[0.1], features).select("label", "probability_score")
    of_one = together.filter("reg_param = 0.1").drop("reg_param")
    assert of_one.exceptAll(alone).isEmpty() and together.count() == 3 * features.count()


def test_grid_covers_every_pair_in_order(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    grid = ModelGrid(reg_params=(0.1, 0.0), thresholds=(0.6, 0.3), max_iterations=20)
    models = {reg: fit_logistic(features, reg, 20) for reg in grid.reg_params}
    got = grid_metrics(models, features, grid).orderBy("position").collect()
    assert [(r["reg_param"], r["threshold"]) for r in got] == [
        (0.1, 0.6), (0.1, 0.3), (0.0, 0.6), (0.0, 0.3)]
    assert all(r["row_count"] == 300 and 0.5 < r["roc_auc"] <= 1 for r in got)


def test_fixed_score(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    got = df.select(fixed_score({"a": 0.5, "b": -0.25}, 0.0)).first()[0]
    assert got == pytest.approx(0.5)


def test_models_are_saved_and_loaded(spark, fitted, tmp_path):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    model = fit_logistic(features, 0.01, 10)
    saved = save_models(preprocessor, model, str(tmp_path / "models"))
    assert saved == {"requested": True, "saved": True, "error": None}
    again, same = load_models(str(tmp_path / "models"))
    one = score_rows(model, features).select("probability_score")
    two = score_rows(same, again.transform(train)).select("probability_score")
    assert one.exceptAll(two).isEmpty()
    (tmp_path / "file").write_text("in the way")
    failed = save_models(preprocessor, model, str(tmp_path / "file" / "models"))
    assert failed["requested"] and not failed["saved"] and failed["error"]


def _raw_flights(spark):
    """Ninety flights in each split, every third of them late, from seeded draws."""
    rng = random.Random(11)
    made = []
    for first in (dt.date(2023, 5, 1), dt.date(2025, 3, 1), dt.date(2025, 9, 1)):
        for i in range(90):
            origin, dest = rng.sample(["BOS", "IAD", "MIA", "ORD"], 2)
            made.append((
                str(first + dt.timedelta(days=i % 30)), rng.choice(["XX", "YY"]),
                f"{first.month}{i:03}", origin, dest, str(rng.randrange(24) * 100 + 5),
                str(rng.randrange(24) * 100 + 40), str(rng.randrange(40, 300)),
                str(rng.randrange(100, 2500)), str(20 if i % 3 == 0 else -rng.randrange(9)),
                "0", "0",
            ))
    return spark.createDataFrame(made, ", ".join(f"{name} string" for name in RAW_COLUMNS))


def test_whole_run(spark, tmp_path):
    from tidemark.plans.run import run
    from tidemark.spec import RunConfig

    config = RunConfig(grid=ModelGrid(reg_params=(0.0, 0.1), max_iterations=5),
                       export_predictions=True)
    tables = run(_raw_flights(spark), str(tmp_path), config)
    summary = {r["split"]: r for r in tables["split_summary"].collect()}
    assert {k: r["row_count"] for k, r in summary.items()} == {
        "train": 90, "validation": 90, "test": 90}
    assert all(r["delay_rate"] == pytest.approx(1 / 3) for r in summary.values())
    assert summary["train"]["minimum_date"] == dt.date(2023, 5, 1)
    metrics = {r["model"]: r for r in tables["final_test_metrics"].collect()}
    assert metrics["majority_class_baseline"]["accuracy"] == pytest.approx(2 / 3)
    assert metrics["logistic_regression"]["row_count"] == 90
    assert tables["model_selection_validation"].count() == 22
    assert tables["precision_recall_curve"].first()["prevalence"] == pytest.approx(1 / 3)
    folder = Path(committed_folder(spark, str(tmp_path)))
    assert spark.read.parquet(str(folder / "predictions")).count() == 90
    assert not (folder / "models").exists()
    listed = {r["name"]: r for r in committed_manifest(spark, str(tmp_path)).collect()}
    assert listed["predictions"]["row_count"] == 90
    assert listed["predictions"]["sums"]["label"] == 30
    assert listed["split_summary"]["sums"]["row_count"] == 270
    assert set(listed) == {*tables, "predictions", "metrics"}
    document = spark.read.json(str(folder / "metrics")).first()
    assert document["selected_model"]["refit_on_train_plus_validation"] is True
    assert document["serialization"]["requested"] is False
    written = spark.read.option("header", True).csv(str(folder / "tables" / "split_summary"))
    assert written.count() == 3


def test_written_tables_are_pruned(spark, plan):
    from tidemark.plans.cleaning import prepare
    from tidemark.spec import RunConfig

    prepared = prepare(_raw_flights(spark), RunConfig())
    text = plan(prepared.featured.filter("split = 'train'").select("label"))
    assert re.search(r"PartitionFilters: \[[^]]*split", text)
    assert "add_split" not in text and "ReadSchema: struct<label:double>" in text
    staged = save_shared(stage(_raw_flights(spark), RunConfig().bounds), "staged")
    text = plan(unique_rows(staged, written=True))
    assert "EqualTo(rejection_reason,ACCEPTED)" in text


# --- proof of a fit ---


def _changed(spark, model, slot, by):
    """The model with one coefficient moved."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors

    values = model.coefficients.toArray().copy()
    values[slot] += by
    kind = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    moved = LogisticRegressionModel(
        kind("moved", _py2java(spark.sparkContext, Vectors.dense(values)), model.intercept)
    )
    return moved.setFeaturesCol("features")


@pytest.mark.parametrize("reg_param", [0.0, 0.01, 0.5])
def test_the_loss_is_flat_at_a_fit_and_nowhere_else(spark, fitted, reg_param):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    model = fit_logistic(features, reg_param)
    found = gradients({reg_param: model}, features).orderBy("slot").collect()
    assert [r["slot"] for r in found] == list(range(-1, 6))
    assert max(abs(r["gradient"]) for r in found) < 1e-5
    for slot in (0, 2, 4):
        moved = gradients({reg_param: _changed(spark, model, slot, 0.05)}, features)
        red = [r["slot"] for r in moved.filter(~is_flat(0.03)).collect()]
        assert slot in red


def test_gradients_equal_a_plain_sum(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    models = {reg: fit_logistic(features, reg, 2) for reg in (0.0, 0.3)}
    found = {(r["reg_param"], r["slot"]): r for r in gradients(models, features).collect()}
    for reg, model in models.items():
        rows = [(r["features"].toArray(), r["label"], r["probability"][1])
                for r in model.transform(features).collect()]
        n = len(rows)
        assert found[reg, -1]["gradient"] == pytest.approx(sum(p - y for _, y, p in rows) / n)
        for slot, weight in enumerate(model.coefficients):
            own = sum((p - y) * x[slot] for x, y, p in rows) / n + reg * weight
            assert found[reg, slot]["gradient"] == pytest.approx(own, abs=1e-12)
            assert found[reg, slot]["weight"] == pytest.approx(sum(x[slot] for x, *_ in rows) / n)


def test_no_gradients_without_rows(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    model = fit_logistic(features, 0.1, 2)
    assert gradients({0.1: model}, features.limit(0)).collect() == []


def test_scores_follow_from_the_names_of_coefficients(spark, fitted):
    train, preprocessor = fitted
    model = fit_logistic(preprocessor.transform(train), 0.01)
    table = coefficients(model, preprocessor)
    later = spark.createDataFrame(
        [("r", 1.0, 5.0, 0.0), ("new", None, 5.0, 0.0), (None, float("nan"), None, 1.0)], SCHEMA)
    deviations = {n: statistics.stdev(r[n] for r in train.collect()) for n in NUMBERS}
    medians = {r["feature"]: r["value"] for r in exact_medians(train, NUMBERS).collect()}
    scales = spark.createDataFrame(
        [(n, medians[n], deviations[n]) for n in NUMBERS],
        "feature string, fill double, deviation double")

    def gaps(table):
        rows = explained_score(later, table, model.intercept, scales, CATEGORIES, NUMBERS)
        both = score_rows(model, preprocessor.transform(rows))
        return [abs(r["probability_score"] - r["explained_score"]) for r in both.collect()]

    assert max(gaps(table)) < 1e-9
    moved = F.when(F.col("feature_name") == "colour__one_hot_r", F.col("coefficient") + 0.01)
    wrong = table.withColumn("coefficient", F.coalesce(moved, "coefficient"))
    assert max(gaps(wrong)) > 1e-4


def test_largest_coefficients_come_first(fitted):
    train, preprocessor = fitted
    model = fit_logistic(preprocessor.transform(train), 0.0)
    top = [r["absolute_coefficient"] for r in coefficients(model, preprocessor).limit(3).collect()]
    assert top == sorted((abs(float(w)) for w in model.coefficients), reverse=True)[:3]


def test_medians_need_a_sketch_only_where_values_crowd(spark, monkeypatch):
    rng = random.Random(11)
    n = 1001
    made = {
        "even": [rng.uniform(-5, 5) for _ in range(n)],
        "ties": [float(rng.randrange(3)) for _ in range(n)],
        "flat": [2.5] * n,
        "gaps": [rng.choice([None, float("nan"), rng.gauss(0, 1)]) for _ in range(n)],
        "none": [None] * n,
        "pair": [1.0, 2.0] + [None] * (n - 2),
        "crowd": [1e300] + [rng.random() for _ in range(n - 1)],
        "endless": [float("inf"), float("-inf")] + [rng.random() for _ in range(n - 2)],
        "tiny": [rng.randrange(2) * 5e-324 for _ in range(n)],
    }
    frame = spark.createDataFrame(
        list(zip(*made.values())), ", ".join(f"{name} double" for name in made))
    sketched = []
    plain = slots.F.percentile_approx

    def noted(*args):
        sketched.append(args[0])
        return plain(*args)

    monkeypatch.setattr(slots.F, "percentile_approx", noted)
    found = {r["feature"]: (r["value"], r["n"]) for r in exact_medians(frame, list(made)).collect()}
    held = {name: [x for x in values if x is not None and x == x] for name, values in made.items()}
    assert found == {
        name: (statistics.median_low(values), len(values)) for name, values in held.items() if values}
    assert len(sketched) == 3
    monkeypatch.setattr(slots, "BUCKETS", 3)
    monkeypatch.setattr(slots, "CROWDED", 1.0)
    assert found == {
        r["feature"]: (r["value"], r["n"]) for r in exact_medians(frame, list(made)).collect()}


# --- the solver ---


@pytest.mark.parametrize("reg_param", [0.0, 0.02, 1.0])
def test_fits_are_those_of_sparks_solver(spark, fitted, reg_param):
    """Also in slots that always add up to one, where an unpenalised fit is not the only one."""
    train, preprocessor = fitted
    features = preprocessor.transform(train)
    model = fit_logistic(features, reg_param)
    other = LogisticRegression(
        family="binomial", regParam=reg_param, maxIter=500, tol=1e-13, standardization=False
    ).fit(features)
    assert model.coefficients.toArray() == pytest.approx(other.coefficients.toArray(), abs=2e-4)
    assert model.intercept == pytest.approx(other.intercept, abs=2e-4)
    assert model.getRegParam() == reg_param and model.numFeatures == other.numFeatures


def test_all_penalties_share_a_few_passes(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train).select("label", "features").localCheckpoint()
    read = spark.sparkContext._jsc.sc()
    first = read.dagScheduler().nextJobId()
    models = fit_penalties(features, [0.0, 0.001, 0.01, 0.1], 100)
    assert list(models) == [0.0, 0.001, 0.01, 0.1]
    assert max(iterations(model) for model in models.values()) < 10
    # Up to three jobs each: a summary, and one pass per step.
    assert read.dagScheduler().nextJobId() - first < 40


def test_dense_vectors_far_off_zero_and_rare_slots(spark):
    rng = random.Random(5)
    made = []
    for i in range(400):
        far, rare = 1e6 + rng.random(), float(i % 100 == 0)
        label = float(rng.random() < 0.2 + 0.5 * (far - 1e6))
        made.append((label, Vectors.dense([far, rare, 3.0, rng.gauss(0, 1)])))
    made += [(y, Vectors.sparse(4, [(j, v) for j, v in enumerate(x) if v])) for y, x in made]
    frame = spark.createDataFrame(made, ["label", "features"])
    model = fit_logistic(frame, 0.0)
    assert model.coefficients[2] == 0.0
    found = gradients({0.0: model}, frame).collect()
    assert max(abs(r["gradient"]) for r in found if r["slot"] != 0) < 1e-6
    centred = frame.select("label", (vector_to_array("features")[0] - 1e6).alias("x"),
                           *[vector_to_array("features")[i].alias(f"x{i}") for i in (1, 3)])
    inputs = VectorAssembler(inputCols=["x", "x1", "x3"], outputCol="features").transform(centred)
    other = fit_logistic(inputs, 0.0)
    assert model.coefficients[0] == pytest.approx(other.coefficients[0], rel=1e-6)


def test_separable_classes_and_one_class_end(spark):
    rows = [(float(i > 5), Vectors.dense([float(i), 1.0])) for i in range(12)]
    frame = spark.createDataFrame(rows, ["label", "features"])
    model = fit_logistic(frame, 0.0)
    scores = score_rows(model, frame).collect()
    assert all((r["probability_score"] > 0.999) == (r["label"] == 1) for r in scores)
    alone = fit_logistic(frame.filter("label = 1"), 0.1)
    assert alone.coefficients.toArray().tolist() == [0.0, 0.0] and alone.intercept > 0
    with pytest.raises(Exception):
        fit_logistic(frame.limit(0), 0.1)


def test_classes_that_can_be_told_apart_take_few_passes(spark):
    """Plain Newton steps would take one pass for every factor of e in the loss."""
    rng = random.Random(9)
    points = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(300)]
    rows = [(float(x[0] + 0.5 * x[1] > 0.3), Vectors.dense(x)) for x in points]
    frame = spark.createDataFrame(rows, ["label", "features"])
    models = fit_penalties(frame, [0.0, 0.1])
    assert iterations(models[0.0]) <= 15
    scores = score_rows(models[0.0], frame).collect()
    assert all((r["probability_score"] > 0.5) == (r["label"] == 1) for r in scores)
    flat = gradients(models, frame).filter(~is_flat(0.03)).collect()
    assert flat == []


def test_blocks_give_back_every_row():
    """Also rows whose batches have other slots in common, values other than 1, and empty rows."""
    rng = np.random.default_rng(3)
    expected, batches = [], []
    for usual in ([5], [1, 5], []):
        rows = []
        for i in range(50):
            kept = {*usual, *rng.choice(6, rng.integers(0, 3)).tolist()} if i % 9 else set()
            rows.append({j: 1.0 if j < 3 else float(rng.normal()) for j in sorted(kept)})
        label = (np.arange(50) % 2).astype(float)
        batches.append(pa.RecordBatch.from_pydict({
            "label": label, "size": np.full(50, 6),
            "indices": pa.array([list(row) for row in rows], pa.list_(pa.int32())),
            "values": pa.array([list(row.values()) for row in rows], pa.list_(pa.float64())),
        }))
        expected += [[y, *(row.get(j, 0.0) for j in range(6))] for y, row in zip(label, rows)]
    blocks = pa.Table.from_batches(newton._blocks(6)(iter(batches))).combine_chunks()
    found = []
    for batch in blocks.to_batches(max_chunksize=5):
        for slots, labels, common, counts, indices, values in newton._rows(batch):
            whole = np.zeros((len(labels), 6))
            whole[:, slots] = common
            whole[np.repeat(np.arange(len(labels)), counts), indices] += values
            found += np.column_stack([labels, whole]).tolist()
    assert sorted(found) == sorted(expected)


def test_gradients_of_blocks_equal_sparks_sums(spark, fitted):
    train, preprocessor = fitted
    features = preprocessor.transform(train).select("label", "features")
    models = {reg: fit_logistic(features, reg, 2) for reg in (0.0, 0.3)}
    with newton.in_blocks(features) as blocks:
        found = gradients(models, features, blocks)
        plain = gradients(models, features)
        assert found.dtypes == plain.dtypes
        pairs = zip(*(df.orderBy("reg_param", "slot").collect() for df in (found, plain)))
        for own, other in pairs:
            assert tuple(own) == pytest.approx(tuple(other), abs=1e-12)


def test_training_rows_are_made_once_for_fit_and_proof(spark):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = spark.range(0, 4000, 1, 8).mapInArrow(counting, "id long")
    inputs = raw.select((F.col("id") % 3 == 0).cast("double").alias("label"),
                        (F.col("id") % 7).cast("double").alias("x"))
    training = VectorAssembler(inputCols=["x"], outputCol="features").transform(inputs)
    with newton.in_blocks(training) as blocks:
        models = fit_penalties(training, [0.0, 0.1], blocks=blocks)
        assert gradients(models, training, blocks).filter(~is_flat(0.03)).count() == 0
    # The first row is looked at beforehand, which takes its partition.
    assert read.value <= 4000 + 500


@pytest.mark.parametrize("reg_param", [0.0, 0.02])
def test_a_start_saves_passes_and_changes_nothing(spark, fitted, reg_param):
    """Also where the start differs by what no score depends on: all slots of a category."""
    train, preprocessor = fitted
    features = preprocessor.transform(train).select("label", "features")
    plain = fit_logistic(features, reg_param)
    weights = plain.coefficients.toArray().copy()
    off = np.array([name.startswith("colour") for name in slot_names(preprocessor)]) * 0.7
    assert off.any() and not off.all()
    shift = off if reg_param == 0 else 0 * off
    begun = fit_logistic(features, reg_param, start=(weights + shift, plain.intercept - 0.7))
    assert begun.coefficients.toArray() == pytest.approx(weights, abs=1e-4)
    assert begun.intercept == pytest.approx(plain.intercept, abs=1e-4)
    near = fit_logistic(features, reg_param, start=(weights, plain.intercept))
    assert iterations(near) == 1 < iterations(plain)
    assert near.coefficients.toArray() == pytest.approx(weights, abs=1e-6)
    # A start far off is not taken.
    far = fit_logistic(features, reg_param, start=(weights + 50, 30.0))
    assert far.coefficients.toArray() == pytest.approx(weights, abs=1e-9)


def test_coefficients_are_carried_to_other_slots(spark, fitted):
    train, preprocessor = fitted
    model = fit_logistic(preprocessor.transform(train), 0.01)
    both = spark.createDataFrame([*rows(1), *rows(2, colours="bbbbbbbnnn")], SCHEMA)
    other = fit_preprocessor(both, CATEGORIES, NUMBERS)
    weights, intercept = carried(model, preprocessor, other)
    names = slot_names(other)
    assert len(weights) == len(names) and weights[names.index("colour__one_hot_n")] == 0.0
    known = spark.createDataFrame(rows(3), SCHEMA)
    scores = [r["probability_score"] for r in score_rows(
        model, preprocessor.transform(known)).collect()]
    vectors = [r["features"].toArray() for r in other.transform(known).collect()]
    again = [1 / (1 + np.exp(-(x @ weights + intercept))) for x in vectors]
    assert again == pytest.approx(scores, abs=1e-12)


def test_rows_that_the_solver_cannot_take_are_left_to_sparks(spark):
    made = [(float(i % 2), Vectors.dense([i, 1.0])) for i in range(20)]

    def frame(rows):
        return spark.createDataFrame(rows, ["label", "features"])

    for odd in ((2.0, Vectors.dense([1.0, 1.0])), (1.0, Vectors.dense([float("inf"), 1.0])),
                (1.0, Vectors.dense([1.0])), (None, Vectors.dense([1.0, 1.0])), (1.0, None)):
        with newton.in_blocks(frame([*made, odd])) as blocks:
            assert blocks is None
    with newton.in_blocks(frame(made)) as blocks:
        assert blocks.known.n == 20 and blocks.known.mean[0] == pytest.approx(9.5)
        assert blocks.known.deviation.tolist() == pytest.approx([statistics.stdev(range(20)), 0])


def test_inputs_are_written_for_the_fit_alone(spark):
    with written(spark.range(5), "rows") as rows:
        (path,) = {str(Path(f.removeprefix("file:")).parent) for f in rows.inputFiles()}
        assert rows.count() == 5 and Path(path).exists()
    assert not Path(path).exists()


# --- side by side ---


def test_tasks_run_at_the_same_time_and_keep_their_order(spark):
    barrier = threading.Barrier(3, timeout=60)

    def task(n):
        def work():
            barrier.wait()
            return spark.range(n).count()

        return work

    found = side_by_side(spark, "count", {n: task(n) for n in (30, 10, 20)})
    assert found == {30: 30, 10: 10, 20: 20} and list(found) == [30, 10, 20]
    assert side_by_side(spark, "nothing", {}) == {}


def test_a_failure_cancels_the_others(spark):
    started = threading.Event()

    def slow():
        rows = spark.range(8).repartition(8).select(
            F.expr("reflect('java.lang.Thread', 'sleep', 600000L)").alias("x"))
        started.set()
        return rows.collect()

    def failing():
        started.wait(30)
        time.sleep(1)
        raise ValueError("no")

    begun = time.monotonic()
    with pytest.raises(ValueError, match="no"):
        side_by_side(spark, "mixed", {"slow": slow, "failing": failing})
    assert time.monotonic() - begun < 60
