import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.functions.grid import steps_reached
from tidemark.operators.baseline import compare, constant_baseline, majority_class
from tidemark.operators.errors import top_errors
from tidemark.operators.ranking import binned_roc_auc, roc_auc
from tidemark.operators.selection import best_per_group, select_best
from tidemark.operators.sweep import (
    add_ratios,
    apply_threshold,
    confusion_matrix,
    even_grid,
    precision_recall_points,
    roc_points,
    threshold_metrics,
)
from tidemark.spec import CLASS_NAMES, ModelGrid

COUNTS = "true_positive long, false_positive long, true_negative long, false_negative long"


def scored(spark, rows):
    return spark.createDataFrame(rows, "probability_score double, label double")


def random_scores(seed, n=500, digits=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows share one score.
        score = 0.35 if i % 3 == 0 else round(rng.random(), digits)
        rows.append((score, float(rng.random() < score)))
    return rows


def test_published_counts_give_the_published_ratios(spark):
    df = spark.createDataFrame(
        [(458875, 922034, 1778303, 334449), (0, 0, 2700337, 793324)], COUNTS
    )
    model, baseline = add_ratios(df).collect()
    assert model["row_count"] == 3493661
    assert model["accuracy"] == pytest.approx(0.640353485927799, abs=1e-15)
    assert model["precision"] == pytest.approx(0.33229923188276705, abs=1e-15)
    assert model["recall"] == pytest.approx(0.5784206704952831, abs=1e-15)
    assert model["f1"] == pytest.approx(0.42210287489887244, abs=1e-15)
    assert model["specificity"] == pytest.approx(0.658548544126159, abs=1e-15)
    assert baseline["accuracy"] == pytest.approx(0.7729247342544111, abs=1e-15)
    assert [baseline[m] for m in ("precision", "recall", "f1", "specificity")] == [0, 0, 0, 1]


def test_zero_denominators_give_zero(spark):
    row = add_ratios(spark.createDataFrame([(0, 0, 0, 0)], COUNTS)).first()
    assert [row[m] for m in ("accuracy", "precision", "recall", "f1", "specificity")] == [0] * 5


@pytest.mark.parametrize("grid", [even_grid(101), list(ModelGrid().thresholds), [0.9, 0.1, 0.5]])
def test_sweep_matches_counting(spark, grid):
    rows = random_scores(1)
    got = threshold_metrics(scored(spark, rows).repartition(5), grid).orderBy("position").collect()
    assert [r["threshold"] for r in got] == grid
    for row in got:
        t = row["threshold"]
        assert row["true_positive"] == sum(s >= t and y == 1 for s, y in rows)
        assert row["false_positive"] == sum(s >= t and y == 0 for s, y in rows)
        assert row["true_negative"] == sum(s < t and y == 0 for s, y in rows)
        assert row["false_negative"] == sum(s < t and y == 1 for s, y in rows)
        assert row["row_count"] == len(rows)


def test_grid_points_are_compared_exactly(spark):
    grid = even_grid(101)
    df = scored(spark, [(g, 1.0) for g in grid])
    got = df.select(steps_reached(F.col("probability_score"), grid)).collect()
    assert [r[0] for r in got] == list(range(1, 102))


def test_sweep_by_group_and_of_nothing(spark):
    rows = random_scores(2)
    df = scored(spark, rows).withColumn("g", F.monotonically_increasing_id() % 2)
    both = threshold_metrics(df, [0.3, 0.6], by=["g"])
    for g in (0, 1):
        alone = threshold_metrics(df.filter(F.col("g") == g), [0.3, 0.6])
        assert sorted(map(tuple, both.filter(F.col("g") == g).drop("g").collect())) == sorted(
            map(tuple, alone.collect())
        )
    empty = threshold_metrics(scored(spark, []), [0.5]).first()
    assert empty["row_count"] == 0 and empty["f1"] == 0


def test_null_scores_are_in_no_count(spark):
    row = threshold_metrics(scored(spark, [(None, 1.0), (0.7, 1.0), (0.2, 0.0)]), [0.5]).first()
    assert row["row_count"] == 2 and row["true_positive"] == 1 and row["true_negative"] == 1


def test_threshold_is_inclusive(spark):
    got = apply_threshold(scored(spark, [(0.5, 1.0), (0.49, 0.0)]), 0.5).collect()
    assert [r["prediction"] for r in got] == [1.0, 0.0]


@pytest.mark.parametrize("seed", [3, 4])
def test_area_equals_the_evaluators_unbinned_area(spark, seed):
    df = scored(spark, random_scores(seed, n=3000, digits=4)).repartition(6)
    exact = BinaryClassificationEvaluator(
        rawPredictionCol="probability_score", numBins=0
    ).evaluate(df)
    assert roc_auc(df).first()[0] == pytest.approx(exact, abs=1e-12)


@pytest.mark.parametrize("bins", [1000, 50, 7])
def test_binned_area_equals_the_evaluators(spark, bins):
    """In one partition the evaluator cuts its bins as this operator does."""
    df = scored(spark, random_scores(6, n=4000, digits=5)).coalesce(1)
    area = BinaryClassificationEvaluator(
        rawPredictionCol="probability_score", numBins=bins
    ).evaluate(df)
    assert binned_roc_auc(df.repartition(5), bins=bins).first()[0] == pytest.approx(area, abs=1e-9)


def test_binned_area_by_group_and_at_the_edges(spark):
    rows = [("one", 0.1, 1.0), ("one", 0.2, 1.0), ("none", 0.3, 0.0), ("both", 0.2, 0.0),
            ("both", 0.9, 1.0), ("lost", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, probability_score double, label double")
    found = dict(map(tuple, binned_roc_auc(df, ["g"]).collect()))
    assert found == {"one": 1.0, "none": 0.0, "both": 1.0}
    assert found == dict(map(tuple, roc_auc(df, ["g"]).collect()))
    assert binned_roc_auc(df.filter("g = 'lost'")).first()[0] is None
    with pytest.raises(ValueError):
        binned_roc_auc(df, bins=0)


def test_area_matches_counting_pairs_by_group(spark):
    rows = random_scores(5, n=200)
    df = scored(spark, rows).withColumn("g", (F.col("probability_score") * 100 % 3).cast("int"))
    parts = {}
    for r in df.collect():
        parts.setdefault(r["g"], []).append((r["probability_score"], r["label"]))
    for r in roc_auc(df, by=["g"]).collect():
        pos = [s for s, y in parts[r["g"]] if y == 1]
        neg = [s for s, y in parts[r["g"]] if y == 0]
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert r["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_area_of_one_class_and_of_nothing(spark):
    assert roc_auc(scored(spark, [(0.1, 0.0), (0.9, 0.0)])).first()[0] == 0.0
    assert roc_auc(scored(spark, [(0.1, 1.0), (0.9, 1.0)])).first()[0] == 1.0
    assert roc_auc(scored(spark, [])).first()[0] is None


def test_area_does_not_gather_rows(spark, plan):
    df = scored(spark, random_scores(6)).repartition(4)
    text = plan(roc_auc(df))
    window = next(line for line in text.splitlines() if " Window " in line)
    assert "slice" in window and "rangepartitioning" in text


def test_curves(spark):
    with pytest.raises(ValueError):
        even_grid(1)
    metrics = threshold_metrics(scored(spark, random_scores(7)), even_grid(101))
    roc = roc_points(metrics).collect()
    assert len(roc) == 101 and roc[0]["threshold"] > roc[-1]["threshold"]
    assert roc[-1]["false_positive_rate"] == 1.0 and roc[-1]["true_positive_rate"] == 1.0
    by_threshold = sorted(roc, key=lambda r: r["threshold"])
    for low, high in zip(by_threshold, by_threshold[1:]):
        assert high["false_positive_rate"] <= low["false_positive_rate"]
        assert high["true_positive_rate"] <= low["true_positive_rate"]
    recalls = [r["recall"] for r in precision_recall_points(metrics).collect()]
    assert recalls == sorted(recalls)
    assert "roc_auc" not in roc_points(metrics).columns


def test_baseline(spark):
    df = scored(spark, [(0.1, 1.0), (0.2, 0.0)])
    assert majority_class(df).first()[0] == 0
    assert majority_class(scored(spark, [(0.1, 1.0)])).first()[0] == 1
    with pytest.raises(Exception, match="no rows"):
        majority_class(scored(spark, [])).collect()
    row = constant_baseline(df, majority_class(df).scalar()).first()
    assert row["predicted_class"] == 0 and row["true_negative"] == 1 and row["recall"] == 0
    assert row["threshold"] is None and row["roc_auc"] is None
    ones = constant_baseline(df, 1).first()
    assert ones["true_positive"] == 1 and ones["false_positive"] == 1 and ones["recall"] == 1


def test_comparison_and_confusion(spark):
    df = scored(spark, random_scores(8))
    model = threshold_metrics(df, [0.4]).withColumn("reg_param", F.lit(0.01))
    rows = compare(model, constant_baseline(df, 0), "test").collect()
    assert [r["model"] for r in rows] == ["logistic_regression", "majority_class_baseline"]
    assert rows[1]["reg_param"] is None and rows[0]["predicted_class"] is None
    matrix = confusion_matrix(model, CLASS_NAMES).collect()
    first = model.first()
    assert (matrix[0]["predicted_on_time"], matrix[0]["predicted_delayed"]) == (
        first["true_negative"], first["false_positive"])
    assert (matrix[1]["predicted_on_time"], matrix[1]["predicted_delayed"]) == (
        first["false_negative"], first["true_positive"])


GRID = "reg_param double, threshold double, f1 double, precision double, recall double, " \
       "roc_auc double, position int"


@pytest.mark.parametrize(
    "rows, best",
    [
        ([(0.0, 0.2, 0.5, 0.9, 0.9, 0.9, 0), (0.1, 0.7, 0.6, 0.1, 0.1, 0.1, 1)], 1),
        ([(0.0, 0.2, 0.5, 0.4, 0.9, 0.9, 0), (0.1, 0.7, 0.5, 0.6, 0.1, 0.1, 1)], 1),
        ([(0.0, 0.2, 0.5, 0.5, 0.4, 0.9, 0), (0.1, 0.7, 0.5, 0.5, 0.5, 0.1, 1)], 1),
        ([(0.0, 0.2, 0.5, 0.5, 0.5, 0.1, 0), (0.1, 0.7, 0.5, 0.5, 0.5, 0.2, 1)], 1),
        ([(0.0, 0.2, 0.5, 0.5, 0.5, 0.5, 0), (0.1, 0.6, 0.5, 0.5, 0.5, 0.5, 1)], 1),
        ([(0.1, 0.4, 0.5, 0.5, 0.5, 0.5, 0), (0.0, 0.4, 0.5, 0.5, 0.5, 0.5, 1)], 1),
        ([(0.1, 0.25, 0.5, 0.5, 0.5, 0.5, 0), (0.1, 0.75, 0.5, 0.5, 0.5, 0.5, 1)], 0),
    ],
)
def test_best_row_and_its_ties(spark, rows, best):
    got = select_best(spark.createDataFrame(rows, GRID), [0.2, 0.4, 0.7]).first()
    assert got["position"] == best
    assert got["threshold_at_grid_edge"] == (got["threshold"] in (0.2, 0.7))


def test_best_per_group_takes_the_first_on_a_tie(spark):
    rows = [(0.0, 0.2, 0.5, 0.0, 0.0, 0.0, 0), (0.0, 0.3, 0.5, 0.0, 0.0, 0.0, 1),
            (0.1, 0.2, 0.1, 0.0, 0.0, 0.0, 2), (0.1, 0.3, 0.4, 0.0, 0.0, 0.0, 3)]
    got = best_per_group(spark.createDataFrame(rows, GRID)).orderBy("reg_param").collect()
    assert [r["position"] for r in got] == [0, 3]


def test_top_errors(spark, plan):
    rows = [(f"k{i}", s, y) for i, (s, y) in enumerate(random_scores(9))]
    df = apply_threshold(
        spark.createDataFrame(rows, "flight_key string, probability_score double, label double"),
        0.4,
    )
    got = top_errors(df, 7, columns=["flight_key", "probability_score", "label"])
    fp = sorted(((-s, k) for k, s, y in rows if s >= 0.4 and y == 0))[:7]
    fn = sorted(((-(1.0 - s), k) for k, s, y in rows if s < 0.4 and y == 1))[:7]
    by_type = {"false_positive": [], "false_negative": []}
    for r in got.collect():
        by_type[r["error_type"]].append((-r["error_confidence"], r["flight_key"]))
    assert by_type == {"false_positive": fp, "false_negative": fn}
    # Every task keeps its own best rows of a kind before the one shuffle by kind.
    text = plan(got)
    assert "7, Partial" in text and "7, Final" in text
