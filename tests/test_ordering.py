"""Places in a global order and order statistics against plain Python, and their plans."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.operators import slots as slots_module
from tidemark.operators.ordering import lower_quantile, number_rows, running_totals
from tidemark.operators.slots import attach_slots, exact_medians, rank_slots, saved_slots


def made(seed, n=800, values=60):
    rng = random.Random(seed)
    return [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.randrange(values) / 4, i)
            for i in range(n)]


def test_places_are_gapless_in_order(spark):
    rows = made(1)
    df = spark.createDataFrame(rows, "g string, x double, id int").repartition(5)
    found = number_rows(df, [F.desc("x"), F.asc("id")], ["g"]).collect()
    for group in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        got = sorted((r for r in found if r["g"] == group), key=lambda r: r["place"])
        assert [r["id"] for r in got] == [r[2] for r in own]
        assert [r["place"] for r in got] == list(range(len(own)))
        assert {r["total"] for r in got} == {len(own)}


def test_running_totals_without_groups(spark):
    rows = [(i, i % 7) for i in range(500)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "id int, w long")
    found = {r["id"]: r["before"] for r in running_totals(df, [F.asc("id")], F.col("w")).collect()}
    total = 0
    for i in range(500):
        assert found[i] == total
        total += i % 7


@pytest.mark.parametrize("share", [0.01, 0.25, 0.5, 0.9, 1.0])
def test_lower_quantile_is_the_element_at_its_place(spark, share):
    rows = made(3, n=701)
    df = spark.createDataFrame(rows, "g string, x double, id int")
    counted = df.groupBy("g", "x").agg(F.count("*").alias("n_rows"))
    found = {r["g"]: (r["x"], r["n"]) for r in lower_quantile(
        counted, "x", "n_rows", share, ["g"]).collect()}
    for group in {r[0] for r in rows}:
        own = sorted(r[1] for r in rows if r[0] == group)
        place = next(i for i in range(len(own)) if i + 1 >= len(own) * share)
        assert found[group] == (own[place], len(own))


def test_quantile_needs_a_share(spark):
    with pytest.raises(ValueError):
        lower_quantile(spark.range(1), "id", "id", 0.0)


def test_medians_leave_out_missing_numbers(spark):
    rows = [(1.0, None), (3.0, float("nan")), (None, 5.0), (9.0, 7.0), (4.0, 6.0)]
    df = spark.createDataFrame(rows, "size double, flat double")
    found = {r["feature"]: (r["value"], r["n"]) for r in exact_medians(df, ["size", "flat"]).collect()}
    assert found == {"size": (statistics.median_low([1, 3, 9, 4]), 4), "flat": (6.0, 3)}
    assert exact_medians(df.limit(0), ["size"]).collect() == []


def test_medians_of_many_values_shuffle_few(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.gauss(0, 1), float(i % 3), None if i % 5 else -0.0) for i in range(40_000)]
    df = spark.createDataFrame(rows, "many double, few double, gaps double").repartition(5)
    counted = []
    whole = slots_module.lower_quantile
    monkeypatch.setattr(
        slots_module, "lower_quantile", lambda c, *a: counted.append(c.count()) or whole(c, *a))
    found = {r["feature"]: (r["value"], r["n"]) for r in exact_medians(df, df.columns).collect()}
    assert found == {"many": (statistics.median_low([r[0] for r in rows]), 40_000),
                     "few": (1.0, 40_000), "gaps": (0.0, 8_000)}
    assert counted[0] < 200


def test_slots_are_those_of_the_string_indexer(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["r"] * 9 + list("ägbxyz")) if rng.random() < 0.95 else None,
             str(rng.randrange(300))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "colour string, number string")
    slots = saved_slots(df, ["colour", "number"])
    fitted = StringIndexer(inputCols=["colour", "number"], outputCols=["c", "n"],
                           handleInvalid="keep").fit(df)
    later = df.union(spark.createDataFrame([("new", "0"), (None, "x")], df.schema))
    got = attach_slots(later, slots, ["colour", "number"])
    both = fitted.transform(got)
    assert both.filter("c <> colour__index OR n <> number__index").isEmpty()
    assert got.count() == 2002 and got.columns == ["colour", "number", "colour__index", "number__index"]
    counts = Counter(r[0] for r in rows if r[0] is not None)
    ranked = slots.filter("feature = 'colour'").orderBy("slot").collect()
    assert [r["value"] for r in ranked] == sorted(counts, key=lambda v: (-counts[v], v))
    assert {r["width"] for r in ranked} == {len(counts)}


def test_no_task_sees_all_values(spark, plan):
    df = spark.range(5000).selectExpr("cast(id % 1700 as string) AS number")
    ranked = rank_slots(df, ["number"])
    ranked.collect()
    assert "SinglePartition" not in plan(ranked)
    with_slots = attach_slots(df, saved_slots(df, ["number"]), ["number"])
    assert "SinglePartition" not in plan(with_slots)
