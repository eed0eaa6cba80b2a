import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.features import add_cycle, add_schedule_features
from tidemark.operators.history import (
    add_history,
    attach_history,
    coarser_totals,
    day_totals,
    global_prior,
    histories,
    history_columns,
    prior_totals,
    prior_totals_by_range,
    prior_totals_of_rows,
)
from tidemark.operators.running import totals_before_day
from tidemark.operators.splits import (
    add_split,
    class_distribution,
    entity_coverage,
    history_coverage,
    split_frames,
    split_summary,
)
from tidemark.sources.shared import save_shared

DAY = dt.date(2023, 1, 1)
SCHEMA = (
    "flight_key string, flight_date date, carrier string, route string, origin string, "
    "dest string, label double"
)


def golden(spark):
    same = ("AA", "SEA_LAX", "SEA", "LAX")
    later = DAY + dt.timedelta(days=1)
    rows = [("a", DAY, *same, 0.0), ("b", DAY, *same, 1.0), ("c", later, *same, 1.0),
            ("d", later, *same, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed, n=400, days=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        origin, dest = rng.choice("ABC"), rng.choice("DEF")
        # A third of all rows belong to one carrier.
        carrier = "HOT" if i % 3 == 0 else rng.choice(["X", "Y", "Z"])
        day = DAY + dt.timedelta(days=rng.randrange(days))
        rows.append((str(i), day, carrier, f"{origin}_{dest}", origin, dest,
                     float(rng.random() < 0.3)))
    return rows


def expected(rows, keys, row):
    """Count and positives of strictly earlier rows with the same keys, by going through them."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    at = [names.index(k) for k in keys]
    earlier = [r for r in rows if r[1] < row[1] and all(r[i] == row[i] for i in at)]
    return len(earlier), sum(r[-1] for r in earlier)


def test_histories_use_strictly_earlier_dates(spark):
    got = {r["flight_key"]: r for r in add_history(golden(spark)).collect()}
    for key in "ab":
        assert got[key]["hist_carrier_count"] == 0 and got[key]["hist_global_count"] == 0
        assert got[key]["hist_carrier_delay_rate"] == 0.2
        assert got[key]["hist_global_delay_rate"] == 0.2
    for key in "cd":
        assert got[key]["hist_carrier_count"] == 2 and got[key]["hist_global_count"] == 2
        assert got[key]["hist_carrier_delay_rate"] == pytest.approx(0.5, abs=1e-8)
        assert got[key]["hist_global_delay_rate"] == pytest.approx(0.5, abs=1e-8)


@pytest.mark.parametrize("seed", [1, 2])
def test_histories_match_brute_force(spark, seed):
    rows = random_rows(seed)
    got = {r["flight_key"]: r for r in add_history(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for row in rows:
        mine = got[row[0]]
        n, k = expected(rows, [], row)
        rate = k / n if n else 0.2
        assert mine["hist_global_count"] == n
        assert mine["hist_global_delay_rate"] == pytest.approx(rate)
        for entity in spec.ENTITIES:
            n, k = expected(rows, [entity], row)
            assert mine[f"hist_{entity}_count"] == n
            assert mine[f"hist_{entity}_delay_rate"] == pytest.approx((k + 20 * rate) / (n + 20))


def test_saved_histories_are_the_same(spark):
    rows = spark.createDataFrame(random_rows(3), SCHEMA)
    saved = attach_history(rows, histories(rows, save=save_shared))
    lazy = add_history(rows)
    assert saved.exceptAll(lazy).isEmpty() and lazy.exceptAll(saved).isEmpty()


def test_changing_an_outcome_changes_no_earlier_history(spark):
    rows = random_rows(4)
    cut = DAY + dt.timedelta(days=20)
    changed = [(*r[:-1], 1.0 - r[-1]) if r[1] >= cut else r for r in rows]
    columns = history_columns()

    def found(data):
        df = add_history(spark.createDataFrame(data, SCHEMA))
        return {
            r["flight_key"]: tuple(r[c] for c in columns)
            for r in df.filter(F.col("flight_date") <= F.lit(cut)).collect()
        }

    assert found(rows) == found(changed)


def test_row_order_does_not_matter(spark):
    rows = random_rows(5, n=150)
    shuffled = random.Random(0).sample(rows, len(rows))
    one = add_history(spark.createDataFrame(rows, SCHEMA))
    two = add_history(spark.createDataFrame(shuffled, SCHEMA).repartition(3))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_a_null_entity_has_no_history_but_the_others_do(spark):
    rows = [("a", DAY, None, "r", "o", "d", 1.0),
            ("b", DAY + dt.timedelta(days=1), None, "r", "o", "d", 0.0)]
    got = {r["flight_key"]: r for r in add_history(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["b"]["hist_carrier_count"] == 0
    assert got["b"]["hist_carrier_delay_rate"] == pytest.approx(got["b"]["hist_global_delay_rate"])
    assert got["b"]["hist_route_count"] == 1 and got["b"]["hist_global_count"] == 1


def test_row_frame_and_value_frame_agree(spark):
    totals = day_totals(spark.createDataFrame(random_rows(6), SCHEMA), ["route"])
    by_rows = prior_totals(totals, ["route"], "route").fillna(0)
    by_value = prior_totals_by_range(totals, ["route"], "route")
    assert by_rows.exceptAll(by_value).isEmpty() and by_value.exceptAll(by_rows).isEmpty()


def test_coarser_totals_equal_totals_from_rows(spark):
    rows = spark.createDataFrame(random_rows(7), SCHEMA)
    fine = coarser_totals(day_totals(rows, spec.ENTITIES), ["carrier"])
    direct = day_totals(rows, ["carrier"])
    assert fine.exceptAll(direct).isEmpty() and direct.exceptAll(fine).isEmpty()


def test_totals_before_any_day(spark):
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2023, 2, 28),
            dt.date(2024, 2, 29), dt.date(9999, 12, 31)]
    daily = spark.createDataFrame([(d, 10**i) for i, d in enumerate(days)], "d date, n long")
    got = {r["d"]: r["n"] for r in totals_before_day(daily, "d", ["n"]).collect()}
    assert got == {d: (int("1" * i) if i else None) for i, d in enumerate(days)}


def test_plans_need_no_single_task_and_no_python(spark, plan):
    rows = spark.createDataFrame(random_rows(8, n=20), SCHEMA).repartition(3)
    for frame in (add_history(rows), global_prior(day_totals(rows, []), 0.2)):
        text = plan(frame)
        for word in ("SinglePartition", "CartesianProduct", "NestedLoop", "EvalPython"):
            assert word not in text
    # Small histories are broadcast: event rows are not shuffled at all.
    joined = plan(attach_history(rows.select("*"), histories(rows, save=save_shared)))
    assert joined.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in joined
    assert joined.count("hashpartitioning") == 0


def test_splits_are_inclusive_and_do_not_overlap(spark):
    days = [(dt.date(2022, 12, 31), None), (dt.date(2024, 12, 31), "train"),
            (dt.date(2025, 1, 1), "validation"), (dt.date(2025, 6, 30), "validation"),
            (dt.date(2025, 7, 1), "test"), (dt.date(2025, 12, 31), "test"),
            (dt.date(2026, 1, 1), None)]
    df = spark.createDataFrame(days, "flight_date date, expected string")
    split = add_split(df, spec.SplitBounds())
    assert all(r["split"] == r["expected"] for r in split.collect())
    frames = split_frames(df, spec.SplitBounds())
    assert {k: v.count() for k, v in frames.items()} == {"train": 1, "validation": 2, "test": 2}


def test_an_empty_split_fails(spark):
    df = spark.createDataFrame([("train", DAY, 1.0), ("test", DAY, 0.0)],
                               "split string, flight_date date, label double")
    with pytest.raises(Exception, match="split without rows: validation"):
        split_summary(df).collect()


def test_summary_classes_and_coverage(spark):
    bounds = spec.SplitBounds(DAY, DAY + dt.timedelta(days=19), DAY + dt.timedelta(days=29),
                              DAY + dt.timedelta(days=39))
    rows = spark.createDataFrame(random_rows(9), SCHEMA)
    featured = add_split(add_history(rows), bounds)
    found = histories(rows)
    table = add_split(found.daily, bounds)
    from_rows = split_summary(featured)
    from_totals = split_summary(table, label="positives", weight="rows")
    assert from_rows.exceptAll(from_totals).isEmpty()
    assert from_rows.agg(F.sum("row_count")).first()[0] == 400
    shares = class_distribution(from_rows).groupBy("split").agg(F.sum("share").alias("s"))
    assert all(r["s"] == pytest.approx(1.0) for r in shares.collect())
    one = sorted(map(tuple, history_coverage(featured).collect()))
    two = sorted(map(tuple, entity_coverage(found, bounds).collect()))
    assert len(one) == 12
    for a, b in zip(one, two):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_cycles_and_categories(spark):
    df = spark.createDataFrame([(0.0, 360.0, 1, 7)],
                               "crs_dep_minutes double, crs_arr_minutes double, month int, "
                               "day_of_week int")
    row = add_schedule_features(df).first()
    assert (row["sched_dep_time_sin"], row["sched_dep_time_cos"]) == (0.0, 1.0)
    assert row["sched_arr_time_sin"] == pytest.approx(1.0)
    assert (row["month_cat"], row["day_of_week_cat"]) == ("1", "7")
    half = add_cycle(df, "month", "m", 2).first()
    assert half["m_cos"] == pytest.approx(-1.0)


def test_a_hot_group_is_split_when_rows_meet_their_histories(spark):
    """A third of all rows share one day and one set of entities."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.col("id") % 3 == 0
        rows = spark.range(0, 60000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("flight_key"),
            F.date_add(F.lit(DAY), F.when(hot, 5).otherwise(F.col("id") % 50).cast("int")).alias(
                "flight_date"
            ),
            *[
                F.when(hot, "HOT").otherwise((F.col("id") % 40).cast("string")).alias(name)
                for name in spec.ENTITIES
            ],
            (F.col("id") % 4 == 0).cast("double").alias("label"),
        )
        found = histories(rows, save=save_shared)
        joined = attach_history(rows, found)
        assert len(joined.select("flight_key", "hist_carrier_count").collect()) == 60000
        collected = attach_history(rows, found)
        collected.collect()
        text = collected._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# --- the frame over the rows themselves ---


def _plain_earlier(rows):
    return sorted(
        (key, day, label, sum(r[2] for r in earlier), len(earlier))
        for key, day, label in rows
        for earlier in [[r for r in rows if r[0] == key and r[1] < day]]
    )


@pytest.mark.parametrize("block_days", [1, 4, 16, 1000])
def test_frame_over_rows_equals_a_plain_sum(spark, block_days):
    rng = random.Random(block_days)
    start = dt.date(1969, 12, 1)
    rows = [
        ("hot" if i % 3 == 0 else rng.choice("abcd"),
         start + dt.timedelta(days=rng.randrange(90)), float(rng.random() < 0.4))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "route string, flight_date date, label double")
    found = prior_totals_of_rows(df, ["route"], "route", block_days=block_days)
    got = sorted(map(tuple, found.collect()))
    assert got == _plain_earlier(rows)


def test_frame_over_rows_equals_day_totals_joined(spark):
    rng = random.Random(8)
    rows = [(rng.choice("xyz"), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)),
             float(rng.random() < 0.5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "route string, flight_date date, label double, id int")
    by_rows = prior_totals_of_rows(df, ["route"], "route", save=save_shared)
    totals = prior_totals(day_totals(df, ["route"]), ["route"], "route")
    joined = df.join(totals, ["route", "flight_date"]).fillna(
        0, ["hist_route_positives", "hist_route_count"]).select(by_rows.columns)
    assert by_rows.exceptAll(joined).isEmpty() and joined.exceptAll(by_rows).isEmpty()


def test_frame_over_rows_with_nulls(spark):
    rows = [(None, dt.date(2024, 1, 1), 1.0), (None, dt.date(2024, 3, 1), 0.0),
            ("a", None, 1.0), ("a", dt.date(2024, 1, 5), 1.0), ("a", dt.date(2024, 1, 6), 0.0)]
    df = spark.createDataFrame(rows, "route string, flight_date date, label double")
    found = {(r[0], r[1]): (r[3], r[4])
             for r in prior_totals_of_rows(df, ["route"], "route").collect()}
    assert found[None, dt.date(2024, 3, 1)] == (1, 1)
    assert found["a", None] == (0, 0)


def test_a_hot_key_is_never_one_sorted_partition(spark, plan):
    """One key on a third of the rows: the rows are dealt by key and block of days."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("route"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 700).cast("int")).alias("flight_date"),
        (F.col("id") % 2).cast("double").alias("label"),
    )
    found = prior_totals_of_rows(df, ["route"], "route", save=save_shared)
    found.collect()
    text = plan(found)
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line and "route__of_block" not in line:
            assert "route__block" in line
    sizes = df.groupBy("route", F.floor(F.unix_date("flight_date") / 16)).count()
    assert sizes.agg(F.max("count")).first()[0] < 50 < df.filter("route = 'hot'").count()
