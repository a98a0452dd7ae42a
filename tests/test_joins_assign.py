"""Size-checked joins and weighted assignment."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.functions.numbers import uniform
from lakeops.operators.assign import cumulative_weights, weighted_assign
from lakeops.operators.joins import fits_broadcast, join_dimension, join_groups
from lakeops.plans import survey as survey_plans
from lakeops.plans.values import BOROUGHS


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture()
def facts(spark):
    return spark.createDataFrame(
        [(1, "a", "X"), (1, "a", "X"), (2, "a", None), (3, None, "x"), (4, "b", "y"), (5, "zz", "y")],
        "id int, k string, m string",
    )


@pytest.fixture()
def dimension(spark):
    return spark.createDataFrame([("a", "x", 10), ("b", "Y", 20), ("b", "Y", 21), (None, "x", 30)], "dk string, dm string, w int")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
@pytest.mark.parametrize("max_rows", [1000, 0])
def test_both_join_ways_agree(spark, facts, dimension, how, max_rows):
    got = join_dimension(facts, dimension, {"k": "dk", "m": "dm"}, how, ["m"], max_rows=max_rows)
    expected = {
        "left": [
            (1, "a", "X", "a", "x", 10), (1, "a", "X", "a", "x", 10), (2, "a", None, None, None, None),
            (3, None, "x", None, None, None), (4, "b", "y", "b", "Y", 20), (4, "b", "y", "b", "Y", 21),
            (5, "zz", "y", None, None, None),
        ],
        "inner": [
            (1, "a", "X", "a", "x", 10), (1, "a", "X", "a", "x", 10), (4, "b", "y", "b", "Y", 20),
            (4, "b", "y", "b", "Y", 21),
        ],
        "left_anti": [(2, "a", None), (3, None, "x"), (5, "zz", "y")],
    }[how]
    assert rows(got) == sorted(expected, key=repr)


@pytest.fixture()
def small_limits(spark):
    """Adaptive execution with limits small enough to show on test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("how", ["left", "left_anti"])
@pytest.mark.parametrize("hot", ["7", None])
def test_hot_key_of_a_shuffled_join_is_split(spark, small_limits, how, hot):
    """A third of the facts share one key (or have none) and the dimension is not broadcast."""
    ids = spark.range(0, 60_000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise((F.col("id") % 5000).cast("string"))
    facts = ids.select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    dimension = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("dk"), F.lit(1).alias("w"))
    joined = join_dimension(facts, dimension, {"k": "dk"}, how, max_rows=0)
    keys = joined.select("k", "payload").collect()
    plan = joined.select("k", "payload")
    plan.collect()
    assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    total = {"left": 60_000, "left_anti": sum(
        1 for i in range(60_000)
        if (hot if i % 3 == 0 else str(i % 5000)) is None
        or int(hot if i % 3 == 0 else i % 5000) % 2
    )}[how]
    assert len(keys) == total


def test_broadcast_needs_a_measured_size(spark):
    wide = spark.range(2000).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(wide)
    assert not fits_broadcast(wide, max_rows=1999)
    assert not fits_broadcast(wide, max_bytes=1_000_000)


def test_join_groups_matches_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, t int")
    assert rows(join_groups(left, right, ["k"])) == [("a", 1, 10), (None, 2, 20)]
    assert rows(join_groups(left, right, ["k"], nulls_match=False)) == [("a", 1, 10)]


def test_unsupported_join_type(facts, dimension):
    with pytest.raises(ValueError):
        join_dimension(facts, dimension, {"k": "dk"}, "right")


def test_cumulative_weights_and_compat(spark):
    df = spark.createDataFrame([(20.0, 30.0, 50.0), (20.0, None, 50.0)], "a double, b double, c double")
    assert cumulative_weights(df, ["a", "b", "c"]).collect() == [(0.2, 0.5, 1.0), (0.2, 0.2, 0.7)]
    # Carried sums: 0.2, (0.2 + 30) / 100 = 0.302, (0.302 + 50) / 100 = 0.50302, then added up.
    first, second = cumulative_weights(df, ["a", "b", "c"], compat=True).collect()
    assert tuple(first) == pytest.approx((0.2, 0.502, 1.00502))
    assert tuple(second) == pytest.approx((0.2, 0.2, 0.2))


def test_uniform_range_and_spread(spark):
    draws = spark.range(20_000).select(uniform(3, F.col("id")).alias("u"))
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.001 and 0.999 < high < 1 and mean == pytest.approx(0.5, abs=0.01)


def test_assignment_repeats_after_repartition_and_follows_weights(spark):
    weights = {"a": "wa", "b": "wb", "c": "wc"}
    df = spark.range(20_000).select("id", F.lit(0.5).alias("wa"), F.lit(0.8).alias("wb"), F.lit(1.0).alias("wc"))

    def labels(frame):
        drawn = weighted_assign(frame, weights, "label", seed=5, key=["id"])
        return {row.id: row.label for row in drawn.select("id", "label").collect()}

    first = labels(df)
    assert first == labels(df.repartition(7))
    share = {label: n / len(first) for label, n in Counter(first.values()).items()}
    # 10 % are spread evenly over the three labels.
    assert share["a"] == pytest.approx(0.9 * 0.5 + 0.1 / 3, abs=0.015)
    assert share["b"] == pytest.approx(0.9 * 0.3 + 0.1 / 3, abs=0.015)


def test_assignment_needs_a_key(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("wa"), F.lit(1.0).alias("wb"))
    drawn = weighted_assign(df, {"a": "wa", "b": "wb"}, "label", seed=5, key=["id"], explore=0.0)
    assert {row.label for row in drawn.collect()} == {"a"}
    with pytest.raises(ValueError):
        weighted_assign(df, {"a": "wa", "b": "wb"}, "label", seed=5, key=[])


def test_borough_job_without_weights_is_unknown_unless_explored(spark):
    survey = spark.range(3000).select("id", F.lit("DRUG_OFFENSE").alias("OFFENSE_TYPE"), F.when(F.col("id") % 2 == 0, "WHITE").alias("RACE"))
    names = ", ".join(f"`{b}_cumulative_prob` double" for b in BOROUGHS)
    weights = spark.createDataFrame(
        [("DRUG_OFFENSE", "WHITE", 100.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
        f"PD_DESC_Mapped string, SUSP_RACE_Mapped string, {names}",
    )
    drawn = survey_plans.add_borough(survey, weights, seed=1, key=["id"])
    assert drawn.columns == ["OFFENSE_TYPE", "RACE", "BOROUGH"]
    counts = {(r.RACE, r.BOROUGH): r["count"] for r in drawn.groupBy("RACE", "BOROUGH").count().collect()}
    assert counts[("WHITE", "BRONX")] > 1300
    assert counts[(None, "UNKNOWN")] > 1300
    assert sum(counts.values()) == 3000


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_a_dimension_judged_large_is_merged(spark, facts, dimension, how):
    joined = join_dimension(facts, dimension, {"k": "dk"}, how, max_rows=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_neighbouring_seeds_and_null_places_draw_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    got = df.select(uniform(7, a, b, draw=1), uniform(8, a, b), uniform(8, a, b, draw=1)).collect()
    assert len({value for row in got for value in row}) == 6
