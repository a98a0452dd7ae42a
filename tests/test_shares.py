"""Shares, ranks, changes and scores on hand-made rows with nulls and ties."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.operators.ranking import (
    arrival_schedule,
    change_over_time,
    change_text,
    mine_common_patterns,
    top_k_per_group,
    top_k_shares,
)
from lakeops.operators.shares import (
    conditional_share,
    count_by,
    most_frequent,
    share_index,
    share_of_total,
    value_stats,
    weighted_code_score,
)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def groups(spark, text):
    """Rows of (group, category) from words such as ``ax``; ``-`` stands for null."""
    data = [tuple(None if c == "-" else c for c in word) for word in text.split()]
    return spark.createDataFrame(data, "g string, c string")


def test_share_of_total_keeps_the_null_group(spark):
    df = groups(spark, "ax ax b- -x")
    assert rows(share_of_total(df, "g")) == [("a", 50.0), ("b", 25.0), (None, 25.0)]


def test_conditional_share_drops_null_group_and_groups_without_hits(spark):
    df = groups(spark, "ax ax ay b- -x")
    assert rows(conditional_share(df, "g", F.col("c") == "x")) == [("a", 66.67)]


def test_value_stats_ignores_values_that_are_not_positive(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 0), ("a", None), ("b", -1), (None, 2)], "g string, v int")
    got = value_stats(df, "g", F.col("v"), ["avg", "min", "max"])
    assert rows(got) == [("a", 2.0, 1, 3), (None, 2.0, 2, 2)]


def test_score_skips_zero_and_unanswered(spark):
    df = spark.createDataFrame([(1, None), (2, None), (0, None), (None, None)], "p int, q int")
    df = df.withColumn("q", F.col("q").cast("int"))
    assert rows(weighted_code_score(df, ["p", "q"])) == [("p", 0.5)]


def test_share_index_rounds_first_and_shows_one_null_category(spark):
    df = groups(spark, "ax ax by a- b- -x")
    # Overall shares: a 3/6 = 0.5, b 2/6 = 0.33, no group 1/6.
    assert rows(share_index(df, "g", "c")) == sorted(
        [("x", "a", 1.33, 3), ("x", None, None, 3), ("y", "b", 3.03, 1), (None, None, None, 2)],
        key=repr,
    )


def test_share_index_of_a_vanishing_group_is_null(spark):
    df = groups(spark, "ax " * 300 + "bx")
    assert rows(share_index(df, "g", "c")) == [("x", "a", 1.0, 301), ("x", "b", None, 301)]


def test_top_k_keeps_ties_and_null_groups(spark):
    df = groups(spark, "ax ax ay ay az aw aw aw -q b-")
    got = rows(top_k_shares(df, "g", "c", 2).select("g", "c", "cnt", "ranking"))
    assert got == sorted(
        [("a", "w", 3, 1), ("a", "x", 2, 2), ("a", "y", 2, 2), (None, "q", 1, 1), ("b", None, 1, 1)],
        key=repr,
    )


def test_top_k_percentages_of_a_group(spark):
    df = groups(spark, "ax ax ay")
    assert rows(top_k_shares(df, "g", "c", 5)) == [("a", "x", 2, 3, 66.67, 1), ("a", "y", 1, 3, 33.33, 2)]


def test_top_k_values_tie_at_rank_one(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("a", 4, 3), (None, 5, 1)], "g string, id int, v int"
    )
    assert rows(top_k_per_group(df, ["g"], "v", 2)) == sorted(
        [("a", 1, 5, 1), ("a", 2, 5, 1), ("a", 3, 4, 2), (None, 5, 1, 1)], key=repr
    )


def test_patterns_rank_rounded_shares(spark):
    # 301 and 299 of 1000 round to the same share and so share a rank.
    df = groups(spark, "ax " * 301 + "ay " * 299 + "az " * 400 + "-x")
    got = rows(mine_common_patterns(df, "g", ["c"], 2))
    assert got == [("a", "x", 0.3, 2), ("a", "y", 0.3, 2), ("a", "z", 0.4, 1)]


def test_change_is_against_the_previous_present_period(spark):
    data = [("a", 2008), ("a", 2008), ("b", 2008), ("a", 2010), (None, 2010), ("a", 2020), ("a", None)]
    df = spark.createDataFrame(data, "g string, y int")
    got = change_over_time(df, "g", "y", (2008, 2016)).withColumn("text", change_text(F.col("change")))
    assert rows(got) == sorted(
        [
            (2008, "a", 2, 66.67, None, "N/A"),
            (2008, "b", 1, 33.33, None, "N/A"),
            (2010, "a", 1, 50.0, -16.67, "-16.67"),
        ],
        key=repr,
    )


def test_most_frequent_keeps_ties_and_skips_null_keys(spark):
    counts = count_by(groups(spark, "ax ay az az -x b-"), ["g", "c"])
    assert rows(most_frequent(counts, ["g"], "c")) == [("a", "z"), ("b", None)]
    tied = count_by(groups(spark, "ax ay"), ["g", "c"])
    assert rows(most_frequent(tied, ["g"], "c")) == [("a", "x"), ("a", "y")]


def test_schedule_gaps(spark):
    data = [("00:05",), ("00:05",), ("00:09",), ("23:59",), (None,)]
    df = spark.createDataFrame(data, "m string").select(F.to_timestamp("m", "HH:mm").alias("t"))
    expected = [(5, 4), (9, 1430), (1439, None), (None, None)]
    assert rows(arrival_schedule(df, F.col("t"))) == sorted(expected, key=repr)


def test_one_group_holding_most_rows(spark):
    """A third of all rows in one pair, the rest spread over many categories of the same group."""
    df = spark.range(30_000).select(
        F.lit("hot").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.concat(F.lit("c"), F.col("id") % 9_000)).alias("c"),
    )
    expected = Counter(row[0] for row in df.select("c").collect())
    ranks = {count: i + 1 for i, count in enumerate(sorted(set(expected.values()), reverse=True))}
    got = top_k_shares(df, "g", "c", 2).select("c", "cnt", "ranking").collect()
    assert {(r.c, r.cnt, r.ranking) for r in got} == {
        (c, n, ranks[n]) for c, n in expected.items() if ranks[n] <= 2
    }


PAIRS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y", "z", None])),
    min_size=1,
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=PAIRS)
def test_shares_against_plain_counting(spark, data):
    df = spark.createDataFrame(data, "g string, c string")
    got = {row.g: row.percentage for row in share_of_total(df, "g").collect()}
    sizes = Counter(g for g, _ in data)
    assert set(got) == set(sizes)
    assert sum(got.values()) == pytest.approx(100, abs=0.01 * len(got))

    by_group = defaultdict(Counter)
    for g, c in data:
        by_group[g][c] += 1
    expected = set()
    for g, counter in by_group.items():
        kept = sorted(set(counter.values()), reverse=True)[:2]
        expected |= {(g, c, n, kept.index(n) + 1) for c, n in counter.items() if n in kept}
    top = top_k_shares(df, "g", "c", 2).select("g", "c", "cnt", "ranking").collect()
    assert {tuple(row) for row in top} == expected
