"""Sessions, frames, groupings, sketches and table layouts against plain versions, with hot keys."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fixtures.inputs import table
from fixtures.time_queries import TIME_QUERIES
from lakeops.operators import frames, sketches
from lakeops.operators.cubes import grouping_totals
from lakeops.operators.sessions import sessions
from lakeops.sources import layout
from lakeops.streaming.windows import flatten_window, session_counts
from parity import SF_DIR

START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def timed(seed=1, n=500):
    """A key with most rows, rows close and far apart, and rows without key, time or gap."""
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 6 + ["a", "b", None])
    rows = [(key(), draw.choice([None] + list(range(0, 4000, 3)) * 2), draw.choice([2, 10, 10, 600, 0, None])) for _ in range(n)]
    # A chain over many slices, one reach over several, and exactly touching ones.
    rows += [("chain", m, 10) for m in range(0, 900, 10)] + [("long", 0, 900), ("long", 500, 1), ("long", 900, 5), ("long", 906, 5)]
    return rows


def plain_sessions(rows):
    found = []
    for key in {k for k, _, _ in rows}:
        reaches = sorted((t, t + g) for k, t, g in rows if k == key and t is not None and g is not None and g > 0)
        for start, end in reaches:
            if found and found[-1][0] == key and start <= found[-1][2]:
                found[-1][2] = max(found[-1][2], end)
                found[-1][3] += 1
            else:
                found.append([key, start, end, 1])
    return ordered((k, at(s), at(e), n) for k, s, e, n in found)


@pytest.mark.parametrize("slice", ["10 minutes", "1 hour", "30 days"])
def test_sessions(spark, slice):
    rows = timed()
    frame = spark.createDataFrame([(k, None if t is None else at(t), g) for k, t, g in rows], "k string, t timestamp, g int")
    gap = F.concat(F.col("g").cast("string"), F.lit(" minutes"))
    found = sessions(frame.repartition(4), ["k"], "t", gap, slice=slice)
    assert found.columns == ["k", "window_start", "window_end", "cnt"]
    assert ordered(found.collect()) == plain_sessions(rows)
    assert sessions(frame.where("false"), ["k"], "t", gap).count() == 0
    # The plain aggregate of a stream's operator gives the same.
    counts = flatten_window(session_counts(frame, "t", gap, ["k"])).select("k", "window_start", "window_end", "cnt")
    assert ordered(counts.collect()) == plain_sessions(rows)


def test_sessions_merge_a_hot_key_only_at_the_ends_of_slices(spark):
    frame = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 30).alias("t"))
    whole = sessions(frame, ["k"], "t", "1 minute", slice="1 hour")
    assert [r.cnt for r in whole.collect()] == [20_000]
    apart = sessions(frame, ["k"], "t", "20 seconds", slice="1 hour")
    assert apart.count() == 20_000
    text = plan_of(apart)
    assert "__slice" in text and "Python" not in text and "NestedLoop" not in text


def numbered(seed=2, n=400):
    draw = random.Random(seed)
    return [
        (i, draw.choice(["hot"] * 5 + ["a", "b", None]), draw.choice([None] + list(range(80)) * 2), draw.choice([None, 1, 2, -5]))
        for i in range(n)
    ] + [(n + i, "hot", 40, 1) for i in range(n // 2)]


BOUNDS = [{}, {"slice_rows": 10, "slices": 4}, {"slice_rows": 1, "slices": 32}]


@pytest.mark.parametrize("bounds", BOUNDS)
def test_running_sums(spark, bounds):
    rows = numbered()
    frame = spark.createDataFrame(rows, "i int, k string, t int, v int").repartition(3)
    low = lambda t: -1 if t is None else t
    expected = []
    for i, k, t, v in rows:
        some = [w for _, q, u, w in rows if q == k and low(u) <= low(t) and w is not None]
        expected.append((i, k, t, v, sum(some) if some else None))
    assert ordered(frames.running_sums(frame, ["k"], "t", "v", **bounds).collect()) == ordered(expected)
    assert frames.running_sums(frame.where("false"), ["k"], "t", "v", **bounds).count() == 0


@pytest.mark.parametrize("back", [0, 3, 50])
@pytest.mark.parametrize("bounds", BOUNDS)
def test_moving_sums(spark, bounds, back):
    rows = numbered(3)
    frame = spark.createDataFrame(rows, "i int, k string, t int, v int").repartition(3)
    expected = []
    for i, k, t, v in rows:
        near = [w for _, q, u, w in rows if q == k and ((t is None and u is None) or (None not in (t, u) and t - back <= u <= t))]
        some = [w for w in near if w is not None]
        expected.append((i, k, t, v, sum(some) if some else None, len(near)))
    found = frames.moving_sums(frame, ["k"], "t", "v", back, count="n", **bounds)
    assert ordered(found.collect()) == ordered(expected)


def test_frames_cut_a_hot_key(spark):
    frame = spark.range(30_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(1).cast("long").alias("v"))
    found = frames.running_sums(frame, ["k"], "t", "v", slice_rows=1000, slices=30)
    assert found.where("total = t + 1").count() == 30_000
    moving = frames.moving_sums(frame, ["k"], "t", "v", 9, slice_rows=1000, slices=30)
    assert moving.where("total = least(t + 1, 10)").count() == 30_000
    assert "__slice" in plan_of(moving)


def test_frames_leave_rows_of_equal_order_where_they_are(spark):
    """Frames run over one sum for each place in order; a day of many rows never fills a task."""
    frame = spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") % 2).alias("t"), F.lit(1).alias("v"), F.lit("x").alias("total"))
    for found in (
        frames.running_sums(frame, ["k"], "t", "v", slice_rows=1, slices=4),
        frames.moving_sums(frame, ["k"], "t", "v", 1, count="n", slice_rows=1, slices=4),
    ):
        assert found.columns[:4] == ["k", "t", "v", "total"] and found.where("total = 20000 * (t + 1)").count() == 40_000
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 40_000 and max(tasks) <= 10_000


def test_frames_merge_many_steps(spark, monkeypatch):
    rows = numbered(4)
    frame = spark.createDataFrame(rows, "i int, k string, t int, v int").repartition(3)
    for run in (lambda: frames.running_sums(frame, ["k"], "t", "v", slice_rows=10, slices=4), lambda: frames.moving_sums(frame, ["k"], "t", "v", 3, count="n")):
        with monkeypatch.context() as patch:
            patch.setattr(frames, "fits_broadcast", lambda steps: False)
            merged = run()
        assert "SortMergeJoin" in plan_of(merged)
        assert ordered(merged.collect()) == ordered(run().collect())


def test_frames_keep_types_of_sums(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("t"), (F.col("id") / 4).cast("decimal(30,2)").alias("d"))
    for found in (frames.running_sums(rows, ["k"], "t", "d", slice_rows=2, slices=3), frames.moving_sums(rows, ["k"], "t", "d", 9, slice_rows=2, slices=3)):
        assert found.schema["total"].dataType.simpleString() == "decimal(38,2)"
        assert found.groupBy("k").agg(F.max("total").alias("m")).join(rows.groupBy("k").agg(F.sum("d").alias("s")), "k").where("m = s").count() == 3


def test_groupings_expand_counts_only(spark):
    """The cube multiplies counts, not rows, and tells null keys from left out ones."""
    frame = spark.range(10_000).select(
        F.when(F.col("id") % 3 > 0, "hot").alias("a"), (F.col("id") % 2).alias("b"), F.lit(2).alias("v")
    )
    found = grouping_totals(frame, ["a", "b"], sums={"total": "v"})
    rows = {(r.a, r.b, r.grouping_id): (r.cnt, r.total) for r in found.collect()}
    assert len(rows) == 4 + 2 + 2 + 1 and rows[(None, None, 3)] == (10_000, 20_000)
    assert rows[(None, None, 1)][0] == 3334 and rows[("hot", None, 1)][0] == 6666
    text = plan_of(found).split("== Initial Plan ==")[-1]
    assert text.index("Expand") < text.rindex("HashAggregate") and text.count("Exchange") >= 2
    assert text.rindex("Exchange") > text.index("Expand")  # rows are combined and exchanged below
    with pytest.raises(ValueError):
        grouping_totals(frame, ["a"], [["zzz"]])
    assert grouping_totals(frame.where("false"), ["a", "b"], [["a"]]).count() == 0


def test_sketches_are_near_and_merge(spark):
    frame = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise((F.col("id") % 9000).cast("string")).alias("who"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 10_007).cast("double")).otherwise(F.lit(float("nan"))).alias("x"),
    )
    daily = sketches.sketch(frame, ["day"], "who", "x")
    whole = sketches.estimates(sketches.merged(daily), {"median": 0.5, "p99": 0.99}).first()
    exact = frame.agg(F.countDistinct("who")).first()[0]
    values = sorted(r.x for r in frame.where("NOT isnan(x)").select("x").collect())
    assert whole.n == 60_000 and abs(whole.n_distinct - exact) <= 0.05 * exact
    rank = lambda v: sum(x <= v for x in values) / len(values)
    assert abs(rank(whole.median) - 0.5) < 0.03 and abs(rank(whole.p99) - 0.99) < 0.03
    # Many merged sketches are as near as one over all rows, and sketches do not grow with the rows.
    sizes = daily.select(F.length("distinct_sketch") + F.length("number_sketch")).collect()
    assert max(r[0] for r in sizes) < 20_000
    once = sketches.estimates(sketches.sketch(frame, [], "who", "x"), {"median": 0.5}).first()
    assert abs(once.n_distinct - exact) <= 0.05 * exact and abs(rank(once.median) - 0.5) < 0.03
    empty = sketches.sketch(spark.sql("SELECT 1 AS day, CAST(NULL AS string) AS who, CAST('NaN' AS double) AS x"), ["day"], "who", "x")
    assert tuple(sketches.estimates(empty, {"median": 0.5}).first()) == (1, 1, 0, None)
    assert statistics.median(values) > 0


def test_bucketed_tables_join_without_exchange(spark):
    items = table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_quantity")
    orders = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderstatus")
    names = layout.write_bucketed(items, ["l_orderkey"], 4), layout.write_bucketed(orders, ["o_orderkey"], 4)
    try:
        left, right = (spark.table(n) for n in names)
        joined = left.join(right.hint("merge"), left.l_orderkey == right.o_orderkey)
        per_order = joined.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
        text = plan_of(per_order)
        assert "SortMergeJoin" in text and "Exchange" not in text and "SelectedBucketsCount: 4 out of 4" in text
        plain = items.join(orders, items.l_orderkey == orders.o_orderkey).groupBy("l_orderkey").agg(F.sum("l_quantity"))
        assert ordered(per_order.collect()) == ordered(plain.collect())
    finally:
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_partitioned_table_reads_its_folders_only(spark, tmp_path):
    path = f"{tmp_path}/orders"
    orders = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    layout.write_partitioned(orders, path, ["o_orderstatus", "yr"], rows_per_file=100)
    found = layout.read_partition(spark, path, o_orderstatus="F", yr=1997)
    text = plan_of(found)
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text and "PushedFilters: []" in text
    assert ordered(found.collect()) == ordered(orders.where("o_orderstatus = 'F' AND yr = 1997").collect())
    assert layout.read_partition(spark, path).count() == orders.count()


def test_queries_have_no_python_and_no_nested_loop(spark):
    for name in ("as_of_orders_within", "range_join_merged", "sessions_of_users", "cube_of_lines", "running_quantity"):
        text = plan_of(TIME_QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text
