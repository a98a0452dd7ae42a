"""As-of and range joins, joined streams and alerts against plain versions, with hot keys and restarts."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from fixtures.time_queries import held_events, latest_orders
from lakeops.operators import ranges as ranges_module
from lakeops.operators.asof import as_of_join
from lakeops.operators.ranges import range_join
from lakeops.session import ROCKSDB
from lakeops.streaming import runs
from lakeops.streaming.alerts import running_alerts
from lakeops.streaming.joins import drop_repeats, join_streams
from parity import SF_DIR

START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# As-of joins.


def sides(spark, seed=1, n=400):
    """A key with most rows, ties in time, rows without key or time, and keys of one side only."""
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 6 + ["a", "b", "c", None])
    time = lambda: draw.choice([None] + list(range(60)) * 2)
    left = [(i, key(), time()) for i in range(n)] + [(n + i, "hot", 30) for i in range(n)]
    right = [(key(), time(), draw.choice([None, 1, 2, 3]), draw.choice("xyz")) for _ in range(n // 4)]
    left += [(-1, "left only", 5)]
    right += [("right only", 5, 1, "x")]
    return (
        left, right,
        spark.createDataFrame(left, "id int, k string, t int").repartition(3),
        spark.createDataFrame(right, "k2 string, t2 int, v int, w string").repartition(3),
    )


def latest(left, right, strict=False, within=None):
    # Nulls come first in Spark's order of values.
    value = lambda r: (r[2] is not None, r[2] or 0, r[3])
    for i, k, t in left:
        fit = [r for r in right if None not in (k, t) and r[0] == k and r[1] is not None and (r[1] < t if strict else r[1] <= t)]
        best = max(fit, key=lambda r: (r[1], value(r)), default=None)
        if best is not None and within is not None and best[1] < t - within:
            best = None
        yield (i, k, t, *(best[2:] if best else (None, None)))


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("bounds", [{}, {"slice_rows": 5, "slices": 4}, {"slice_rows": 1, "slices": 16}])
def test_as_of_join(spark, strict, bounds):
    left, right, a, b = sides(spark)
    found = as_of_join(a, b, {"k": "k2"}, ("t", "t2"), ["v", "w"], strict=strict, **bounds)
    assert found.columns == ["id", "k", "t", "v", "w"]
    assert ordered(found.collect()) == ordered(latest(left, right, strict))
    for x, y in ((a.where("false"), b), (a, b.where("false"))):
        assert as_of_join(x, y, {"k": "k2"}, ("t", "t2"), ["v", "w"], **bounds).where("v IS NOT NULL").count() == 0


@pytest.mark.parametrize("slice_rows", [5, 10**6])
def test_as_of_join_within(spark, slice_rows):
    left, right, a, b = sides(spark, 2)
    a, b = (df.withColumn(c, F.timestamp_seconds(F.col(c) * 60)) for df, c in ((a, "t"), (b, "t2")))
    found = as_of_join(a, b, {"k": "k2"}, ("t", "t2"), ["v", "w"], within="3 minutes", slice_rows=slice_rows, slices=8)
    found = found.withColumn("t", (F.unix_seconds("t") / 60).cast("int"))
    assert ordered(found.collect()) == ordered(latest(left, right, within=3))


def test_as_of_join_cuts_a_hot_key(spark):
    """No task sweeps more of a hot key than a range of it, and rows at one instant are swept once."""
    left = spark.range(30_000).select(F.lit("hot").alias("k"), (F.col("id") % 3000).alias("t"), "id")
    right = spark.range(3000).select(F.lit("hot").alias("k2"), F.col("id").alias("t2"), (F.col("id") * 2).alias("v"))
    found = as_of_join(left, right, {"k": "k2"}, ("t", "t2"), ["v"], slice_rows=1000, slices=30)
    assert found.where("v = 2 * t").count() == 30_000
    text = plan_of(found)
    assert "__slice" in text and "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    whole = latest_orders(spark, SF_DIR)
    assert ordered(whole.collect()) == ordered(latest_orders(spark, SF_DIR, slice_rows=10, slices=5).collect())


def test_as_of_join_rejects_what_it_cannot_do(spark):
    _, _, a, b = sides(spark, n=4)
    with pytest.raises(ValueError):
        as_of_join(a, b.withColumnRenamed("v", "id"), {"k": "k2"}, ("t", "t2"), ["id"])


# Range joins.


def bands(spark, seed=3):
    draw = random.Random(seed)
    ranges = []
    for i in range(150):
        low = draw.choice([None, draw.uniform(-50, 50)])
        size = draw.choice([0, 1e-6, 0.5, 3, 200, -1])
        high = draw.choice([None, (low if low is not None else draw.uniform(-50, 50)) + size])
        ranges.append((i, draw.choice(["a", "b", None]), low, high))
    ranges += [(500, "a", 7.0, 9.0)] * 2 + [(501, "a", -math.inf, 3.0), (502, "b", 1.0, math.inf), (503, "a", 4.0, 4.0)]
    points = [(i, draw.choice(["a", "a", "b", "c", None]), draw.choice([draw.uniform(-60, 60), 7.0, 9.0, None])) for i in range(300)]
    points += [(900, "a", math.inf), (901, "a", -math.inf), (902, "b", math.nan)]
    return (
        ranges, points,
        spark.createDataFrame(ranges, "r int, rk string, low double, high double").repartition(2),
        spark.createDataFrame(points, "id int, k string, x double").repartition(3),
    )


def holding(ranges, points, keyed):
    for i, k, x in points:
        for r, rk, low, high in ranges:
            if x is None or math.isnan(x) or (keyed and (k is None or k != rk)):
                continue
            if (low is None or low <= x) and (high is None or x < high) and not (low is not None and high is not None and low >= high):
                yield i, k, x, r


@pytest.mark.parametrize("max_rows", [0, 10**6])
@pytest.mark.parametrize("keyed", [True, False])
def test_range_join(spark, keyed, max_rows):
    ranges, points, a, b = bands(spark)
    options = {"on": {"k": "rk"} if keyed else None, "columns": ["r"], "max_rows": max_rows}
    found = range_join(b, a, "x", ("low", "high"), **options)
    expected = list(holding(ranges, points, keyed))
    assert ordered(found.collect()) == ordered(expected)
    text = plan_of(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    hit = {i for i, *_ in expected}
    semi = range_join(b, a, "x", ("low", "high"), how="left_semi", key=["id"], **(options | {"columns": []}))
    assert {r.id for r in semi.collect()} == hit
    left = range_join(b, a, "x", ("low", "high"), how="left", key=["id"], **options)
    alone = [(i, k, x, None) for i, k, x in points if i not in hit]
    assert list(map(repr, ordered(left.collect()))) == list(map(repr, ordered([*expected, *alone])))  # NaN among them
    assert range_join(b, a.where("false"), "x", ("low", "high"), **options).count() == 0
    assert range_join(b.where("false"), a, "x", ("low", "high"), **options).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_range_join_of_times(spark, kind):
    days = spark.range(60).select(F.col("id").cast("int").alias("id"), F.expr(f"cast(timestampadd(DAY, cast(id AS int), TIMESTAMP'2024-02-20 00:00:00') AS {kind}) AS x"))
    spans = days.where("id % 7 = 0").select(F.col("id").alias("r"), F.col("x").alias("low"), F.expr(f"cast(timestampadd(DAY, 1 + r * 2, cast(x AS timestamp)) AS {kind})").alias("high"))
    found = {(r.id, r.r) for r in range_join(days, spans, "x", ("low", "high"), columns=["r"]).select("id", "r").collect()}
    assert found == {(i, r) for i in range(60) for r in range(0, 60, 7) if r <= i < r + 1 + 2 * r}


def test_range_join_of_a_hot_bucket(spark):
    """One long range among short ones costs few buckets, and all points may share a bucket."""
    ranges = spark.range(1000).select(F.col("id").alias("r"), (F.col("id") * 10).cast("double").alias("low"), (F.col("id") * 10 + 1).cast("double").alias("high"))
    ranges = ranges.unionAll(spark.sql("SELECT 5000L, 0.0D, 1e9D"))
    points = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 20.5).otherwise(F.col("id") / 2).alias("x"))
    found = range_join(points, ranges, "x", ("low", "high"), columns=["r"], max_rows=0)
    expected = sum(1 + (math.floor(x) % 10 == 0) for x in (20.5 if i % 3 == 0 else i / 2 for i in range(20_000)))
    assert found.count() == expected
    assert held_events(spark, SF_DIR, max_rows=0).count() == held_events(spark, SF_DIR).count()


@pytest.mark.parametrize("max_rows", [0, 10**6])
@pytest.mark.parametrize("keyed", [True, False])
def test_range_join_in_blocks(spark, keyed, max_rows):
    """Buckets cut into blocks give the same rows, exact copies and null keys included."""
    ranges, points, a, b = bands(spark, 5)
    ranges, points = ranges + ranges[:40], points + points[:60]
    a, b = a.unionAll(a.limit(0)), b.unionAll(b.limit(0))
    a, b = spark.createDataFrame(ranges, a.schema).repartition(2), spark.createDataFrame(points, b.schema).repartition(3)
    options = {"on": {"k": "rk"} if keyed else None, "columns": ["r"], "max_rows": max_rows, "task_pairs": 50, "block_side": 4}
    found = range_join(b, a, "x", ("low", "high"), **options)
    assert list(map(repr, ordered(found.collect()))) == list(map(repr, ordered(holding(ranges, points, keyed))))
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    wide = range_join(b.withColumn("k2", F.col("k")), a.withColumn("rk", F.col("rk").cast("char(1)")), "x", ("low", "high"), **options | {"on": {"k": "rk"}})
    assert wide.count() == len(list(holding(ranges, points, True)))


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_range_join_deals_pairs_to_tasks(spark, max_rows):
    """Few rows that all meet in one bucket are joined by many tasks."""
    points = spark.range(0, 3000, 1, 1).select("id", F.lit(5.0).alias("x"))
    ranges = spark.range(0, 400, 1, 1).select(F.col("id").alias("r"), F.lit(4.0).alias("low"), (F.lit(6.0) + F.col("id") / 1000).alias("high"))
    found = range_join(points, ranges, "x", ("low", "high"), columns=["r"], max_rows=max_rows, task_pairs=20_000, block_side=100)
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 3000 * 400 and len(tasks) > 30 and max(tasks) < 200_000
    assert found.distinct().count() == 3000 * 400


def test_range_join_leaves_out_ranges_beyond_all_points(spark):
    """Ranges before the first and behind the last point are not measured, nor dealt; open and NaN bounds stay."""
    odd = [(-1, None, 5.0), (-2, 5.0, None), (-3, -math.inf, 1.0), (-4, 1.0, math.inf), (-5, 0.0, math.nan), (-6, math.nan, 9.0), (-7, None, None)]
    near = [(i, float(i), i + 1.5) for i in range(10)]
    far = spark.range(20, 5000).selectExpr("cast(id AS int) AS r", "cast(id * 7 AS double) AS low", "id * 7 + 3.0D AS high")
    far = far.unionAll(far.selectExpr("-r - 100", "-high", "-low"))
    points = spark.createDataFrame([(i, i / 3) for i in range(30)] + [(90, None), (91, math.nan)], "id int, x double")
    ranges = far.unionAll(spark.createDataFrame(odd + near, "r int, low double, high double"))
    found = range_join(points, ranges, "x", ("low", "high"), columns=["r"], max_rows=200)
    expected = [(i, r) for i in range(30) for r, low, high in odd + near
                if (low is None or low <= i / 3) and (high is None or i / 3 < high or math.isnan(high))]
    assert sorted((r.id, r.r) for r in found.collect()) == sorted(expected)
    assert "BroadcastHashJoin" in plan_of(found)  # 9,977 ranges as given would be merged
    ends = points.unionAll(spark.createDataFrame([(92, math.inf), (93, -math.inf)], points.schema))
    merged = range_join(ends, ranges, "x", ("low", "high"), columns=["r"], max_rows=200)
    more = [(92, -2), (92, -5), (92, -7), (93, -1), (93, -3), (93, -7)]  # NaN is beyond infinity
    assert sorted((r.id, r.r) for r in merged.collect()) == sorted(expected + more)
    assert range_join(points.where("id > 89"), ranges, "x", ("low", "high"), columns=["r"]).count() == 0


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_range_join_compares_few_pairs_in_vain(spark, max_rows, monkeypatch):
    """Where many pairs meet, buckets get finer: less than twice the pairs of the result are dealt out."""
    points = spark.range(0, 4000).selectExpr("id", "pmod(id * 7919, 4000) / 40.0D AS x")
    ranges = spark.range(0, 600).selectExpr("id AS r", "pmod(id * 131, 600) / 6.0D AS low", "pmod(id * 131, 600) / 6.0D + 2 + id % 13 AS high")
    dealt = []
    counted = ranges_module._pairs
    monkeypatch.setattr(ranges_module, "_pairs", lambda counts: dealt.append(counted(counts)[0]) or (dealt[-1], 1))
    found = range_join(points, ranges, "x", ("low", "high"), columns=["r"], max_rows=max_rows, task_pairs=10_000, block_side=50).count()
    expected = sum(low <= i / 40 < low + 2 + r % 13 for i in range(4000) for r in range(600) for low in [r * 131 % 600 / 6])
    assert found == expected
    assert dealt[-1] < 2 * found < dealt[0]


# Streams.


class Feed:
    """A folder that a stream reads, one micro-batch after the other, restarted each time."""

    def __init__(self, spark, folder, schema):
        self.spark, self.schema, self.folder = spark, schema, str(folder)
        self.n = 0

    def add(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def read(self):
        return self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/in")

    def run(self, result):
        query = runs.run_stream(result, runs.folder_sink(f"{self.folder}/out"), f"{self.folder}/check", "append", available_now=True)
        query.awaitTermination()
        self.state = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
        return ordered(runs.read_appended(self.spark, f"{self.folder}/out", result.schema).collect())


def joined(rows, how="inner", salts=1):
    left = rows.where("kind = 'l'").select(F.col("id").alias("lid"), F.col("k").alias("lk"), F.col("t").alias("lt"))
    right = rows.where("kind = 'r'").select(F.col("id").alias("rid"), F.col("k").alias("rk"), F.col("t").alias("rt"))
    found = join_streams(left, right, {"lk": "rk"}, ("lt", "rt"), ("-10 minutes", "30 minutes"), ("1 hour", "1 hour"), how, salts)
    return found.select(*[c for c in ("lid", "rid") if c in found.columns])


EVENTS = "id int, kind string, k string, t timestamp"


@pytest.mark.parametrize("salts", [1, 3])
def test_joined_streams_expire_and_restart(spark, tmp_path, salts):
    stream = Feed(spark, tmp_path, EVENTS)
    stream.add([(1, "l", "a", at(0)), (2, "r", "a", at(-10)), (3, "r", "b", at(5)), (4, "l", "a", at(2)), (5, "l", None, at(0))])
    assert stream.run(joined(stream.read(), salts=salts)) == [(1, 2)]
    # A restart goes on with the rows in state.
    stream.add([(6, "r", "a", at(30)), (7, "r", "a", at(31)), (8, "l", "a", at(600)), (9, "r", "z", at(600))])
    expected = [(1, 2), (1, 6), (4, 6), (4, 7)]
    assert stream.run(joined(stream.read(), salts=salts)) == expected
    # The watermark is at 540 now: row 10 is late, and nothing old is left to meet.
    stream.add([(10, "r", "a", at(1)), (11, "l", "a", at(620)), (12, "r", "a", at(615)), (13, "r", "z", at(700)), (14, "l", "z", at(1000))])
    assert stream.run(joined(stream.read(), salts=salts)) == ordered([*expected, (8, 12), (11, 12)])
    stream.add([(15, "l", "q", at(9000)), (16, "r", "q", at(9500))])
    stream.run(joined(stream.read(), salts=salts))
    assert stream.state <= 1 + salts


def test_unmatched_rows_come_once_no_partner_can(spark, tmp_path):
    stream = Feed(spark, tmp_path, EVENTS)
    stream.add([(1, "l", "a", at(0)), (2, "r", "a", at(5)), (3, "l", "b", at(0)), (4, "l", None, at(0))])
    found = stream.run(joined(stream.read(), "left_outer", 2))
    assert found == [(1, 2)]
    stream.add([(5, "l", "z", at(500)), (6, "r", "z", at(500))])
    assert stream.run(joined(stream.read(), "left_outer", 2)) == ordered([(1, 2), (3, None), (4, None), (5, 6)])
    with pytest.raises(ValueError):
        joined(stream.read(), "full_outer", 2)


def test_joined_streams_equal_joined_tables(spark, tmp_path):
    draw = random.Random(4)
    rows = [(i, draw.choice("lr"), draw.choice(["hot", "hot", "a", None]), at(draw.randrange(300))) for i in range(300)]
    stream = Feed(spark, tmp_path, EVENTS)
    stream.add(rows)
    table = spark.createDataFrame(rows, EVENTS)
    expected = ordered(
        (a[0], b[0]) for a in rows for b in rows
        if a[1] == "l" and b[1] == "r" and a[2] == b[2] is not None and -600 <= (b[3] - a[3]).total_seconds() <= 1800
    )
    assert stream.run(joined(stream.read(), salts=4)) == ordered(joined(table).collect()) == expected
    assert {r.lid for r in joined(table, "left_semi", 4).collect()} == {a for a, _ in expected}


def test_repeats_are_dropped_across_restarts(spark, tmp_path):
    stream = Feed(spark, tmp_path, EVENTS)
    first = lambda: drop_repeats(stream.read(), ["kind", "k"], "t", "1 hour").select("id", "k")
    stream.add([(1, "l", "a", at(0))])
    assert stream.run(first()) == [(1, "a")]
    stream.add([(2, "l", "a", at(20)), (3, "l", "b", at(30)), (4, "l", None, at(30))])
    expected = ordered([(1, "a"), (3, "b"), (4, None)])
    assert stream.run(first()) == expected
    # Long after its first row a key counts as new, and its state is gone meanwhile.
    stream.add([(5, "l", "c", at(5000))])
    assert stream.run(first()) == ordered([*expected, (5, "c")]) and stream.state <= 1
    stream.add([(6, "l", "a", at(5010)), (7, "l", "c", at(5010)), (8, "l", "late", at(0))])
    assert stream.run(first()) == ordered([*expected, (5, "c"), (6, "a")])
    table = spark.createDataFrame([(1, "l", "a", at(0)), (2, "l", "a", at(9))], EVENTS)
    assert drop_repeats(table, ["kind", "k"], "t", "1 hour").count() == 1


# Alerts.


def alerts_of(rows, span, threshold, upto):
    """Sweep of all hits of a key in event time, in minutes."""
    for key in {k for _, _, k, _ in rows}:
        moves = {}
        for _, kind, k, t in rows:
            if k == key and kind == "l":
                end = int((t - START).total_seconds() // 600) * 10 + 10
                moves[end] = moves.get(end, 0) + 1
                moves[end + span] = moves.get(end + span, 0) - 1
        total, raised = 0, False
        for moment in sorted(m for m in moves if m <= upto):
            total += moves[moment]
            if (total >= threshold) != raised:
                raised = not raised
                yield key, at(moment), total, raised


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


@pytest.mark.parametrize("parts", [1, 3])
def test_alerts_follow_event_time(spark, tmp_path, rocksdb, parts):
    draw = random.Random(7)
    rows = [(i, draw.choice("llr"), draw.choice(["hot"] * 5 + ["a", "b", None]), at(draw.randrange(3000))) for i in range(400)]
    rows.sort(key=lambda r: r[3])
    end = (rows[-1][3] - START).total_seconds() // 60
    rows.append((999, "l", "end", at(end + 60)))
    stream = Feed(spark, tmp_path, EVENTS)
    size = -(-len(rows) // parts)
    for part in range(parts):
        some = rows[part * size : (part + 1) * size]
        random.Random(part).shuffle(some)
        stream.add(some)
        result = running_alerts(stream.read(), ["k"], "t", F.col("kind") == "l", "10 minutes", "1 hour", 4, "30 minutes")
        found = stream.run(result)
    assert found == ordered(alerts_of(rows, 60, 4, end + 30)) and len(found) > 10


def test_alert_state_is_dropped(spark, tmp_path, rocksdb):
    stream = Feed(spark, tmp_path, EVENTS)
    result = lambda: running_alerts(stream.read(), ["k"], "t", F.lit(True), "10 minutes", "1 hour", 2, "0 minutes")
    stream.add([(i, "l", f"k{i % 50}", at(i % 7)) for i in range(100)])
    assert stream.run(result()) == []
    stream.add([(200, "l", "k0", at(25))])
    raised = stream.run(result())
    assert len(raised) == 50 and all(r[1:] == (at(10), 2, True) for r in raised)
    # The watermark passes the hour without a row of these keys: timers clear them.
    stream.add([(300, "l", "z", at(1000))])
    cleared = [r for r in stream.run(result()) if not r[3]]
    assert len(cleared) == 50 and {r[1] for r in cleared if r[0] != "k0"} == {at(70)}
    stream.add([(400, "l", "z", at(5000))])
    stream.run(result())
    assert stream.state <= 2
