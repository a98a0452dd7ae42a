"""Queries over event time: as-of and range joins, joined streams, late rows, alerts and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fixtures.inputs import complaint_messages, event_stream, stored, table
from fixtures.queries import Query, run_to_end
from lakeops.operators import frames, ranking, sketches
from lakeops.operators.asof import as_of_join
from lakeops.operators.cubes import grouping_totals
from lakeops.operators.joins import join_dimension
from lakeops.operators.ranges import range_join
from lakeops.operators.sessions import sessions
from lakeops.plans import feed
from lakeops.session import ROCKSDB, shared_dir
from lakeops.sources import layout
from lakeops.sources.events import read_files
from lakeops.streaming import runs, windows
from lakeops.streaming.alerts import running_alerts
from lakeops.streaming.joins import drop_repeats, join_streams

TIME_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    TIME_QUERIES[function.__name__] = function
    return function


def later(minutes: str) -> Column:
    return F.expr(f"timestampadd(MINUTE, cast({minutes} AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00')")


def placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders moved into the month of the events, each valid for up to two days or without an end."""
    start = "(o_orderkey * 37 + o_custkey) % 43200"
    return table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 150).alias("buyer"),
        "o_orderstatus",
        later(start).alias("placed"),
        F.when(F.col("o_orderkey") % 50 != 0, later(f"{start} + 1 + pmod(o_orderkey, 7) * pmod(o_orderkey, 411)")).alias("until"),
    )


def user_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


def latest_orders(spark: SparkSession, sf: str, **bounds) -> DataFrame:
    joined = as_of_join(
        user_events(spark, sf), placed_orders(spark, sf), {"user_id": "buyer"}, ("ts", "placed"),
        ["o_orderkey", "o_orderstatus"], **bounds,
    )
    return joined.select("event_id", "o_orderkey", "o_orderstatus")


@query
def as_of_orders(spark, sf):
    """The latest order of the user before each event."""
    return latest_orders(spark, sf)


@query
def as_of_orders_within(spark, sf):
    """The same with users cut into time ranges, and only orders of the last six hours."""
    return latest_orders(spark, sf, slice_rows=20, slices=8, within="6 hours", strict=True)


def held_events(spark: SparkSession, sf: str, **options) -> DataFrame:
    return range_join(
        user_events(spark, sf), placed_orders(spark, sf), "ts", ("placed", "until"),
        {"user_id": "buyer"}, ["o_orderkey"], **options,
    )


@query
def range_join_valid_orders(spark, sf):
    """Orders valid at the time of each event of the same user."""
    return held_events(spark, sf).select("event_id", "o_orderkey")


@query
def range_join_merged(spark, sf):
    """The same by a merge, keeping events without a valid order."""
    return held_events(spark, sf, how="left", key=["event_id"], max_rows=0).select("event_id", "o_orderkey")


@query
def range_join_values(spark, sf):
    """Parts whose retail price lies in a band around an order's price, without an equal key."""
    bands = table(spark, sf, "orders").where("o_orderkey % 20 = 0").select(
        "o_orderkey", (F.col("o_totalprice") / 100).alias("low"), (F.col("o_totalprice") / 100 + F.col("o_custkey") % 40).alias("high")
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return range_join(parts, bands, "p_retailprice", ("low", "high"), columns=["o_orderkey"]).select("p_partkey", "o_orderkey")


def idle_after() -> Column:
    """How long after an event of each type its session lasts."""
    return F.expr("case event_type when 'purchase' then '8 hours' when 'error' then '20 minutes' else '2 hours' end")


@query
def sessions_of_users(spark, sf):
    """Sessions of users, whose events keep them open for different times."""
    return sessions(user_events(spark, sf).withColumn("one", F.lit(1)), ["user_id"], "ts", idle_after(), sums={"ones": "one"}, slice="6 hours")


@query
def sessions_of_types(spark, sf):
    """The same for a few keys that hold all rows, which run through many slices."""
    return sessions(user_events(spark, sf), ["event_type"], "ts", "5 minutes", slice="1 hour")


# Groupings, frames, sketches and layouts.


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("yr"), F.col("l_quantity").cast("long").alias("quantity"), "l_suppkey"
    )


@query
def cube_of_lines(spark, sf):
    rows = lines(spark, sf).withColumn("yr", F.when(F.col("l_suppkey") % 7 != 0, F.col("yr")))
    return grouping_totals(rows, ["l_returnflag", "l_linestatus", "yr"], sums={"quantity": "quantity"})


@query
def rollup_of_lines(spark, sf):
    return grouping_totals(lines(spark, sf), ["yr", "l_returnflag", "l_linestatus"], "rollup")


@query
def chosen_groupings(spark, sf):
    sets = [["l_returnflag", "yr"], ["l_linestatus"], [], ["yr", "l_returnflag"]]
    return grouping_totals(lines(spark, sf), ["l_returnflag", "l_linestatus", "yr"], sets)


def dated_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).alias("day"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )


@query
def running_quantity(spark, sf):
    """Quantity shipped so far under each of three flags, cut into ranges of days."""
    return frames.running_sums(dated_lines(spark, sf), ["l_returnflag"], "day", "quantity", slice_rows=100, slices=16)


@query
def quantity_of_a_month(spark, sf):
    """Quantity and lines shipped in the last 30 days under the same flag."""
    return frames.moving_sums(
        dated_lines(spark, sf), ["l_returnflag"], "day", "quantity", 30, count="lines", slice_rows=100, slices=16
    )


@query
def sketched_users(spark, sf):
    """Users and values of each third of the month from stored daily sketches, and whether they are near enough."""
    events = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    daily = stored(sketches.sketch(events, ["day", "event_type"], "event_id", "value"), "sketches")
    third = F.floor((F.col("day") - 1) / 10).cast("int").alias("third")
    found = sketches.estimates(sketches.merged(daily, [third]), {"median": 0.5, "high": 0.9})
    exact = events.groupBy(third).agg(F.countDistinct("event_id").alias("n_ids"), *[
        F.array(*[F.percentile("value", share + side * 0.04) for side in (-1, 1)]).alias(name) for name, share in (("m", 0.5), ("h", 0.9))
    ])
    return found.join(exact, "third").select(
        "third", "n", "n_ids",
        (F.abs(F.col("n_distinct") - F.col("n_ids")) <= 0.06 * F.col("n_ids")).alias("distinct_near"),
        F.col("median").between(F.col("m")[0], F.col("m")[1]).alias("median_near"),
        F.col("high").between(F.col("h")[0], F.col("h")[1]).alias("high_near"),
    )


@query
def bucketed_join(spark, sf):
    """Lines per order priority from two tables bucketed by order, joined where they lie."""
    items = layout.write_bucketed(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), ["l_orderkey"], 8)
    orders = layout.write_bucketed(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], 8)
    joined = spark.table(items).join(spark.table(orders).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("cnt"), F.sum("l_quantity").alias("quantity"))


@query
def partitioned_read(spark, sf):
    """Orders of one status and year, from folders by status and year."""
    path = shared_dir(spark, "by-status")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    layout.write_partitioned(orders, path, ["o_orderstatus", "yr"])
    return layout.read_partition(spark, path, o_orderstatus="F", yr=1997).select("o_orderkey", "o_orderstatus", "yr")


# Streams.


def side(spark: SparkSession, sf: str, kind: str, name: str) -> DataFrame:
    events = event_stream(spark, sf).where(F.col("event_type") == kind)
    return events.select(
        F.col("event_id").alias(f"{name}_id"), F.col("user_id").alias(f"{name}_user"), F.col("ts").cast("timestamp").alias(f"{name}_ts")
    )


def views_and_purchases(spark: SparkSession, sf: str, how: str, salts: int = 1) -> DataFrame:
    joined = join_streams(
        side(spark, sf, "view", "view"), side(spark, sf, "purchase", "buy"), {"view_user": "buy_user"},
        ("view_ts", "buy_ts"), ("0 seconds", "6 hours"), ("10 minutes", "10 minutes"), how, salts,
    )
    names = [c for c in ("view_id", "buy_id") if c in joined.columns]
    return run_to_end(spark, joined.select(*names), "append")


@query
def stream_join_purchases(spark, sf):
    """Purchases of a user within six hours after a view."""
    return views_and_purchases(spark, sf, "inner", salts=4)


@query
def stream_join_lost_views(spark, sf):
    """Views with their purchases, and views that none can follow any more."""
    return views_and_purchases(spark, sf, "left_outer")


@query
def stream_drop_repeats(spark, sf):
    """One row per user and type, whatever the number of rows, of a stream whose keys expire."""
    first = drop_repeats(event_stream(spark, sf).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "40 days")
    return run_to_end(spark, first.select("user_id", "event_type"), "append")


@query
def stream_sessions(spark, sf):
    """Closed sessions of users, from a stream."""
    counts = windows.session_counts(event_stream(spark, sf), "ts", "90 minutes", ["user_id"], watermark="1 hour")
    return run_to_end(spark, windows.flatten_window(counts), "append")


@query
def uncommon_events_stream_large(spark, sf):
    """Events on uncommon days, as a stream, with patterns above the broadcast bound (salted)."""
    dated = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    patterns = stored(ranking.top_k_shares(dated, "event_type", "day", 4), "days")
    stream = event_stream(spark, sf).select("event_id", "event_type", F.dayofmonth("ts").alias("day"))
    keys = {"event_type": "event_type", "day": "day"}
    rare = join_dimension(stream, patterns, keys, "left_anti", max_rows=0)
    return run_to_end(spark, rare.select("event_id", "event_type"), "append")


def in_two_parts(spark: SparkSession, sf: str, folder: str, part: int) -> None:
    """Events on time first; every tenth event comes in a second part, mostly too late."""
    late = F.col("event_id") % 10 == 0
    table(spark, sf, "events").where(late if part else ~late).write.mode("append").parquet(folder)


@query
def felonies_without_late_ones(spark, sf):
    """Felonies per hour and borough of a stream restarted with late rows, under a watermark."""
    folder = shared_dir(spark, "late")
    schema = table(spark, sf, "events").schema
    for part in (0, 1):
        in_two_parts(spark, sf, f"{folder}/in", part)
        messages = complaint_messages(read_files(spark, f"{folder}/in", schema))
        feed.start_query(
            messages, "unsafest_boroughs", f"{folder}/out", f"{folder}/checkpoint", watermark="36 hours", available_now=True
        ).awaitTermination()
    result = feed.result_schema(messages, "unsafest_boroughs", watermark="36 hours")
    return feed.read_result(spark, "unsafest_boroughs", f"{folder}/out", result).drop("timestamp")


@query
def counts_without_late_rows(spark, sf):
    """Closed windows only (append), of a stream restarted with late rows."""
    folder = shared_dir(spark, "late")
    schema = table(spark, sf, "events").schema
    for part in (0, 1):
        in_two_parts(spark, sf, f"{folder}/in", part)
        counts = windows.tumbling_counts(read_files(spark, f"{folder}/in", schema), "ts", "6 hours", ["event_type"], watermark="2 days")
        counts = windows.flatten_window(counts)
        sink = runs.folder_sink(f"{folder}/out")
        runs.run_stream(counts, sink, f"{folder}/checkpoint", "append", available_now=True).awaitTermination()
    return runs.read_appended(spark, f"{folder}/out", counts.schema)


@query
def error_alerts(spark, sf):
    """When a user's errors of the last 12 hours reach three, and when they fall below."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        hit = F.col("event_type") == "error"
        alerts = running_alerts(event_stream(spark, sf), ["user_id"], "ts", hit, "10 minutes", "12 hours", 3, "1 hour")
        return run_to_end(spark, alerts, "append")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
