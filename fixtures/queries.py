"""One query per operator and job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from fixtures.inputs import (
    borough_weights,
    complaint_messages,
    complaints,
    event_stream,
    raw_survey,
    stored,
    survey,
    table,
)
from lakeops.functions import coding, temporal
from lakeops.functions.numbers import duration_days, within_radius
from lakeops.operators import assign, columns, joins, ranking, shares
from lakeops.plans import complaints as complaint_plans
from lakeops.plans import feed
from lakeops.plans import survey as survey_plans
from lakeops.plans.reports import REPORTS
from lakeops.session import shared_dir
from lakeops.sources import tables
from lakeops.sources.events import parse_json_events
from lakeops.streaming import runs, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def run_to_end(
    spark: SparkSession,
    df: DataFrame,
    mode: str,
    keys: Sequence[str] = (),
    order_by: Sequence = (),
) -> DataFrame:
    """Run a stream over everything present and return the table its sink has made."""
    folder = shared_dir(spark, "stream")
    if mode == "append":
        sink = runs.folder_sink(f"{folder}/out")
    elif mode == "complete":
        sink = runs.latest_sink(f"{folder}/out", order_by)
    else:
        sink = runs.upsert_sink(f"{folder}/out", keys)
    runs.run_stream(df, sink, f"{folder}/checkpoint", mode, available_now=True).awaitTermination()
    if mode == "append":
        return runs.read_appended(spark, f"{folder}/out", df.schema)
    if mode == "complete":
        return runs.read_latest(spark, f"{folder}/out", df.schema)
    return runs.read_upserted(spark, f"{folder}/out", df.schema, keys)


# Shares, indexes and scores.


@query
def count_by(spark, sf):
    return shares.count_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query
def share_of_total(spark, sf):
    return shares.share_of_total(table(spark, sf, "customer"), "c_mktsegment")


@query
def conditional_share(spark, sf):
    high = (F.col("l_discount") >= 0.09) | (F.col("l_tax") >= 0.07) | (F.col("l_quantity") >= 48)
    return shares.conditional_share(table(spark, sf, "lineitem"), "l_returnflag", high)


@query
def duration_stats(spark, sf):
    length = duration_days(F.lit(0), F.col("l_quantity").cast("int"), F.col("l_linenumber"))
    names = ["avg_days", "min_days", "max_days"]
    return shares.value_stats(table(spark, sf, "lineitem"), "l_returnflag", length, names)


@query
def weighted_code_score(spark, sf):
    answers = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_discount") * 100).alias("discount_pct"), "l_linenumber"
    )
    return shares.weighted_code_score(answers, answers.columns)


@query
def share_index(spark, sf):
    return shares.share_index(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query
def modal_with_ties(spark, sf):
    customers = table(spark, sf, "customer")
    nations = table(spark, sf, "nation")
    located = joins.join_dimension(customers, nations, {"c_nationkey": "n_nationkey"}, "inner")
    counts = shares.count_by(located, ["n_regionkey", "c_mktsegment", "n_name"])
    return shares.most_frequent(counts, ["n_regionkey", "c_mktsegment"], "n_name")


# Ranks and changes.


@query
def topk_share(spark, sf):
    return ranking.top_k_shares(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment", 3)


@query
def topk_values(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity", "l_tax")
    return ranking.top_k_per_group(items, ["l_suppkey"], "l_quantity", 2)


@query
def change_over_time(spark, sf):
    yearly = table(spark, sf, "orders").select("o_orderstatus", F.year("o_orderdate").alias("yr"))
    changes = ranking.change_over_time(yearly, "o_orderstatus", "yr", (1996, 2001))
    return changes.withColumn("change_text", ranking.change_text(F.col("change").cast("decimal(10,2)")))


@query
def mine_common_patterns(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("yr", F.year("l_shipdate"))
    return ranking.mine_common_patterns(items, "l_returnflag", ["yr", "l_linestatus"], 4)


@query
def arrival_schedule(spark, sf):
    events = table(spark, sf, "events")
    return ranking.arrival_schedule(events, F.col("ts"))


# Cleaning and coding.


@query
def select_cast(spark, sf):
    return columns.select_cast(raw_survey(spark, sf), ["V0022", "V9001", "V0404"])


@query
def rename_and_drop(spark, sf):
    raw = raw_survey(spark, sf).select("RESPONDENT", "V0015", "V1168", "V9003", "V0062")
    renamed = columns.rename(raw, {"V0062": "OFFENSE", "V1168": "PARENTS"})
    return columns.drop_by_prefix(renamed, ["V0", "V1"])


@query
def missing_profile(spark, sf):
    items = table(spark, sf, "lineitem").select("l_linenumber", "l_suppkey", "l_returnflag")
    return columns.missing_profile(items)


@query
def decode(spark, sf):
    labels = {"F": "FINISHED", "O": "OPEN"}
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        coding.decode(status, labels).alias("label"),
        coding.decode(status, labels, "NEITHER").alias("label_or_default"),
    )


@query
def normalise_category(spark, sf):
    classes = {"1-URGENT": "SOON", "2-HIGH": "SOON", "5-LOW": "LATER"}
    return table(spark, sf, "orders").select(
        "o_orderkey", coding.normalise_category(F.col("o_orderpriority"), classes).alias("priority")
    )


@query
def classify_by_prefix(spark, sf):
    rules = (("EXCEPTION", ("1-U",)), ("NUMBERED", ("1-", "2-", "3-")))
    return table(spark, sf, "orders").select(
        "o_orderkey", coding.classify_by_prefix(F.col("o_orderpriority"), rules).alias("priority")
    )


@query
def first_flag_label(spark, sf):
    flags = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("accepted"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("finished"),
    )
    label = coding.first_flag_label({"accepted": "A", "finished": "F"}, "OTHER")
    return flags.select("l_orderkey", label.alias("label"))


@query
def recode_flag(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", coding.recode_flag(F.col("l_linenumber")).alias("flag")
    )


@query
def blank_negative(spark, sf):
    return columns.blank_negative(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_returnflag", (F.col("l_quantity") - 25).alias("above_25")
        )
    )


@query
def duration_total(spark, sf):
    parts = [F.col(c) for c in survey_plans.JAIL_TIME_PARTS]
    total = duration_days(parts[0], parts[1], parts[3], parts[2])
    return raw_survey(spark, sf).select("RESPONDENT", total.alias("days"))


# Joins and assignment.


@query
def left_join_two_keys(spark, sf):
    decoded = survey(spark, sf)
    weights = stored(borough_weights(decoded), "weights").select(
        "PD_DESC_Mapped", "SUSP_RACE_Mapped", "BRONX_cumulative_prob"
    )
    keys = {"OFFENSE_TYPE": "PD_DESC_Mapped", "RACE": "SUSP_RACE_Mapped"}
    rows = decoded.select("RESPONDENT", "OFFENSE_TYPE", "RACE")
    return joins.join_dimension(rows, weights, keys, "left").select(
        "RESPONDENT", F.col("BRONX_cumulative_prob").alias("weight")
    )


@query
def left_join_large_dimension(spark, sf):
    """A dimension above the given broadcast bound."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.join_dimension(items, orders, {"l_orderkey": "o_orderkey"}, "left", max_rows=100).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus"
    )


@query
def cumulative_weights(spark, sf):
    return assign.cumulative_weights(
        table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_discount"),
        ["l_quantity", "l_linenumber", "l_discount"],
    )


@query
def cumulative_weights_compat(spark, sf):
    return assign.cumulative_weights(
        table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_discount"),
        ["l_quantity", "l_linenumber", "l_discount"],
        compat=True,
    )


@query
def weighted_assign(spark, sf):
    limits = {"a": F.lit(0.5), "b": F.lit(0.8), "c": F.lit(1.0)}
    events = table(spark, sf, "events").select(
        "event_id", *[limit.alias(f"upto_{label}") for label, limit in limits.items()]
    )
    weights = {label: f"upto_{label}" for label in limits}
    drawn = assign.weighted_assign(events, weights, "label", seed=7, key=["event_id"])
    return drawn.select("event_id", "label")


# Sources and sinks.


@query
def csv_round_trip(spark, sf):
    path = shared_dir(spark, "csv")
    customers = table(spark, sf, "customer")
    tables.write_table(customers, path, "csv")
    return tables.read_table(spark, path, "csv", schema=customers.schema)


@query
def tsv_inferred(spark, sf):
    path = shared_dir(spark, "tsv")
    table(spark, sf, "customer").write.option("header", True).option("sep", "\t").csv(path)
    inferred = tables.read_table(spark, path, "csv", sep="\t", infer=True)
    return inferred.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_acctbal", "c_mktsegment"
    )


@query
def sql_over_frame(spark, sf):
    text = """
        SELECT l_returnflag, COUNT(*) AS cnt, SUM(l_quantity) AS quantity
        FROM {items} GROUP BY l_returnflag
    """
    return tables.run_sql(spark, text, items=table(spark, sf, "lineitem"))


@query
def publish_and_parse(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return parse_json_events(tables.publish_json(orders), orders.schema)


@query
def parse_json(spark, sf):
    schema = StructType().add("k", LongType())
    return parse_json_events(table(spark, sf, "events"), schema, value="props")


@query
def event_times(spark, sf):
    parsed = complaints(table(spark, sf, "events"))
    return complaint_plans.with_event_time(parsed).select("CMPLNT_NUM", "event_time", "RPT_DT")


@query
def geofence(spark, sf):
    inside = within_radius(F.col("user_id"), F.col("value"), (75.0, 20.0), 30.0)
    return table(spark, sf, "events").select("event_id", inside.alias("inside"))


# Event-time windows, as streams.


@query
def tumbling_counts(spark, sf):
    counts = windows.tumbling_counts(event_stream(spark, sf), "ts", "1 hour", ["event_type"])
    return run_to_end(
        spark, windows.flatten_window(counts), "update", ["window_start", "event_type"]
    )


@query
def tumbling_counts_ordered(spark, sf):
    """The whole sorted result in every micro-batch, the last one kept."""
    counts = windows.tumbling_counts(event_stream(spark, sf), "ts", "1 hour", ["event_type"])
    ordered = complaint_plans.in_order(windows.flatten_window(counts), "cnt")
    return run_to_end(spark, ordered, "complete")


@query
def window_status(spark, sf):
    near = within_radius(F.col("user_id"), F.col("value"), (75.0, 20.0), 30.0)
    status = windows.window_status(event_stream(spark, sf), "ts", "2 hours", near, 3)
    return run_to_end(spark, windows.flatten_window(status), "update", ["window_start"])


@query
def uncommon_events(spark, sf):
    dated = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    patterns = stored(ranking.top_k_shares(dated, "event_type", "day", 4), "days")
    stream = event_stream(spark, sf).select("event_id", "event_type", F.dayofmonth("ts").alias("day"))
    keys = {"event_type": "event_type", "day": "day"}
    rare = joins.join_dimension(stream, patterns, keys, "left_anti")
    return run_to_end(spark, rare.select("event_id", "event_type"), "append")


@query
def uncommon_events_large(spark, sf):
    """The same with patterns above the broadcast bound."""
    dated = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    patterns = stored(ranking.top_k_shares(dated, "event_type", "day", 4), "days")
    keys = {"event_type": "event_type", "day": "day"}
    rare = joins.join_dimension(dated, patterns, keys, "left_anti", max_rows=0)
    return rare.select("event_id", "event_type")


# Survey jobs.


@query
def drop_unusable_columns(spark, sf):
    return survey_plans.drop_unusable_columns(
        raw_survey(spark, sf).select("RESPONDENT", "V0022", "V9001", "V9002", "V9003")
    )


@query
def transform_for_consumption(spark, sf):
    return survey(spark, sf)


def _report(name: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return REPORTS[name](survey(spark, sf))

    QUERIES[name] = run


for _name in REPORTS:
    _report(_name)


def mapped_boroughs(spark: SparkSession, sf: str) -> DataFrame:
    decoded = survey(spark, sf)
    return survey_plans.add_borough(
        decoded, stored(borough_weights(decoded), "weights"), 11, ["RESPONDENT"]
    )


@query
def add_borough(spark, sf):
    return mapped_boroughs(spark, sf)


@query
def add_borough_compat(spark, sf):
    """The same with the weights added up as the rebuilt pipeline did."""
    decoded = survey(spark, sf)
    weights = stored(borough_weights(decoded), "weights")
    return survey_plans.add_borough(decoded, weights, 11, ["RESPONDENT"], compat=True)


@query
def common_patterns(spark, sf):
    return survey_plans.common_patterns(mapped_boroughs(spark, sf))


@query
def print_patterns(spark, sf):
    return survey_plans.show_patterns(survey_plans.common_patterns(mapped_boroughs(spark, sf)))


# Complaint jobs, as streams. The processing time is left out of what is compared.


def complaint_job(
    spark: SparkSession, sf: str, name: str, patterns: DataFrame | None = None, mode: str = "update",
    watermark: str | None = None,
) -> DataFrame:
    folder = shared_dir(spark, name)
    messages = complaint_messages(event_stream(spark, sf))
    schema = feed.result_schema(messages, name, mode, watermark)
    feed.start_query(
        messages, name, f"{folder}/out", f"{folder}/checkpoint", patterns, mode, watermark, available_now=True
    ).awaitTermination()
    return feed.read_result(spark, name, f"{folder}/out", schema, mode).drop("timestamp")


@query
def complaints_per_hour_and_borough(spark, sf):
    return complaint_job(spark, sf, "complaints_per_hour_and_borough")


@query
def most_common_complaints(spark, sf):
    return complaint_job(spark, sf, "most_common_complaints", mode="complete")


@query
def unsafest_boroughs(spark, sf):
    return complaint_job(spark, sf, "unsafest_boroughs")


@query
def unsafest_boroughs_watermark(spark, sf):
    return complaint_job(spark, sf, "unsafest_boroughs", watermark="1 hour")


@query
def location_safety(spark, sf):
    return complaint_job(spark, sf, "location_safety")


@query
def uncommon_crimes(spark, sf):
    patterns = stored(survey_plans.common_patterns(mapped_boroughs(spark, sf)), "patterns")
    return complaint_job(spark, sf, "uncommon_crimes", patterns)


@query
def save_to_lake(spark, sf):
    return complaint_job(spark, sf, "save_to_lake")
