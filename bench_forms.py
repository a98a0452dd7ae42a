"""Times operators beside the plain forms they replace, on the same session and data.

The plain forms are the ways such queries are commonly written: one aggregate per column joined by
UNION ALL, DISTINCT over a window, one job per column, Python functions per row, JSON parsed into
all fields with filters above it. ``FORMS_COPIES`` repeats every row of the inputs (default 10).
"""

from __future__ import annotations

import os
import random
import statistics
import tempfile
import time

from pyspark.sql import Window, functions as F

from fixtures.inputs import complaint_messages, raw_survey, table
from lakeops.functions.coding import decode
from lakeops.functions.numbers import duration_days
from lakeops.operators import assign, columns, ranking, shares
from lakeops.plans import complaints as feed
from lakeops.plans.values import COMPLAINT_SCHEMA, EDUCATION_LEVEL
from lakeops.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
COPIES = int(os.environ.get("FORMS_COPIES", "10"))


def repeated(df, folder, name):
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("__copy")
    path = f"{folder}/{name}"
    df.select("*", copies).drop("__copy").repartition(16).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def forms(spark, folder):
    items = repeated(table(spark, SF_DIR, "lineitem"), folder, "lineitem")
    survey = repeated(raw_survey(spark, SF_DIR), folder, "survey")
    messages = repeated(complaint_messages(table(spark, SF_DIR, "events")), folder, "messages")
    answers = ["l_quantity", "l_tax", "l_discount", "l_linenumber"]

    def union_of_aggregates():
        parts = [
            items.groupBy(F.col(c).cast("double").alias("v")).count().withColumn("q", F.lit(c))
            for c in answers
        ]
        stacked = parts[0]
        for part in parts[1:]:
            stacked = stacked.unionByName(part)
        totals = stacked.where("v IS NOT NULL").groupBy("q").agg(F.sum("count").alias("n"))
        score = F.try_divide(F.lit(1.0), F.col("v")) * F.col("count") / F.col("n")
        return stacked.join(totals, "q").groupBy("q").agg(F.round(F.sum(score), 2))

    length = duration_days(F.lit(0), F.col("l_quantity").cast("int"), F.col("l_linenumber"))

    def distinct_over_window():
        group = Window.partitionBy("l_returnflag")
        return items.select("l_returnflag", length.alias("d")).where("d > 0").select(
            "l_returnflag", F.avg("d").over(group), F.min("d").over(group), F.max("d").over(group)
        ).distinct()

    profiled = [c for c in survey.columns if c.startswith("V1") or c.startswith("V9")]

    def job_per_column():
        for name in profiled:
            number = survey.select(F.col(name).try_cast("int").alias("v"))
            number.where("v IS NULL OR v IN (9, 99, 999, 9999)").count()

    book = dict(EDUCATION_LEVEL)
    label_of = F.udf(lambda code: book.get(code), "string")

    def draw(a, b):
        if random.random() <= 0.1:
            return random.choice(["a", "b", "c"])
        spin = random.random()
        return "a" if spin <= a else "b" if spin <= b else "c"

    limits = items.select("l_orderkey", F.lit(0.5).alias("a"), F.lit(0.8).alias("b"), F.lit(1.0).alias("c"))
    parsed = messages.select(F.from_json("value", COMPLAINT_SCHEMA).alias("e")).select("e.*")
    counts = Window.partitionBy("l_suppkey")

    def rank_of_window_counts():
        pairs = items.select(
            "l_suppkey",
            "l_linenumber",
            F.count("*").over(Window.partitionBy("l_suppkey", "l_linenumber")).alias("n"),
            F.count("*").over(counts).alias("total"),
        ).distinct()
        rank = F.dense_rank().over(counts.orderBy(F.desc("n")))
        return pairs.withColumn("r", rank).where("r <= 3")

    return {
        "score of four columns": (
            union_of_aggregates, lambda: shares.weighted_code_score(items, answers)
        ),
        "average, minimum, maximum per group": (
            distinct_over_window,
            lambda: shares.value_stats(items, "l_returnflag", length, ["a", "b", "c"]),
        ),
        "top 3 shares per group": (
            rank_of_window_counts,
            lambda: ranking.top_k_shares(items, "l_suppkey", "l_linenumber", 3),
        ),
        f"unusable values of {len(profiled)} columns": (
            job_per_column, lambda: columns.missing_profile(survey.select(*profiled))
        ),
        "decode one column": (
            lambda: survey.select(label_of(F.col("V0935").cast("int"))),
            lambda: survey.select(decode(F.col("V0935").cast("int"), EDUCATION_LEVEL)),
        ),
        "draw labels by weight": (
            lambda: limits.select(F.udf(draw, "string")("a", "b")),
            lambda: assign.weighted_assign(
                limits, {"a": "a", "b": "b", "c": "c"}, "label", 1, ["l_orderkey"]
            ).select("label"),
        ),
        "parse and watch a place": (
            lambda: feed.location_safety(parsed),
            lambda: feed.location_safety(feed.parse_complaints(messages, "location_safety")),
        ),
    }


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "forms",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(form) -> float:
        start = time.perf_counter()
        result = form()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def median(form) -> float:
        seconds(form)
        return statistics.median(seconds(form) for _ in range(3))

    print(f"| Operator ({COPIES} copies of {SF_DIR.rsplit('/', 1)[-1]}) | Plain form, s | Here, s |")
    print("| --- | --- | --- |")
    with tempfile.TemporaryDirectory(prefix="forms-") as folder:
        for name, (plain, here) in forms(spark, folder).items():
            print(f"| {name} | {median(plain):.2f} | {median(here):.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
