"""Event parsing, windows and sinks, with restarts, replays and late rows."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.numbers import within_radius
from lakeops.functions.temporal import event_time, iso_text, minute_of_day, window_text
from lakeops.plans import complaints as feed
from lakeops.plans import feed as jobs
from lakeops.plans.values import COMPLAINT_SCHEMA
from lakeops.sources.events import parse_json_events, read_files
from lakeops.sources.tables import publish_json
from lakeops.streaming import runs
from lakeops.streaming.windows import flatten_window, tumbling_counts, window_status


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps(line) for line in lines) + "\n")
    # The source takes files by age, so each gets a distinct one.
    age = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(path, (age, age))


def stream_text(spark, folder, per_trigger=1):
    return read_files(spark, str(folder), "value string", "text", per_trigger)


# Parsing.

SCHEMA = StructType().add("name", "string").add("n", "long").add("x", "float")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"name": "a", "n": 1, "x": 2.5, "more": 3}', ("a", 1, 2.5)),
        ('{"name": NaN, "n": NaN}', (None, None, None)),
        ('{"name": "NaN", "n": 7}', (None, 7, None)),
        ('{"name": "a"}', ("a", None, None)),
        ('{"name": "a", "n": 5.0, "x": 1}', ("a", None, 1.0)),
        ('{"name": "a", "n": "text", "x": 1}', ("a", None, 1.0)),
        ("not json", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_parse_json(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    assert tuple(parse_json_events(df, SCHEMA).first()) == expected


def test_parse_bytes_and_keep_bad_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"n": 3}'),), (bytearray(b"{oops"),)], "value binary")
    got = parse_json_events(df, SCHEMA, corrupt="bad", columns=["n"])
    assert got.columns == ["n", "bad"]
    assert rows(got) == [(3, None), (None, "{oops")]


def test_messages_are_parsed_once_per_row(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    events = feed.parse_complaints(df, "location_safety")
    plan = feed.location_safety(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_publish_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, datetime.date(2024, 1, 2))], "a int, b string, d date")
    assert json.loads(publish_json(df).first()[0]) == {"a": 1, "b": None, "d": "2024-01-02"}


def test_replayed_rows_become_messages_with_a_schedule(spark):
    df = spark.createDataFrame(
        [("1", "00:05:30", None), ("2", "00:05:59", 1.5), ("3", "23:59:00", None), ("4", "bad", None)],
        "CMPLNT_NUM string, CMPLNT_FR_TM string, PD_CD float",
    )
    messages = [json.loads(row.value) for row in jobs.outgoing_messages(df).collect()]
    assert [m["time_seconds"] for m in messages] == [5, 5, 1439, None]
    parsed = feed.parse_complaints(jobs.outgoing_messages(df))
    assert "time_seconds" not in parsed.columns
    assert [r.PD_CD for r in parsed.collect()] == [None, 1.5, None, None]
    assert rows(jobs.sending_schedule(df)) == sorted([(5, 1434), (1439, None), (None, None)], key=repr)


# Time and place.


def test_event_time_formats(spark):
    df = spark.createDataFrame(
        [("01/31/2024", "23:59:58"), ("2024-01-31T00:00:00", "07:05:00"), ("31.1.2024", "07:05:00"), ("01/31/2024", "noon"), (None, "07:05:00")],
        "d string, t string",
    )
    got = [r[0] for r in df.select(event_time(F.col("t"), F.col("d"))).collect()]
    assert got == [datetime.datetime(2024, 1, 31, 23, 59, 58), datetime.datetime(2024, 1, 31, 7, 5), None, None, None]


def test_event_time_without_date_is_today(spark):
    df = spark.createDataFrame([("07:05:00",)], "t string")
    got, today = df.select(event_time(F.col("t")), F.current_date()).first()
    assert got == datetime.datetime.combine(today, datetime.time(7, 5))
    assert df.select(minute_of_day(event_time(F.col("t")))).first()[0] == 425


def test_window_and_iso_text(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 13, 30),)], "t timestamp_ntz")
    text, iso = df.groupBy(F.window("t", "1 hour").alias("w"), "t").count().select(
        window_text(F.col("w")), iso_text(F.col("t"))
    ).first()
    assert text == "[2024-01-01 13:00:00, 2024-01-01 14:00:00]"
    assert iso == "2024-01-01T13:30:00"


def test_geofence_edge_null_and_nan(spark):
    df = spark.createDataFrame(
        [(0.0, 3.0), (0.0, 3.1), (None, 1.0), (float("nan"), 1.0)], "x double, y double"
    )
    got = [r[0] for r in df.select(within_radius(F.col("x"), F.col("y"), (0.0, 0.0), 3.0)).collect()]
    assert got == [True, False, None, False]


def test_window_status_counts_hits_only(spark):
    at = datetime.datetime(2024, 1, 1)
    data = [(0, True), (0, True), (0, True), (2, True), (2, True), (2, None), (4, False)]
    df = spark.createDataFrame([(at + datetime.timedelta(hours=h), hit) for h, hit in data], "t timestamp_ntz, hit boolean")
    got = window_status(df, "t", "2 hours", F.col("hit"), 3)
    status = {r["window"].start.hour: (r.hits, r.status) for r in got.collect()}
    assert status == {0: (3, "unsafe"), 2: (2, "safe"), 4: (0, "safe")}


# Jobs.


def complaint(number, time="10:15:00", **fields):
    base = {
        "CMPLNT_NUM": str(number), "CMPLNT_FR_DT": "01/31/2024", "CMPLNT_FR_TM": time,
        "LAW_CAT_CD": "FELONY", "BORO_NM": "BRONX", "OFNS_DESC": "ROBBERY",
        "PD_DESC": "ROBBERY,BANK", "SUSP_RACE": "WHITE", "Latitude": 40.73, "Longitude": -73.99,
    }
    return base | fields


def test_windows_leave_out_rows_without_a_time(spark):
    df = spark.createDataFrame([(json.dumps(complaint(1)),), (json.dumps(complaint(2, "bad")),), ("junk",)], "value string")
    got = feed.complaints_per_hour_and_borough(feed.parse_complaints(df)).drop("timestamp")
    assert rows(got) == [("[2024-01-31 10:00:00, 2024-01-31 11:00:00]", "BRONX", 1)]


def test_felonies_in_known_boroughs(spark):
    events = [complaint(1), complaint(2, BORO_NM="UNKNOWN"), complaint(3, BORO_NM=None), complaint(4, LAW_CAT_CD="VIOLATION"), complaint(5, BORO_NM=float("nan"))]
    df = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    got = feed.unsafest_boroughs(feed.parse_complaints(df)).drop("timestamp")
    start = datetime.datetime(2024, 1, 31, 10)
    assert rows(got) == [(start, start + datetime.timedelta(hours=1), "BRONX", 1)]


def test_uncommon_crimes_match_and_miss(spark):
    patterns = spark.createDataFrame(
        [("BRONX", "WHITE", "VIOLENT_OFFENSE", 1), ("QUEENS", None, "DRUG_OFFENSE", 1), ("BRONX", "AMERICAN_INDIAN", "VIOLENT_OFFENSE", 2)],
        "BOROUGH string, RACE string, OFFENSE_TYPE string, ranking int",
    )
    events = [
        complaint(1), complaint(2, SUSP_RACE=None), complaint(3, SUSP_RACE="UNKNOWN"),
        complaint(4, PD_DESC="NEVER SEEN"), complaint(5, BORO_NM="bronx"),
        complaint(6, SUSP_RACE="AMERICAN INDIAN/ALASKAN NATIVE"),
        complaint(7, BORO_NM="QUEENS", SUSP_RACE=None, PD_DESC="CANNABIS SALE, 3"),
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    got = feed.uncommon_crimes(feed.parse_complaints(df), patterns)
    assert got.columns == ["CMPLNT_NUM", "CMPLNT_FR_TM", "SUSP_RACE", "PD_DESC", "BORO_NM", "OFFENSE_TYPE"]
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in feed.UNCOMMON_SCHEMA]
    assert [r.CMPLNT_NUM for r in got.orderBy("CMPLNT_NUM").collect()] == ["2", "3", "4", "5", "7"]
    exact = feed.uncommon_crimes(feed.parse_complaints(df), patterns, {"ROBBERY,BANK": "Drug_Offense"})
    assert exact.count() == 7


# Streams.


def test_update_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2, BORO_NM="QUEENS")])
    write_lines(source, "2.json", [complaint(3), complaint(4, "12:00:00")])

    def build(events):
        return feed.complaints_per_hour_and_borough(feed.parse_complaints(events)).drop("timestamp")

    result = build(stream_text(spark, source))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        sink = runs.upsert_sink(out, ["window_str", "boro_nm"])
        runs.run_stream(result, sink, checkpoint, "update", available_now=True).awaitTermination()
        return rows(runs.read_upserted(spark, out, result.schema, ["window_str", "boro_nm"]))

    batch = rows(build(spark.read.text(str(source))))
    assert run() == batch
    assert run() == batch
    write_lines(source, "3.json", [complaint(5)])
    assert run() == rows(build(spark.read.text(str(source))))


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_all_jobs_in_one_session_equal_their_batch_results(spark, tmp_path, mode):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2, "10:59:59", BORO_NM="QUEENS"), complaint(3)])
    write_lines(source, "2.json", [complaint(4), complaint(5, "11:30:00", Latitude=41.0), complaint(6, "bad")])
    patterns = spark.createDataFrame(
        [("BRONX", "WHITE", "VIOLENT_OFFENSE")], "BOROUGH string, RACE string, OFFENSE_TYPE string"
    )
    names = [*jobs.WINDOW_QUERIES, "uncommon_crimes", "save_to_lake"]
    running = [
        jobs.start_query(
            stream_text(spark, source), name, f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/c",
            patterns, mode, available_now=True,
        )
        for name in names
    ]
    for stream in running:
        stream.awaitTermination()
    for name in names:
        batch = jobs.query_result(spark.read.text(str(source)), name, patterns)
        got = jobs.read_result(spark, name, f"{tmp_path}/{name}/out", batch.schema, mode)
        assert rows(got.drop("timestamp")) == rows(batch.drop("timestamp")), name
        assert got.count() > 0


def test_complete_stream_is_sorted_and_keeps_the_last_result(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1)])
    write_lines(source, "2.json", [complaint(2, OFNS_DESC="ARSON"), complaint(3, OFNS_DESC="ARSON")])
    events = feed.parse_complaints(stream_text(spark, source))
    result = feed.in_order(feed.most_common_complaints(events), "complaints_count")
    out = str(tmp_path / "out")
    sink = runs.latest_sink(out)
    runs.run_stream(result, sink, str(tmp_path / "c"), "complete", available_now=True).awaitTermination()
    got = feed.in_order(runs.read_latest(spark, out, result.schema), "complaints_count").collect()
    assert [(r.crime, r.complaints_count) for r in got] == [("ARSON", 2), ("ROBBERY", 1)]


def test_late_row_is_dropped_with_a_watermark_and_counted_without(spark, tmp_path):
    source = tmp_path / "in"
    for name, hour in (("1", 1), ("2", 6), ("3", 12)):
        write_lines(source, f"{name}.json", [complaint(name, f"{hour:02d}:00:00")])

    def run(watermark, folder):
        events = feed.parse_complaints(stream_text(spark, source))
        timed = feed.with_event_time(events).select("event_time")
        counts = flatten_window(tumbling_counts(timed, "event_time", "1 hour", watermark=watermark))
        sink = runs.upsert_sink(f"{folder}/out", ["window_start"])
        runs.run_stream(counts, sink, f"{folder}/c", "update", available_now=True).awaitTermination()
        got = runs.read_upserted(spark, f"{folder}/out", counts.schema, ["window_start"])
        return sorted((r.window_start.hour, r.cnt) for r in got.collect())

    bounded, unbounded = str(tmp_path / "bounded"), str(tmp_path / "unbounded")
    assert run("2 hours", bounded) == run(None, unbounded) == [(1, 1), (6, 1), (12, 1)]
    write_lines(source, "4.json", [complaint("late", "01:30:00"), complaint("new", "12:30:00")])
    assert run("2 hours", bounded) == [(1, 1), (6, 1), (12, 2)]
    assert run(None, unbounded) == [(1, 2), (6, 1), (12, 2)]


def test_append_with_a_watermark_emits_closed_windows_once(spark, tmp_path):
    source = tmp_path / "in"
    for name, hour in (("1", 1), ("2", 2), ("3", 6), ("4", 12)):
        write_lines(source, f"{name}.json", [complaint(name, f"{hour:02d}:00:00")])
    messages = stream_text(spark, source)
    result = jobs.query_result(messages, "unsafest_boroughs", watermark="2 hours")
    out = str(tmp_path / "out")
    sink = runs.folder_sink(out)
    runs.run_stream(result, sink, str(tmp_path / "c"), "append", available_now=True).awaitTermination()
    got = runs.read_appended(spark, out, result.schema).collect()
    assert sorted((r.window_start.hour, r.Felonies) for r in got) == [(1, 1), (2, 1), (6, 1)]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_anti_join_stream_appends_once(spark, tmp_path, monkeypatch, max_rows):
    from lakeops.operators import joins

    monkeypatch.setattr(joins.join_dimension, "__defaults__", ("left", (), max_rows, 1 << 20, 4))
    patterns = spark.createDataFrame([("BRONX", "WHITE", "VIOLENT_OFFENSE", 1)], "BOROUGH string, RACE string, OFFENSE_TYPE string, ranking int")
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2, SUSP_RACE="BLACK")])
    write_lines(source, "2.json", [complaint(3, SUSP_RACE=None), complaint(4)])
    result = feed.uncommon_crimes(feed.parse_complaints(stream_text(spark, source)), patterns)
    out = str(tmp_path / "out")
    for _ in range(2):
        sink = runs.folder_sink(out)
        runs.run_stream(result, sink, str(tmp_path / "c"), "append", available_now=True).awaitTermination()
    got = runs.read_appended(spark, out, result.schema)
    assert sorted(r.CMPLNT_NUM for r in got.collect()) == ["2", "3"]


def test_patterns_reloaded_in_every_batch(spark, tmp_path):
    patterns, source, out = str(tmp_path / "patterns"), tmp_path / "in", str(tmp_path / "out")
    fields = "BOROUGH string, RACE string, OFFENSE_TYPE string"
    spark.createDataFrame([("BRONX", "BLACK", "DRUG_OFFENSE")], fields).write.parquet(patterns)

    def run():
        events = feed.parse_complaints(stream_text(spark, source), "uncommon_crimes")
        sink = feed.uncommon_crimes_sink(lambda: spark.read.parquet(patterns), runs.folder_sink(out))
        runs.run_stream(events, sink, str(tmp_path / "c"), "append", available_now=True).awaitTermination()

    write_lines(source, "1.json", [complaint(1)])
    run()
    spark.createDataFrame([("BRONX", "WHITE", "VIOLENT_OFFENSE")], fields).write.mode("append").parquet(patterns)
    write_lines(source, "2.json", [complaint(2), complaint(3, SUSP_RACE="BLACK")])
    run()
    assert sorted(r.CMPLNT_NUM for r in spark.read.parquet(out).collect()) == ["1", "3"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_archive_is_exactly_once(spark, tmp_path, fmt):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2)])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for name in ("1", "2"):
        write_lines(source, f"{name}.json", [complaint(int(name) * 10), complaint(int(name) * 10 + 1)])
        events = feed.archive_rows(feed.parse_complaints(stream_text(spark, source)))
        runs.archive_stream(events, out, checkpoint, fmt, available_now=True).awaitTermination()
    got = spark.read.format(fmt).option("header", True).schema(COMPLAINT_SCHEMA).load(out)
    assert sorted(r.CMPLNT_NUM for r in got.collect()) == ["10", "11", "20", "21"]


def test_archive_partitioned_by_day(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2, CMPLNT_FR_DT="02/01/2024")])
    events = feed.with_event_time(feed.parse_complaints(stream_text(spark, source)))
    daily = events.withColumn("day", F.to_date("event_time")).drop("event_time")
    out = str(tmp_path / "out")
    runs.archive_stream(daily, out, str(tmp_path / "c"), partition_by=["day"], available_now=True).awaitTermination()
    assert spark.read.parquet(out).where("day = DATE'2024-02-01'").count() == 1


def test_append_once_completes_a_half_written_batch(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "id int, text string, batch_id long"
    spark.createDataFrame([], schema).write.parquet(store)

    def read_batch(session, batch_id):
        return session.read.schema(schema).parquet(store).where(F.col("batch_id") == batch_id)

    sink = runs.append_once(read_batch, lambda df: df.write.mode("append").parquet(store), ["id"])
    first = spark.createDataFrame([(1, "a"), (2, None)], "id int, text string")
    # A crash left one row of micro-batch 7 behind.
    spark.createDataFrame([(1, "a", 7)], schema).write.mode("append").parquet(store)
    sink(first, 7)
    sink(first, 7)
    sink(first, 8)
    assert rows(spark.read.parquet(store)) == sorted([(1, "a", 7), (2, None, 7), (1, "a", 8), (2, None, 8)], key=repr)


def test_folder_sink_replaces_a_replayed_batch(spark, tmp_path):
    sink = runs.folder_sink(str(tmp_path / "out"))
    sink(spark.range(5).toDF("n"), 0)
    sink(spark.range(3).toDF("n"), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def folders(path):
    return sorted(p.name for kind in path.iterdir() for p in kind.iterdir())


def test_complete_results_stay_bounded_and_survive_replays(spark, tmp_path):
    out = tmp_path / "out"
    sink = runs.latest_sink(str(out))
    schema = StructType().add("n", "long")
    for batch in range(7):
        for _ in range(2):
            sink(spark.range(batch + 1).toDF("n"), batch)
        assert runs.read_latest(spark, str(out), schema).count() == batch + 1
    assert len(folders(out)) == 4
    # A half-written next result is not used before its mark.
    runs._stored(spark.range(3).select(F.col("id").alias("n"), F.lit(7).cast("long").alias("upto")), str(out), "whole", 1)
    assert runs.read_latest(spark, str(out), schema).count() == 7
    with pytest.raises(ValueError):
        runs.latest_sink(str(out), keep=1)


def test_changes_are_folded_and_survive_replays(spark, tmp_path):
    out = tmp_path / "out"
    schema = StructType().add("k", "long").add("n", "long")
    sink = runs.upsert_sink(str(out), ["k"], fold_every=2)
    expected = {}
    for batch in range(11):
        changed = {batch % 3: batch, None: batch * 10, 100 + batch: 1}
        expected |= changed
        for _ in range(2):
            sink(spark.createDataFrame(list(changed.items()), schema), batch)
        got = {r.k: r.n for r in runs.read_upserted(spark, str(out), schema, ["k"]).collect()}
        assert got == expected
    assert len(folders(out)) <= 4 + 2 + 2


def test_feed_takes_sink_trigger_pattern_reader_and_archive_format(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [complaint(1), complaint(2, BORO_NM="QUEENS")])
    seen = []
    jobs.start_query(
        stream_text(spark, source), "unsafest_boroughs", "", str(tmp_path / "a"),
        available_now=True, sink=lambda batch, _: seen.extend(r.Borough for r in batch.collect()),
    ).awaitTermination()
    assert sorted(seen) == ["BRONX", "QUEENS"]
    patterns = spark.createDataFrame([("BRONX", "WHITE", "VIOLENT_OFFENSE")], "BOROUGH string, RACE string, OFFENSE_TYPE string")
    out = str(tmp_path / "rare")
    jobs.start_query(
        stream_text(spark, source), "uncommon_crimes", out, str(tmp_path / "b"), lambda: patterns, available_now=True
    ).awaitTermination()
    assert [r.CMPLNT_NUM for r in spark.read.parquet(out).collect()] == ["2"]
    out = str(tmp_path / "lake")
    jobs.start_query(
        stream_text(spark, source), "save_to_lake", out, str(tmp_path / "c"),
        available_now=True, fmt="csv", partition_by=["BORO_NM"],
    ).awaitTermination()
    archived = jobs.read_result(spark, "save_to_lake", out, COMPLAINT_SCHEMA, fmt="csv")
    assert sorted((r.CMPLNT_NUM, r.BORO_NM) for r in archived.collect()) == [("1", "BRONX"), ("2", "QUEENS")]
