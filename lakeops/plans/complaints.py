"""The six queries over the complaint feed; each takes parsed events, from a stream or a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.coding import classify_by_prefix, normalise_category
from lakeops.functions.numbers import within_radius
from lakeops.functions.temporal import event_time, window_text
from lakeops.operators.joins import join_dimension
from lakeops.plans import values
from lakeops.plans.offenses import OFFENSE_CLASSES
from lakeops.sources.events import parse_json_events
from lakeops.streaming.runs import BatchSink
from lakeops.streaming.windows import flatten_window, tumbling_counts, window_status


# Fields of the message that each query reads; the archive takes all of them.
FIELDS = {
    "complaints_per_hour_and_borough": ("CMPLNT_FR_DT", "CMPLNT_FR_TM", "BORO_NM"),
    "most_common_complaints": ("CMPLNT_FR_DT", "CMPLNT_FR_TM", "OFNS_DESC"),
    "unsafest_boroughs": ("CMPLNT_FR_DT", "CMPLNT_FR_TM", "LAW_CAT_CD", "BORO_NM"),
    "location_safety": (
        "CMPLNT_FR_DT", "CMPLNT_FR_TM", "LAW_CAT_CD", "BORO_NM", "Latitude", "Longitude",
    ),
    "uncommon_crimes": ("CMPLNT_NUM", "CMPLNT_FR_TM", "SUSP_RACE", "PD_DESC", "BORO_NM"),
}


def parse_complaints(messages: DataFrame, query: str | None = None) -> DataFrame:
    """Complaints from JSON messages, with only the fields one query reads where it is named."""
    return parse_json_events(messages, values.COMPLAINT_SCHEMA, columns=FIELDS.get(query))


def with_event_time(events: DataFrame, dated: bool = True) -> DataFrame:
    """Add ``event_time`` from the complaint's date and time.

    With ``dated`` off only the time of day is used, placed on the current day.
    """
    day = F.col("CMPLNT_FR_DT") if dated else None
    return events.withColumn("event_time", event_time(F.col("CMPLNT_FR_TM"), day))


def known_felonies(events: DataFrame) -> DataFrame:
    """Felonies in a known borough."""
    borough = F.col("BORO_NM")
    return events.where(
        (F.col("LAW_CAT_CD") == "FELONY") & (borough != "UNKNOWN") & borough.isNotNull()
    )


def _stamped(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(
        window_text(F.col("window")).alias("window_str"),
        *columns,
        F.current_timestamp().alias("timestamp"),
    )


def complaints_per_hour_and_borough(
    events: DataFrame, watermark: str | None = None, dated: bool = True
) -> DataFrame:
    timed = with_event_time(events, dated).select("event_time", F.col("BORO_NM").alias("boro_nm"))
    counts = tumbling_counts(
        timed, "event_time", "1 hour", ["boro_nm"], "complaints_count", watermark
    )
    return _stamped(counts, "boro_nm", "complaints_count")


def most_common_complaints(
    events: DataFrame, watermark: str | None = None, dated: bool = True
) -> DataFrame:
    timed = with_event_time(events, dated).select("event_time", F.col("OFNS_DESC").alias("crime"))
    counts = tumbling_counts(timed, "event_time", "1 hour", ["crime"], "complaints_count", watermark)
    return _stamped(counts, "crime", "complaints_count")


def unsafest_boroughs(
    events: DataFrame, watermark: str | None = None, dated: bool = True
) -> DataFrame:
    """Felonies per hour and borough."""
    timed = with_event_time(known_felonies(events), dated)
    timed = timed.select("event_time", F.col("BORO_NM").alias("Borough"))
    counts = tumbling_counts(timed, "event_time", "1 hour", ["Borough"], "Felonies", watermark)
    return flatten_window(counts).withColumn("timestamp", F.current_timestamp())


def location_safety(
    events: DataFrame,
    centre: tuple[float, float] = values.SAFETY_CENTRE,
    radius: float = values.SAFETY_RADIUS,
    watermark: str | None = None,
    dated: bool = True,
) -> DataFrame:
    """Whether two-hour windows with known felonies were unsafe around a place."""
    timed = with_event_time(known_felonies(events), dated)
    timed = timed.select("event_time", "Longitude", "Latitude")
    near = within_radius(F.col("Longitude"), F.col("Latitude"), centre, radius)
    status = window_status(
        timed, "event_time", "2 hours", near, values.UNSAFE_FROM, name="safety", watermark=watermark
    )
    return _stamped(status, "safety")


# Columns of :func:`uncommon_crimes`, known without the patterns.
UNCOMMON_SCHEMA = StructType(
    [
        StructField("CMPLNT_NUM", StringType()),
        StructField("CMPLNT_FR_TM", StringType()),
        StructField("SUSP_RACE", StringType()),
        StructField("PD_DESC", StringType()),
        StructField("BORO_NM", StringType()),
        StructField("OFFENSE_TYPE", StringType()),
    ]
)


def uncommon_crimes(
    events: DataFrame,
    patterns: DataFrame,
    offense_classes: Mapping[str, str] = OFFENSE_CLASSES,
    races: Mapping[str, str] = values.COMPLAINT_RACE,
    prefix_rules: Sequence[tuple[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Complaints whose borough, race and offense class match no common pattern.

    Complaints lacking one of the three match nothing and are kept. Offense classes come from
    ``offense_classes``; other descriptions stand for themselves. With ``prefix_rules`` they come
    from those instead.
    """
    description = F.col("PD_DESC")
    if prefix_rules is None:
        offense = normalise_category(description, offense_classes)
    else:
        offense = classify_by_prefix(description, prefix_rules)
    mapped = events.select(
        "CMPLNT_NUM",
        "CMPLNT_FR_TM",
        "SUSP_RACE",
        "PD_DESC",
        "BORO_NM",
        offense.alias("OFFENSE_TYPE"),
        normalise_category(F.col("SUSP_RACE"), races).alias("RACE"),
    )
    keys = {"BORO_NM": "BOROUGH", "RACE": "RACE", "OFFENSE_TYPE": "OFFENSE_TYPE"}
    return join_dimension(
        mapped, patterns, keys, how="left_anti", ignore_case=["OFFENSE_TYPE"]
    ).drop("RACE")


def uncommon_crimes_sink(read_patterns: Callable[[], DataFrame], sink: BatchSink) -> BatchSink:
    """Sink for parsed complaints that looks up the newest patterns in every micro-batch.

    :func:`uncommon_crimes` on a stream keeps the patterns it was started with.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(uncommon_crimes(batch, read_patterns()), batch_id)

    return run


def archive_rows(events: DataFrame) -> DataFrame:
    """The complaint's 35 fields, as archived."""
    return events.select(*values.COMPLAINT_SCHEMA.names)


def in_order(result: DataFrame, count: str | None = None) -> DataFrame:
    """Rows by window, then by count from high to low; on a stream only in ``complete`` mode."""
    start = ["window_start"] if "window_start" in result.columns else ["window_str"]
    keys: Sequence = [*start, *([F.desc(count)] if count else [])]
    return result.orderBy(*keys)
