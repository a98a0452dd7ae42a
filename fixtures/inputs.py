"""Survey rows and complaints derived from the given tables.

The survey has one respondent per ``lineitem`` row and the complaint feed one message per
``events`` row. The expressions are plain SQL that both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.functions.temporal import iso_text
from lakeops.plans.complaints import parse_complaints
from lakeops.plans.survey import for_reports
from lakeops.plans.values import BOROUGHS
from lakeops.session import shared_dir
from lakeops.sources.events import read_files
from lakeops.sources.tables import publish_json, read_table, write_table

RESPONDENT = "(l_orderkey * 8 + l_linenumber) * 1000 + l_partkey % 1000"

# Raw survey variables, with text, sentinels, negatives and codes outside the code books.
RAW_SURVEY = {
    "V0015": "case when l_linenumber = 1 and l_partkey % 5 = 0 then 1 else 2 end",
    "V0016": "case when l_suppkey % 3 = 0 then 1 else 2 end",
    "V0017": "case when l_orderkey % 3 = 1 then 1 else 2 end",
    "V0018": "case when l_partkey % 17 = 0 then 1 else 2 end",
    "V0019": "case when l_partkey % 13 = 0 then 1 else 2 end",
    "V0020": "case when l_suppkey % 19 = 0 then 1 else 2 end",
    "V0021": "case when l_orderkey % 23 = 0 then 1 else 2 end",
    "V0022": "case when l_partkey % 11 = 0 then 'refused' else cast(l_partkey % 7 as string) end",
    "V0055Y": "year(l_shipdate) + 12",
    "V0056Y": "case when l_partkey % 29 = 0 then null else year(l_shipdate) + 11 end",
    "V0062": "(l_orderkey + l_partkey) % 7",
    "V0069": "l_suppkey % 5",
    "V0390": "l_linenumber - 3",
    "V0391": "cast(floor(l_quantity / 10) as int)",
    "V0392": "l_linenumber",
    "V0393": "l_suppkey % 4",
    "V0394": "l_partkey % 30 - 400",
    "V0400": "l_orderkey % 3",
    "V0401": "l_partkey % 8",
    "V0402": "cast(floor(l_quantity / 5) as int)",
    "V0403": "l_linenumber",
    "V0404": "case when l_suppkey % 9 = 0 then null else l_partkey % 31 - 1 end",
    "V0405": "l_linenumber",
    "V0406": "l_linenumber + l_suppkey % 4",
    "V0407": "l_partkey % 12",
    "V0408": "l_suppkey % 12",
    "V0409": "l_orderkey % 30",
    "V0410": "l_orderkey % 31",
    "V0480": "l_linenumber",
    "V0489": "l_suppkey % 3",
    "V0490": "(l_orderkey + l_linenumber) % 8",
    "V0491": "case when l_partkey % 10 = 0 then null else l_partkey % 2 + 1 end",
    "V0935": "l_partkey % 31 + 1",
    "V1168": "l_orderkey % 15",
    "V1172": "l_suppkey % 10 + 1",
    "V1173": "l_partkey % 20 + 1",
    "V1174": "l_orderkey % 4 + 1",
    "V1179": "l_partkey % 6",
    "V1180": "l_suppkey % 5 + 1",
    "V1181": "case when l_orderkey % 4 = 0 then null else l_linenumber end",
    "V1182": "l_orderkey % 5 - 1",
    "V1183": "case when l_partkey % 9 = 0 then -8 else l_suppkey % 4 + 1 end",
    "V1184": "l_linenumber % 4 + 1",
    # Not used by the reports: unusable in all, in most and in about half of the rows.
    "V9001": "case when l_partkey % 3 = 0 then 'none' else '99' end",
    "V9002": "case when l_partkey % 20 = 0 then 1 else 999 end",
    "V9003": "case when l_partkey % 2 = 0 then null else l_partkey end",
}

_BOROUGH = " ".join(f"when {i} then '{name}'" for i, name in enumerate(BOROUGHS))
COMPLAINT = {
    "CMPLNT_NUM": "cast(event_id as string)",
    "OFNS_DESC": "upper(event_type)",
    "KY_CD": "user_id",
    "PD_DESC": """case event_id % 14
        when 0 then 'ROBBERY,HOME INVASION' when 1 then 'LARCENY,PETIT FROM AUTO'
        when 2 then 'CANNABIS SALE, 3' when 3 then 'TRESPASS 3, CRIMINAL'
        when 4 then 'TRESPASS 2, CRIMINAL' when 5 then 'MISCHIEF, CRIMINAL 4, BY FIRE'
        when 6 then 'SOMETHING NEW' when 8 then 'ASSAULT 3' when 9 then 'FORGERY,ETC.-MISD.'
        when 10 then 'BURGLARY,RESIDENCE,DAY' when 11 then 'CONTROLLED SUBSTANCE, SALE 5'
        when 12 then 'RAPE 9' when 13 then 'LARCENY,NEW KIND' end""",
    "LAW_CAT_CD": """case when event_type in ('purchase', 'error') then 'FELONY'
        when event_type = 'click' then 'MISDEMEANOR' else 'VIOLATION' end""",
    "BORO_NM": f"case user_id % 7 {_BOROUGH} end",
    "SUSP_RACE": """case event_id % 8
        when 0 then 'BLACK' when 1 then 'WHITE HISPANIC' when 2 then 'BLACK HISPANIC'
        when 3 then 'UNKNOWN' when 4 then 'WHITE' when 5 then 'ASIAN / PACIFIC ISLANDER'
        when 6 then 'AMERICAN INDIAN/ALASKAN NATIVE' end""",
    "Latitude": "40.73e0 + (value - 50e0) / 1000e0",
    "Longitude": "-73.99e0 + (user_id - 75) / 1000e0",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def raw_survey(spark: SparkSession, sf_dir: str, id_name: str = "RESPONDENT") -> DataFrame:
    expressions = {id_name: RESPONDENT} | RAW_SURVEY
    return table(spark, sf_dir, "lineitem").selectExpr(
        *[f"{expression} AS {name}" for name, expression in expressions.items()]
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_reports(raw_survey(spark, sf_dir), keep=["RESPONDENT"])


def borough_weights(decoded: DataFrame) -> DataFrame:
    """Whole percentages per offense type and race; one race has no weights."""
    known = decoded.where("OFFENSE_TYPE IS NOT NULL AND RACE <> 'ASIAN'")
    shares = [
        F.floor(F.count_if(F.col("RESPONDENT") % 11 % 6 == i) * 100.0 / F.count("*"))
        .cast("double")
        .alias(f"{borough}_cumulative_prob")
        for i, borough in enumerate(BOROUGHS)
    ]
    return known.groupBy(
        F.col("OFFENSE_TYPE").alias("PD_DESC_Mapped"), F.col("RACE").alias("SUSP_RACE_Mapped")
    ).agg(*shares)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of files.
    return read_files(spark, f"{sf_dir}/{{events.parquet}}", schema)


def complaint_messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages in the complaint format."""
    fields = [F.expr(expression).alias(name) for name, expression in COMPLAINT.items()]
    return publish_json(
        events.select(
            *fields,
            F.date_format("ts", "MM/dd/yyyy").alias("CMPLNT_FR_DT"),
            F.date_format("ts", "HH:mm:ss").alias("CMPLNT_FR_TM"),
            iso_text(F.col("ts")).alias("RPT_DT"),
        )
    )


def complaints(events: DataFrame, query: str | None = None) -> DataFrame:
    return parse_complaints(complaint_messages(events), query)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A small derived table, written once and read back as a dimension would be."""
    folder = shared_dir(df.sparkSession, name)
    write_table(df, folder)
    return read_table(df.sparkSession, folder)
