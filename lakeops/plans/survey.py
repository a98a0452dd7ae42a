"""From the raw survey file to the table the reports read, and to borough patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.coding import decode, first_flag_label, recode_flag, to_int
from lakeops.functions.numbers import duration_days
from lakeops.operators.assign import cumulative_weights, weighted_assign
from lakeops.operators.columns import blank_negative, drop_sparse_columns
from lakeops.operators.joins import join_dimension
from lakeops.operators.ranking import mine_common_patterns
from lakeops.plans import values

# Survey variables kept as numbers and their names in the report table.
NUMBERS = {
    "V0055Y": "ARREST_YEAR",
    "V0056Y": "ADMISSION_YEAR",
    "V0390": "JAIL_TIME",
    "V0402": "FLAT_YEARS",
    "V0403": "FLAT_MONTHS",
    "V0404": "FLAT_DAYS",
    "V0405": "MIN_YEARS_RANGE",
    "V0406": "MAX_YEARS_RANGE",
    "V0407": "MIN_MONTHS_RANGE",
    "V0408": "MAX_MONTHS_RANGE",
    "V0409": "MIN_DAYS_RANGE",
    "V0410": "MAX_DAYS_RANGE",
    "V0480": "VICTIMS_NUM",
    "V1179": "NERVOUSNESS",
    "V1180": "HOPELESSNESS",
    "V1181": "RESTLESSNESS",
    "V1182": "DEPRESSION",
    "V1183": "EVERYTHING_AN_EFFORT",
    "V1184": "WORTHLESSNESS",
}
# Survey yes/no variables (1 = yes, 2 = no).
FLAGS = {
    "V0491": "KNEW_VICTIM",
    "V1172": "FATHER_SERVED",
    "V1173": "MOTHER_SERVED",
    "V1174": "SIBLING_SERVED",
}
# Coded survey variables, their names and code books.
CODES = {
    "V0022": ("MARITAL_STATUS", values.MARITAL_STATUS),
    "V0062": ("OFFENSE_TYPE", values.OFFENSE_TYPE),
    "V0069": ("VIOLENT_TYPE", values.VIOLENT_TYPE),
    "V0400": ("SENTENCE_TYPE", values.SENTENCE_TYPE),
    "V0401": ("FLAT_TYPE", values.FLAT_TYPE),
    "V0489": ("VICTIM_SEX", values.VICTIM_SEX),
    "V0490": ("VICTIM_AGE_GROUP", values.VICTIM_AGE_GROUP),
    "V0935": ("EDUCATION_LEVEL", values.EDUCATION_LEVEL),
    "V1168": ("PARENTAL_STATUS", values.PARENTAL_STATUS),
}
# Years, months, weeks and days spent in jail.
JAIL_TIME_PARTS = ("V0391", "V0392", "V0393", "V0394")


def drop_unusable_columns(raw: DataFrame) -> DataFrame:
    """The raw survey without the columns that hold no usable number in 90 % of the rows."""
    return drop_sparse_columns(raw, 0.9)


def for_reports(curated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Decoded and renamed survey table with one row per respondent.

    ``keep`` names further columns to carry through unchanged, such as a respondent number.
    """
    used = [*values.RACE_FLAGS, *NUMBERS, *FLAGS, *CODES, *JAIL_TIME_PARTS]
    casted = curated.select(*keep, *[to_int(curated, c).alias(c) for c in used])
    years, months, weeks, days = (F.col(c) for c in JAIL_TIME_PARTS)
    decoded = casted.select(
        *keep,
        *[F.col(code).alias(name) for code, name in NUMBERS.items()],
        *[recode_flag(F.col(code)).alias(name) for code, name in FLAGS.items()],
        first_flag_label(values.RACE_FLAGS, "OTHER").alias("RACE"),
        *[decode(F.col(code), book).alias(name) for code, (name, book) in CODES.items()],
        duration_days(years, months, days, weeks).alias("JAIL_TIME_TOTAL_DAYS"),
    )
    return blank_negative(decoded)


def add_borough(
    survey: DataFrame,
    weights: DataFrame,
    seed: int,
    key: Sequence[str],
    compat: bool = False,
) -> DataFrame:
    """Offense type, race and a borough drawn by the weights of that offense type and race.

    ``weights`` has ``PD_DESC_Mapped``, ``SUSP_RACE_Mapped`` and one percentage column per borough
    named ``<borough>_cumulative_prob``. ``key`` names the columns that identify a respondent.
    """
    columns = {borough: f"{borough}_cumulative_prob" for borough in values.BOROUGHS}
    numbers = weights.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in columns.values()})
    limits = cumulative_weights(numbers, list(columns.values()), compat=compat)
    joined = join_dimension(
        survey.select("OFFENSE_TYPE", "RACE", *key),
        limits.select("PD_DESC_Mapped", "SUSP_RACE_Mapped", *columns.values()),
        {"OFFENSE_TYPE": "PD_DESC_Mapped", "RACE": "SUSP_RACE_Mapped"},
        how="left",
    )
    known = joined.na.fill(0.0, subset=list(columns.values()))
    drawn = weighted_assign(known, columns, "BOROUGH", seed, key)
    return drawn.select("OFFENSE_TYPE", "RACE", "BOROUGH")


def common_patterns(mapped: DataFrame) -> DataFrame:
    """The four highest shares of race and offense type in each borough, ties included."""
    patterns = mine_common_patterns(mapped, "BOROUGH", ["RACE", "OFFENSE_TYPE"], 4)
    return patterns.select("BOROUGH", "RACE", "OFFENSE_TYPE", "ranking")


def show_patterns(patterns: DataFrame) -> DataFrame:
    """All patterns, by borough and rank."""
    return patterns.orderBy("BOROUGH", "ranking", "RACE", "OFFENSE_TYPE")
