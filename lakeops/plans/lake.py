"""The batch pipeline over lake zones: raw -> curated -> consumption -> report tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans import survey as survey_plans
from lakeops.plans.reports import REPORTS
from lakeops.sources.tables import read_table, write_table


def prepare_survey(
    spark: SparkSession, raw: str, curated: str, consumption: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Read the raw tab-separated survey, write the curated and the report table, return the latter.

    Each zone is written once and read back, so a later step never repeats an earlier one.
    """
    source = read_table(spark, raw, "csv", sep="\t")
    write_table(survey_plans.drop_unusable_columns(source), curated, mode="overwrite")
    decoded = survey_plans.for_reports(read_table(spark, curated), keep)
    write_table(decoded, consumption, mode="overwrite")
    return read_table(spark, consumption)


def prepare_patterns(
    spark: SparkSession,
    survey: DataFrame,
    weights: str,
    mapped: str,
    patterns: str,
    seed: int,
    key: Sequence[str],
    compat: bool = False,
) -> DataFrame:
    """Draw boroughs by the weight file, mine common patterns, write both, return the patterns.

    ``key`` names the columns of ``survey`` that identify a respondent (see ``keep`` of
    :func:`prepare_survey`).
    """
    drawn = survey_plans.add_borough(survey, read_table(spark, weights, "csv"), seed, key, compat)
    write_table(drawn, mapped, mode="overwrite")
    write_table(survey_plans.common_patterns(read_table(spark, mapped)), patterns, mode="overwrite")
    return read_table(spark, patterns)


def write_reports(
    survey: DataFrame,
    write: Callable[[DataFrame, str], None],
    reports: Mapping[str, Callable[[DataFrame], DataFrame]] = REPORTS,
) -> None:
    """Compute every report once and hand it to ``write`` with its name."""
    for name, report in reports.items():
        write(report(survey), name)
