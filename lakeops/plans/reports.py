"""The ten reports over the survey table made by ``lakeops.plans.survey.for_reports``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakeops.functions.numbers import duration_days, ratio
from lakeops.operators.ranking import change_over_time, change_text, top_k_shares
from lakeops.operators.shares import (
    conditional_share,
    share_index,
    share_of_total,
    value_stats,
    weighted_code_score,
)
from lakeops.plans.values import FEELINGS


def racial_structure(survey: DataFrame) -> DataFrame:
    shares = share_of_total(survey, "RACE", "Percentage")
    return shares.withColumnRenamed("RACE", "Race").orderBy(F.desc("Percentage"))


def marital_status(survey: DataFrame, label: str = "Marital_Status") -> DataFrame:
    shares = share_of_total(survey, "MARITAL_STATUS", "Percentage")
    return shares.withColumnRenamed("MARITAL_STATUS", label).orderBy(F.desc("Percentage"))


def family_criminal_history(survey: DataFrame) -> DataFrame:
    """Share of each race with a father, mother or sibling who served time."""
    served = [F.col(f"{who}_SERVED") == 1 for who in ("FATHER", "MOTHER", "SIBLING")]
    shares = conditional_share(survey, "RACE", served[0] | served[1] | served[2], "PERCENTAGE")
    return shares.orderBy(F.desc("PERCENTAGE"))


def flat_sentence_stats(survey: DataFrame) -> DataFrame:
    length = duration_days(F.col("FLAT_YEARS"), F.col("FLAT_MONTHS"), F.col("FLAT_DAYS"))
    names = [f"{what}_DURATION_DAYS" for what in ("AVG", "MIN", "MAX")]
    return value_stats(survey, "OFFENSE_TYPE", length, names).orderBy(F.desc(names[2]))


def most_common_feelings(survey: DataFrame) -> DataFrame:
    scores = weighted_code_score(survey, FEELINGS, "FEELING", "summed_score")
    return scores.orderBy(F.desc("summed_score"))


def parental_status_per_race(survey: DataFrame) -> DataFrame:
    top = top_k_shares(survey, "RACE", "PARENTAL_STATUS", 5)
    return top.select("RACE", "PARENTAL_STATUS", "percentage", "ranking").orderBy("RACE", "ranking")


def top_3_crimes_by_race(survey: DataFrame) -> DataFrame:
    known = survey.where(F.col("RACE").isNotNull())
    top = top_k_shares(known, "RACE", "OFFENSE_TYPE", 3, "CRIME_PERCENTAGE")
    ordered = top.orderBy(F.desc("total"), "ranking")
    return ordered.select("RACE", "OFFENSE_TYPE", "CRIME_PERCENTAGE")


def race_share_scaled_by_crime(survey: DataFrame) -> DataFrame:
    index = share_index(survey, "RACE", "OFFENSE_TYPE", "RACE_INDEX")
    return index.orderBy(F.desc("cnt"), F.desc("RACE_INDEX")).drop("cnt")


def races_through_years(survey: DataFrame) -> DataFrame:
    """Yearly counts and shares per race; ``CHANGE`` is text, ``N/A`` in a race's first year."""
    yearly = change_over_time(
        survey, "RACE", "ADMISSION_YEAR", (2008, 2016), ("yearly_race_count", "share", "CHANGE")
    )
    return yearly.withColumn("CHANGE", change_text(F.col("CHANGE"))).orderBy(
        "ADMISSION_YEAR", F.desc("share")
    )


def victim_stats(survey: DataFrame) -> DataFrame:
    """Victims of violent crimes: share by sex, share known to the offender, usual age group.

    Types, sexes and age groups come from code books, so the counts are a handful of rows and one
    scan serves all columns. Equally frequent age groups give a row each; victims of unspecified
    sex have no usual age group.
    """
    violent = survey.where((F.col("OFFENSE_TYPE") == "VIOLENT_OFFENSE") & F.col("VIOLENT_TYPE").isNotNull())
    sums = {"cnt": F.count("*"), "knew": F.sum("KNEW_VICTIM"), "answers": F.count("KNEW_VICTIM")}
    ages = violent.groupBy("VIOLENT_TYPE", "VICTIM_SEX", "VICTIM_AGE_GROUP").agg(
        *[value.alias(name) for name, value in sums.items()]
    )
    sexes = ages.groupBy("VIOLENT_TYPE", "VICTIM_SEX").agg(
        F.collect_list(F.struct("cnt", F.col("VICTIM_AGE_GROUP").alias("age"))).alias("ages"),
        F.max("cnt").alias("top"),
        *[F.sum(name).alias(name) for name in sums],
    )
    of_type = Window.partitionBy("VIOLENT_TYPE")
    total = F.sum("cnt").over(of_type)
    knew = ratio(F.sum("knew").over(of_type), F.sum("answers").over(of_type), digits=None)
    usual = F.filter("ages", lambda entry: entry["cnt"] == F.col("top"))
    usual = F.when(F.col("VICTIM_SEX").isNotNull(), F.transform(usual, lambda entry: entry["age"]))
    return (
        sexes.withColumns(
            {
                "total": total,
                "gender_share": ratio(F.col("cnt"), total, 100.0),
                "knew_vict_perc": F.round(100 * knew, 2),
            }
        )
        .withColumn("VICTIM_AGE_GROUP", F.explode_outer(usual))
        .orderBy(F.desc("total"), F.desc("gender_share"))
        .select(
            "VIOLENT_TYPE",
            F.coalesce("VICTIM_SEX", F.lit("unspecified")).alias("vict_gender"),
            "gender_share",
            "knew_vict_perc",
            "VICTIM_AGE_GROUP",
        )
    )


REPORTS = {
    "racial_structure": racial_structure,
    "marital_status": marital_status,
    "family_criminal_history": family_criminal_history,
    "flat_sentence_stats": flat_sentence_stats,
    "most_common_feelings": most_common_feelings,
    "parental_status_per_race": parental_status_per_race,
    "top_3_crimes_by_race": top_3_crimes_by_race,
    "race_share_scaled_by_crime": race_share_scaled_by_crime,
    "races_through_years": races_through_years,
    "victim_stats": victim_stats,
}
