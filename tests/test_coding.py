"""Decoding, recoding and cleaning on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from lakeops.functions.coding import (
    classify_by_prefix,
    decode,
    first_flag_label,
    normalise_category,
    recode_flag,
    to_int,
)
from lakeops.operators.columns import (
    blank_negative,
    drop_by_prefix,
    drop_sparse_columns,
    missing_profile,
    rename,
    select_cast,
    sparse_columns,
)
from lakeops.plans import values
from lakeops.plans.offenses import OFFENSE_CLASSES


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_decode_unknown_and_null(spark):
    df = spark.createDataFrame([(1,), (6,), (None,), (0,)], "code int")
    book = values.MARITAL_STATUS
    assert column(df, decode(F.col("code"), book)) == ["MARRIED", None, None, None]
    assert column(df, decode(F.col("code"), book, "?")) == ["MARRIED", "?", "?", "?"]


def test_decode_skips_codes_without_label(spark):
    df = spark.createDataFrame([(0,), (1,)], "code int")
    assert column(df, decode(F.col("code"), {0: None, 1: "x"})) == [None, "x"]


def test_normalise_passes_unmapped_through(spark):
    df = spark.createDataFrame([("WHITE HISPANIC",), ("OTHER TEXT",), (None,)], "race string")
    got = column(df, normalise_category(F.col("race"), values.COMPLAINT_RACE))
    assert got == ["HISPANIC", "OTHER TEXT", None]


OFFENSES = [
    ("LARCENY,PETIT FROM AUTO", "Property_Offense"),
    ("PETIT LARCENY OF ANIMAL", "Property_Offense"),
    ("BURGLARY, TRUCK UNKNOWN TIME", "Property_Offense"),
    ("BURGLARS TOOLS,UNCLASSIFIED", "Other_Offense"),
    ("MISCHIEF,CRIMINAL,    UNCL 2ND", "Property_Offense"),
    ("MISCHIEF, CRIMINAL 3 & 2, OF M", "Property_Offense"),
    ("MISCHIEF, CRIMINAL 3&2, BY FIR", "Other_Offense"),
    ("CRIMINAL MIS 2 & 3", "Property_Offense"),
    ("CRIMINAL CONTEMPT 1", "Violent_Offense"),
    ("AGGRAVATED CRIMINAL CONTEMPT", "Other_Offense"),
    ("AGGRAVATED HARASSMENT 2", "Violent_Offense"),
    ("CRIMINAL POSSESSION WEAPON", "Violent_Offense"),
    ("CRIM POS WEAP 4", "Other_Offense"),
    ("CRIMINAL DISPOSAL FIREARM 1", "Other_Offense"),
    ("CHILD, ENDANGERING WELFARE", "Violent_Offense"),
    ("CHILD,OFFENSES AGAINST,UNCLASS", "Other_Offense"),
    ("IMPRISONMENT 2,UNLAWFUL", "Violent_Offense"),
    ("IMPRISONMENT 1,UNLAWFUL", "Other_Offense"),
    ("TRESPASS 1,CRIMINAL", "Other_Offense"),
    ("TRESPASS 2, CRIMINAL", "Public_Order_Offense"),
    ("TRESPASS 3, CRIMINAL", "Other_Offense"),
    ("TRESPASS 4,CRIMINAL SUB 2", "Public_Order_Offense"),
    ("UNAUTH. SALE OF TRANS. SERVICE", "Public_Order_Offense"),
    ("UNAUTHORIZED USE VEHICLE 3", "Property_Offense"),
    ("(null)", "Other_Offense"),
    ("N.Y.C. TRANSIT AUTH. R&R", "Other_Offense"),
    ("DRUG PARAPHERNALIA,   POSSESSE", "Drug_Offense"),
    ("SOMETHING ELSE", "SOMETHING ELSE"),
    (None, None),
]


def test_offense_classes(spark):
    df = spark.createDataFrame([(text,) for text, _ in OFFENSES], "text string")
    got = column(df, normalise_category(F.col("text"), OFFENSE_CLASSES))
    assert list(zip([text for text, _ in OFFENSES], got)) == OFFENSES


def test_first_line_with_a_prefix_wins(spark):
    rules = (("exception", ("LARCENY,BY",)), ("theft", ("LARCENY", "THEFT")), ("other", ("THE", "LAR")))
    df = spark.createDataFrame([("LARCENY,BY X",), ("LARCENY,X",), ("THEFT",), ("THESIS",), ("X LARCENY",), (None,)], "text string")
    assert column(df, classify_by_prefix(F.col("text"), rules)) == ["exception", "theft", "theft", "other", "X LARCENY", None]


def test_prefix_characters_are_literal(spark):
    df = spark.createDataFrame([("NXYXCX TRANSIT",), ("(null)x",)], "text string")
    rules = (("hit", ("N.Y.C.", "(null)")),)
    assert column(df, classify_by_prefix(F.col("text"), rules)) == ["NXYXCX TRANSIT", "hit"]


def test_labels_may_hold_quotes(spark):
    df = spark.createDataFrame([("it's",), ("back\\slash",)], "text string")
    got = column(df, normalise_category(F.col("text"), {"it's": 'a "b"', "back\\slash": "c\\d"}))
    assert got == ['a "b"', "c\\d"]


def test_first_flag_wins(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (None, 1), (None, None)], "a int, b int")
    assert column(df, first_flag_label({"a": "A", "b": "B"}, "OTHER")) == [
        "A", "B", "OTHER", "B", "OTHER",
    ]


def test_recode_leaves_other_values(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "flag int")
    assert column(df, recode_flag(F.col("flag"))) == [1, 0, 9, None]


def test_to_int_of_text_and_numbers(spark):
    df = spark.createDataFrame(
        [("7", 7.9), (" 8 ", float("nan")), ("9.0", 1e12), ("x", None), ("9.x", -1.5), (None, 0.0)],
        "text string, number double",
    )
    assert column(df, to_int(df, "text")) == [7, 8, 9, None, None, None]
    assert column(df, to_int(df, "number")) == [7, None, None, None, -1, 0]


def test_select_cast(spark):
    df = spark.createDataFrame([("5", "a", 1)], "a string, b string, c int")
    assert select_cast(df, ["a", "b"]).collect() == [(5, None)]
    assert select_cast(df, ["a"], "double").collect() == [(5.0,)]


def test_rename_and_drop_by_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "V0001 int, V1002 int, KEPT int")
    renamed = rename(df, {"V0001": "FIRST", "MISSING": "X"})
    assert drop_by_prefix(renamed, ["V0", "V1"]).columns == ["FIRST", "KEPT"]


def test_blank_negative_touches_numbers_only(spark):
    df = spark.createDataFrame([(-1, -0.5, "-3"), (0, 2.0, "x"), (None, None, None)], "a int, b double, c string")
    assert blank_negative(df).collect() == [(None, None, "-3"), (0, 2.0, "x"), (None, None, None)]
    assert blank_negative(df).schema == df.schema


def test_missing_profile_counts_every_convention(spark):
    df = spark.createDataFrame(
        [("9", 9.0), ("99", 999.5), ("999", float("nan")), ("9999", None), ("text", 5.0), (None, 0.0), ("8", 1.0)],
        "a string, b double",
    )
    assert missing_profile(df).collect() == [(6, 4)]


def test_sparse_columns_at_the_limit(spark):
    rows = [(None if i < 9 else 1, None if i < 8 else 1, "text") for i in range(10)]
    df = spark.createDataFrame(rows, "at_limit int, below int, words string")
    assert sparse_columns(df) == ["at_limit", "words"]
    assert drop_sparse_columns(df).columns == ["below"]


def test_profile_of_a_wide_table(spark):
    names = [f"V{i:04d}" for i in range(300)]
    df = spark.range(50).select(
        *[F.when(F.col("id") % 2 == 0, F.lit(9 if i % 3 else 1)).alias(n) for i, n in enumerate(names)]
    )
    profile = missing_profile(df).first()
    assert profile["V0000"] == 25 and profile["V0001"] == 50


def test_offense_table(spark):
    """Every listed description has its class; others pass through, listed prefix or not."""
    others = ["RAPE 9", "LARCENY,NEW KIND", "ESCAPE ROOM", None]
    df = spark.createDataFrame([(t,) for t in [*OFFENSE_CLASSES, *others]], "text string")
    got = column(df, normalise_category(F.col("text"), OFFENSE_CLASSES))
    assert got == [*OFFENSE_CLASSES.values(), *others] and len(OFFENSE_CLASSES) == 253
    assert OFFENSE_CLASSES["ASSAULT 3"] == "Violent_Offense"
    assert OFFENSE_CLASSES["LARCENY,GRAND OF AUTO"] == "Property_Offense"


# Labels written out, so that a wrong entry of a book cannot pass by agreeing with itself.
LABELS = [
    (values.MARITAL_STATUS, {1: "MARRIED", 4: "SEPARATED", 5: "NEVER_MARRIED"}, 5),
    (values.OFFENSE_TYPE, {1: "VIOLENT_OFFENSE", 3: "DRUG_OFFENSE", 5: "OTHER_OFFENSE"}, 5),
    (values.VIOLENT_TYPE, {1: "RAPE", 3: "OTHER_VIOLENT_OFFENSE"}, 3),
    (values.SENTENCE_TYPE, {1: "FLAT", 2: "RANGE"}, 2),
    (values.VICTIM_SEX, {1: "MALE", 2: "FEMALE"}, 2),
    (values.FLAT_TYPE, {1: "LIFE", 4: "DEATH", 6: "SPECIFY_AMOUNT_OF_TIME"}, 6),
    (values.EDUCATION_LEVEL, {1: "ELEMENTARY_FIRST", 9: "HIGH_SCHOOL_NINTH", 16: "COLLEGE_SENIOR",
                              30: "ATTENDED_SCHOOL_IN_ANOTHER_COUNTRY"}, 19),
    (values.PARENTAL_STATUS, {1: "Both Parents", 6: "Grandmother", 13: "Someone Else"}, 13),
    (values.VICTIM_AGE_GROUP, {1: "Under 12 Years", 3: "18 to 24", 6: "55 or Older"}, 6),
    (values.RACE_FLAGS, {"V0015": "HISPANIC", "V0018": "AMERICAN_INDIAN", "V0021": "OTHER"}, 7),
]


@pytest.mark.parametrize("book, some, size", LABELS)
def test_labels_of_the_code_books(book, some, size):
    assert len(book) == size
    assert {code: book[code] for code in some} == some
