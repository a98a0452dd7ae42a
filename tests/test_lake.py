"""Files, reports and the batch pipeline end to end on a small raw survey."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter, functions as F

from lakeops.plans import lake, reports, survey as survey_plans, values
from lakeops.session import shared_dir
from lakeops.sources import tables
from lakeops.sources.events import read_kafka, write_kafka
from lakeops.streaming import runs


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


NAMES = [
    *values.RACE_FLAGS, *survey_plans.NUMBERS, *survey_plans.FLAGS, *survey_plans.CODES,
    *survey_plans.JAIL_TIME_PARTS,
]


def person(number, **codes):
    plain = dict.fromkeys(NAMES, 1) | dict.fromkeys(values.RACE_FLAGS, 2)
    return {"ID": number, "EMPTY": "refused"} | plain | codes


PEOPLE = [
    person(1, V0015=1, V0016=1, V0062=1, V0069=2, V0489=1, V0490=3, V0491=1, V0056Y=2008),
    person(2, V0016=1, V0062=1, V0069=2, V0489=1, V0490=4, V0491=2, V0056Y=2008),
    person(3, V0016=1, V0062=1, V0069=2, V0489=2, V0490=4, V0491=2, V0056Y=2010),
    person(4, V0062=1, V0069=2, V0489=9, V0490=5, V0491="", V0056Y=2007),
    person(5, V0017=1, V0062=0, V0069="", V0022="text", V0391=-8, V0402=-1, V1172=2, V1173=2, V1174=2),
    person(6, V0017=1, V0062=3, V0069=1, V0022=9, V0935=30, V1168=13, V0404="", V1172=9, V1173=2, V1174=2),
]


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    names = list(PEOPLE[0])
    lines = ["\t".join(names), *["\t".join(str(p[n]) for n in names) for p in PEOPLE]]
    (folder / "survey.tsv").write_text("\n".join(lines) + "\n")
    return str(folder / "survey.tsv")


@pytest.fixture(scope="module")
def decoded(spark, raw_path, tmp_path_factory):
    zones = tmp_path_factory.mktemp("zones")
    return lake.prepare_survey(spark, raw_path, f"{zones}/curated", f"{zones}/consumption", ["ID"])


def test_pipeline_columns_and_dropped_column(spark, raw_path, decoded):
    assert "EMPTY" not in decoded.columns
    assert len(decoded.columns) == 35
    assert not [c for c in decoded.columns if c.startswith("V0") or c.startswith("V1")]
    raw = tables.read_table(spark, raw_path, "csv", sep="\t")
    assert survey_plans.drop_unusable_columns(raw).columns == [c for c in raw.columns if c != "EMPTY"]


def test_decoding(decoded):
    people = {int(row.ID): row for row in decoded.collect()}
    assert [people[i].RACE for i in range(1, 7)] == ["HISPANIC", "WHITE", "WHITE", "OTHER", "BLACK", "BLACK"]
    assert people[5].MARITAL_STATUS is None and people[6].MARITAL_STATUS is None
    assert people[5].JAIL_TIME_TOTAL_DAYS is None and people[1].JAIL_TIME_TOTAL_DAYS == 403
    assert people[5].FLAT_YEARS is None
    assert people[2].KNEW_VICTIM == 0 and people[4].KNEW_VICTIM is None
    assert people[6].FATHER_SERVED == 9 and people[6].MOTHER_SERVED == 0
    assert people[6].EDUCATION_LEVEL == "ATTENDED_SCHOOL_IN_ANOTHER_COUNTRY"
    assert people[6].PARENTAL_STATUS == "Someone Else"
    assert people[5].OFFENSE_TYPE is None and people[5].VIOLENT_TYPE is None


def test_victim_stats_ties_and_unspecified_sex(decoded):
    assert rows(reports.victim_stats(decoded)) == sorted(
        [
            ("MURDER_MANSLAUGHTER_HOMICIDE", "MALE", 50.0, 33.33, "18 to 24"),
            ("MURDER_MANSLAUGHTER_HOMICIDE", "MALE", 50.0, 33.33, "25 to 34"),
            ("MURDER_MANSLAUGHTER_HOMICIDE", "FEMALE", 25.0, 33.33, "25 to 34"),
            ("MURDER_MANSLAUGHTER_HOMICIDE", "unspecified", 25.0, 33.33, None),
        ]
    )


def test_races_through_years(decoded):
    assert rows(reports.races_through_years(decoded)) == [
        (2008, "HISPANIC", 1, 50.0, "N/A"),
        (2008, "WHITE", 1, 50.0, "N/A"),
        (2010, "WHITE", 1, 100.0, "50.0"),
    ]


def test_family_history_leaves_out_races_without_hits(decoded):
    assert rows(reports.family_criminal_history(decoded)) == [
        ("HISPANIC", 100.0), ("OTHER", 100.0), ("WHITE", 100.0),
    ]


def test_flat_sentences_need_a_positive_length(decoded):
    got = {row.OFFENSE_TYPE: row for row in reports.flat_sentence_stats(decoded).collect()}
    assert set(got) == {"VIOLENT_OFFENSE"}
    assert got["VIOLENT_OFFENSE"].AVG_DURATION_DAYS == 396.0


def test_report_order(decoded):
    got = [row.Percentage for row in reports.racial_structure(decoded).collect()]
    assert got == sorted(got, reverse=True)


def test_every_report_is_written_once(decoded):
    written = {}
    lake.write_reports(decoded, lambda df, name: written.setdefault(name, df.columns))
    assert list(written) == list(reports.REPORTS)
    assert written["marital_status"] == ["Marital_Status", "Percentage"]
    assert written["racial_structure"] == ["Race", "Percentage"]


def test_patterns_pipeline(spark, decoded, tmp_path):
    names = ["PD_DESC_Mapped", "SUSP_RACE_Mapped", *[f"{b}_cumulative_prob" for b in values.BOROUGHS]]
    lines = [",".join(names), "VIOLENT_OFFENSE,WHITE,0,100,0,0,0,0"]
    (tmp_path / "weights.csv").write_text("\n".join(lines) + "\n")
    patterns = lake.prepare_patterns(
        spark, decoded, str(tmp_path / "weights.csv"), str(tmp_path / "m"), str(tmp_path / "p"), 3, ["ID"]
    )
    assert patterns.columns == ["BOROUGH", "RACE", "OFFENSE_TYPE", "ranking"]
    assert spark.read.parquet(str(tmp_path / "m")).count() == len(PEOPLE)
    shown = [(r.BOROUGH, r.ranking) for r in survey_plans.show_patterns(patterns).collect()]
    assert len(shown) == patterns.count() and shown == sorted(shown)


def test_csv_round_trip_keeps_names_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "t string, n int")
    path = str(tmp_path / "t")
    tables.write_table(df, path, "csv")
    assert rows(tables.read_table(spark, path, "csv", schema=df.schema)) == rows(df)
    assert tables.read_table(spark, path, "csv").schema["n"].dataType.simpleString() == "string"
    with pytest.raises(AnalysisException):
        tables.write_table(df, path, "csv")


def test_event_file_without_its_index_column(spark, tmp_path):
    (tmp_path / "e.csv").write_text(",A,B\n0,x,1\n1,y,2\n")
    assert rows(tables.read_event_csv(spark, str(tmp_path / "e.csv"))) == [("x", "1"), ("y", "2")]
    (tmp_path / "f.csv").write_text("Unnamed: 0,A\n0,x\n")
    assert rows(tables.read_event_csv(spark, str(tmp_path / "f.csv"))) == [("x",)]


def test_views_and_sql(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    tables.register_view(df, "numbers_view")
    assert tables.run_sql(spark, "SELECT SUM(n) FROM numbers_view").first()[0] == 3
    assert tables.run_sql(spark, "SELECT MAX(n) FROM {mine}", mine=df).first()[0] == 2


class _Settings:
    """Stands for a session with these settings."""

    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


@pytest.mark.parametrize("checkpoint, base", [("hdfs://x/c/", "hdfs://x/c"), ("", "hdfs://x/w"), (None, "hdfs://x/w")])
def test_shared_dir_is_the_setting_or_else_the_warehouse(checkpoint, base):
    session = _Settings(spark__checkpoint__dir=checkpoint, spark__sql__warehouse__dir="hdfs://x/w")
    assert shared_dir(session, "x").startswith(f"{base}/x-")


def test_shared_dir_is_new_each_time(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


# Databases and brokers: what would be sent, as none can be started here.


@pytest.fixture()
def jdbc_calls(monkeypatch):
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    return calls


def test_jdbc_report(spark, jdbc_calls):
    tables.write_jdbc(spark.range(1), "jdbc:x", "report", {"user": "u"})
    assert jdbc_calls == [("jdbc:x", "report", {"user": "u"})]


def test_jdbc_replace_sink(spark, jdbc_calls):
    runs.jdbc_replace_sink("jdbc:x", "status", {})(spark.range(1), 4)
    assert jdbc_calls == [("jdbc:x", "status", {})]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_kafka(spark, "host:9092")
    with pytest.raises(AnalysisException, match="kafka"):
        write_kafka(spark.createDataFrame([("{}",)], "value string"), "host:9092")
