"""Ingest cleaning and court CSV sources."""

import datetime as dt
import os

import pytest

from eligo.functions.text import fix_fips, standardize_race, standardize_race_field, year_from_file_name
from eligo.operators.clean import clean_charges, to_raw_layout
from eligo.sources.courts import read_classified_file, read_court_dir, read_court_files, split_by_layout
from tests.helpers import charge, frame


def test_race_standardisation(spark):
    cases = {
        "Black (Non-Hispanic)": "Black", "WHITE": "White", "caucasian": "White",
        "Asian Or Pacific Islander": "Asian or Pacific Islander", "CAUCASIAN": "White",
        "American Indian": "American Indian or Alaskan Native", "Alaskan Native": "American Indian or Alaskan Native",
        "MISSING": "Unknown", "Other(Includes Not Applicable, Unknown)": "Unknown", "Hispanic": "Hispanic",
        "CAUCASIAN": "White", "EURASIAN": "EURASIAN", None: None,
        # a later rule overrides an earlier one
        "Black Other": "Unknown",
    }
    df = spark.createDataFrame([(k,) for k in cases], "race string")
    got = {r["race"]: r["std"] for r in df.select("race", standardize_race("race").alias("std")).collect()}
    assert got == cases


def test_race_field(spark):
    cases = {"White Caucasian (Non-Hispanic)": "WHITE", " other (x) ": "UNKNOWN", "Missing": "UNKNOWN",
             "American Indian": "AMERICAN INDIAN OR ALASKAN NATIVE", "black": "BLACK"}
    df = spark.createDataFrame([(k,) for k in cases], "race string")
    got = {r["race"]: r["f"] for r in df.select("race", standardize_race_field("race").alias("f")).collect()}
    assert got == cases


def test_fips_pad_never_truncates(spark):
    df = spark.createDataFrame([("1",), ("12",), ("123",), ("51003",), (None,)], "fips string")
    got = [r["f"] for r in df.select(fix_fips("fips").alias("f")).collect()]
    assert got == ["001", "012", "123", "51003", None]


def test_clean_charges_chain(spark):
    rows = [charge(1, 1, "2019-01-01", race="caucasian", fips="7"),
            charge(2, 1, "2030-01-01", race="BLACK", fips="12")]
    out = clean_charges(to_raw_layout(frame(spark, rows)), as_of="2020-01-01").collect()
    assert [(r["id"], r["race"], r["fips"]) for r in out] == [(1, "White", "007")]
    assert out[0]["hearing_date"] == dt.date(2019, 1, 1)


DISTRICT = ("Locality,HearingDate,person_id,CodeSection,FinalDisposition,HearingPlea,CaseType,Charge,Class,Race,"
            "Gender,fips,Extra\n"
            "Town,2016-12-21,42,18.2-250,Guilty,Guilty,Felony,\"POSSESS, DRUG\",5,Black,Male,51,x\n")
CIRCUIT = ("Locality,HearingDate,person_id,CodeSection,DispositionCode,HearingPlea,ChargeType,Charge,Class,Race,Sex,"
           "fips\nCity,2009-10-19,43,18.2-95,Nolle Prosequi,,Misdemeanor,LARCENY,1,White,Female,760\n")


@pytest.fixture
def court_dir(tmp_path):
    (tmp_path / "district_criminal_2016_anon_00.csv").write_text(DISTRICT)
    (tmp_path / "circuit_criminal_2009_anon_01.csv").write_text(CIRCUIT)
    return str(tmp_path)


def test_court_files_both_layouts(spark, court_dir):
    paths = [os.path.join(court_dir, f) for f in sorted(os.listdir(court_dir))]
    df = read_court_files(spark, paths)
    rows = {r["person_id"]: r for r in df.collect()}
    assert rows[42]["DispositionCode"] == "Guilty" and rows[42]["ChargeType"] == "Felony"
    assert rows[42]["Sex"] == "Male" and rows[42]["CourtType"] == "district" and rows[42]["year"] == "2016"
    assert rows[42]["Charge"] == "POSSESS, DRUG"
    assert rows[43]["Plea"] is None and rows[43]["CourtType"] == "circuit" and rows[43]["year"] == "2009"
    assert rows[43]["HearingDate"] == dt.date(2009, 10, 19)


def test_files_are_read_by_column_name_through_to_outcomes(spark, tmp_path):
    """Two files of one layout with their columns in another order, a repeated row and values that cannot be parsed."""
    from eligo.__main__ import main
    from eligo.plans.run import run_classification
    from eligo.config import RunConfig
    from eligo.sinks import tables as sinks
    from eligo.sources.courts import read_court_paths, unparsed_counts, with_charge_ids
    columns = DISTRICT.split("\n")[0].split(",")
    rows = [dict(zip(columns, r)) for r in (
        ["Town", "2015-01-05", "42", "18.2-95", "Guilty", "Guilty", "Misdemeanor", "A, B", "1", "WHITE", "Male", "51", "x"],
        ["Town", "2015-01-05", "42", "18.2-95", "Guilty", "Guilty", "Misdemeanor", "A, B", "1", "WHITE", "Male", "51", "x"],
        ["", "5 May", "43a", "18.2-96", "Dismissed", "", "Felony", "C", "", "black", "Female", "760", ""])]
    (tmp_path / "in").mkdir()
    import csv
    for name, order in (("district_criminal_2015_anon_00.csv", columns), ("district_criminal_2016_anon_01.csv", columns[::-1])):
        with open(tmp_path / "in" / name, "w", newline="") as f:
            out = csv.DictWriter(f, order)
            out.writeheader()
            out.writerows(rows)
    glob = str(tmp_path / "in" / "*.csv")
    raw = read_court_paths(spark, [glob])
    assert {(r["person_id"], r["DispositionCode"], r["Charge"], r["Sex"]) for r in raw.collect()} == {
        (42, "Guilty", "A, B", "Male"), (None, "Dismissed", "C", "Female")}
    assert {(r["column"], r["n"]) for r in unparsed_counts(raw).collect()} == {("HearingDate", 1), ("person_id", 1)}
    ids = [r["id"] for r in with_charge_ids(raw).collect()]
    assert len(set(ids)) == 6 and sorted(ids) == sorted(r["id"] for r in with_charge_ids(raw.repartition(5)).collect())
    root = str(tmp_path / "db")
    main(["ingest", "--csv", glob, "--root", root, "--as-of", "2020-01-01"])
    charges = spark.read.parquet(f"{root}/charges").collect()
    assert len({r["id"] for r in charges}) == 4 and {r["locality"] for r in charges} == {"Town"}
    run_classification(spark, root, RunConfig(id="a"))
    assert sorted(r["charge_id"] for r in sinks.read_run(spark, root, "outcomes", "a").collect()) == sorted(r["id"] for r in charges)


def test_a_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "circuit_criminal_2010_anon_00.csv").write_text("Locality,person_id\nTown,1\n")
    with pytest.raises(ValueError, match="no column HearingDate"):
        read_court_dir(spark, str(tmp_path))


def test_court_dir_glob_with_years(spark, court_dir):
    assert read_court_dir(spark, court_dir, years=[2016], courts=("district",)).count() == 1


def test_unknown_layout_rejected():
    with pytest.raises(ValueError):
        split_by_layout(["/data/traffic_2019.csv"])


def test_year_from_file_name(spark):
    df = spark.createDataFrame([("/x/district_criminal_2019_anon_07.csv",)], "p string")
    assert df.select(year_from_file_name("p").alias("y")).first()["y"] == "2019"


def test_classified_file_reader(spark, tmp_path):
    line = ",".join(["1", "2015-01-01"] + ["v"] * 11 + ["TRUE"] + ["FALSE"] * 14) + "\n"
    path = tmp_path / "classified.csv"
    path.write_text(line * 3)
    df = read_classified_file(spark, str(path), n=2)
    assert len(df.columns) == 28 and df.count() == 2
    row = df.first()
    assert (row["person_id"], row["HearingDate"], row["convictions"], row["lifetime"]) == (1, dt.date(2015, 1, 1), True, False)


def test_race_rules_against_python(spark):
    """Random texts made of rule words: Spark's reverse-order CASE equals 'later rule wins' in Python."""
    import re

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from eligo import constants as K

    words = st.sampled_from(["black", "White", "caucasian", "asian", "EurAsian", "native", "American Indian",
                             "other", "missing", "Unknown", "hispanic", "(x)", " ", "-"])
    texts = st.lists(words, min_size=0, max_size=4).map("".join)

    def py(race):
        if race is None:
            return None
        out = race
        for pattern, label in K.RACE_RULES:
            if re.search(pattern, race.upper()):
                out = label
        return out

    samples = []

    @settings(max_examples=300, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(texts)
    def collect(t):
        samples.append(t)

    collect()
    df = spark.createDataFrame([(t,) for t in samples], "race string")
    for r in df.select("race", standardize_race("race").alias("s")).collect():
        assert r["s"] == py(r["race"]), r


def test_court_dir_path_regex(spark, court_dir):
    df = read_court_dir(spark, court_dir, path_regex="_2009_")
    assert [r["person_id"] for r in df.collect()] == [43]
