"""Loading files twice, changed files, cut-off loads, and the key audit."""

import csv

import pytest

from eligo.__main__ import main
from eligo.operators import audit
from eligo.plans.run import run_ingestion
from eligo.schemas import FEATURES, OUTCOMES
from eligo.sinks import ledger, tables as sinks
from eligo.sources.courts import read_court_paths, with_charge_ids
from tests.helpers import charge, frame

COLUMNS = ["Locality", "HearingDate", "person_id", "CodeSection", "FinalDisposition", "HearingPlea", "CaseType", "Charge", "Class", "Race",
           "Gender", "fips"]


def write_file(folder, name, persons):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(COLUMNS)
        out.writerows([["Town", "2015-01-05", p, "18.2-95", "Guilty", "", "Misdemeanor", "A", "1", "WHITE", "Male", "51"] for p in persons])


def raw(spark, *paths):
    return with_charge_ids(read_court_paths(spark, [str(p) for p in paths]))


def persons(spark, root):
    return sorted(r["person_id"] for r in spark.read.parquet(f"{root}/charges").collect())


def test_double_load_equals_single_load(spark, tmp_path, capsys):
    a, root = tmp_path / "a", str(tmp_path / "db")
    write_file(a, "district_criminal_2015_00.csv", [1, 2, 2])
    write_file(a, "district_criminal_2015_01.csv", [3])
    args = ["ingest", "--csv", f"{a}/*.csv", "--root", root, "--as-of", "2020-01-01", "--append"]
    main(args)
    assert persons(spark, root) == [1, 2, 2, 3]
    main(args)
    assert persons(spark, root) == [1, 2, 2, 3] and "loaded 0 files, 2 were in already" in capsys.readouterr().out
    # The same content under another name and in another folder, and one more file.
    b = tmp_path / "b"
    write_file(b, "district_criminal_2015_07.csv", [3])
    write_file(b, "district_criminal_2015_08.csv", [4])
    write_file(b, "district_criminal_2015_09.csv", [4])
    load = run_ingestion(raw(spark, f"{b}/*.csv"), root, as_of="2020-01-01", clear_existing=False)
    assert load == (["district_criminal_2015_08.csv"], ["district_criminal_2015_07.csv", "district_criminal_2015_09.csv"])
    assert persons(spark, root) == [1, 2, 2, 3, 4]
    # A refresh begins anew.
    run_ingestion(raw(spark, f"{b}/*_08.csv"), root, as_of="2020-01-01")
    assert persons(spark, root) == [4] and [r["status"] for r in ledger.read_ledger(spark, root).collect()] == ["loaded"]


def test_a_changed_file_is_reported(spark, tmp_path):
    a, root = tmp_path / "a", str(tmp_path / "db")
    write_file(a, "district_criminal_2015_00.csv", [1, 2])
    run_ingestion(raw(spark, f"{a}/*.csv"), root, as_of="2020-01-01", clear_existing=False)
    write_file(a, "district_criminal_2015_00.csv", [1, 2, 5])
    write_file(a, "district_criminal_2015_01.csv", [6])
    with pytest.raises(ledger.ChangedFile, match="2015_00"):
        run_ingestion(raw(spark, f"{a}/*.csv"), root, as_of="2020-01-01", clear_existing=False)
    assert persons(spark, root) == [1, 2]


@pytest.mark.parametrize("after_charges", [False, True])
def test_a_load_that_was_cut_off_is_finished_once(spark, tmp_path, monkeypatch, after_charges):
    a, root = tmp_path / "a", str(tmp_path / "db")
    write_file(a, "district_criminal_2015_00.csv", [1, 2])
    real = sinks.write_charges

    def lost(*args, **kw):
        if after_charges:
            real(*args, **kw)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "write_charges", lost)
    with pytest.raises(RuntimeError):
        run_ingestion(raw(spark, f"{a}/*.csv"), root, as_of="2020-01-01", clear_existing=False)
    monkeypatch.undo()
    load = run_ingestion(raw(spark, f"{a}/*.csv"), root, as_of="2020-01-01", clear_existing=False)
    assert len(load.loaded) == 1 and persons(spark, root) == [1, 2]
    assert run_ingestion(raw(spark, f"{a}/*.csv"), root, as_of="2020-01-01", clear_existing=False).loaded == []


def test_double_ids_are_refused(spark, tmp_path):
    from pyspark.sql import functions as F
    a, root = tmp_path / "a", str(tmp_path / "db")
    write_file(a, "district_criminal_2015_00.csv", [1, 2])
    rows = raw(spark, f"{a}/*.csv").withColumn("id", F.lit(7).cast("long"))
    for clear in (True, False):
        with pytest.raises(audit.DuplicateKeys, match="1 x duplicate charge id"):
            run_ingestion(rows, root, as_of="2020-01-01", clear_existing=clear)
    assert not sinks.exists(spark, f"{root}/charges")


def test_key_audit_of_every_problem(spark):
    charges = frame(spark, [charge(i, i, "2015-01-01") for i in (1, 2, 2, 3, 4, None, None)])
    features = spark.createDataFrame([(i, "r") + (None,) * (len(FEATURES) - 2) for i in (1, 1, 2, 8, 3)], FEATURES)
    outcomes = spark.createDataFrame([(i, "r", "x") for i in (1, 2, 2, 9, None)], OUTCOMES)
    got = {r["problem"]: (r["n_ids"], r["n_rows"], r["first_id"]) for r in audit.key_audit(charges, features, outcomes).collect()}
    assert got == {
        "charge without id": (1, 3, None), "duplicate charge id": (1, 5, 2), "duplicate feature": (1, 4, 1), "duplicate outcome": (1, 5, 2),
        "feature without charge": (1, 1, 8), "outcome without charge": (2, 4, 9), "feature without outcome": (2, 3, 3),
        "outcome without feature": (2, 4, 9), "charge without outcome": (2, 3, 3)}
    assert set(got) == set(audit.PROBLEMS)
    assert {r["problem"] for r in audit.key_audit(charges, outcomes=outcomes).collect()} == {p for p in audit.PROBLEMS if "feature" not in p}
    assert all(r["n_ids"] == 0 for r in audit.key_audit(charges.limit(0), features.limit(0), outcomes.limit(0)).collect())
    runs = spark.createDataFrame([("q",)], "id string")
    assert [tuple(r) for r in audit.orphan_runs(outcomes, runs).collect()] == [("r", 5)]


def test_the_audit_is_one_exchange_without_joins(spark):
    rows = frame(spark, [charge(1, 1, "2015-01-01")])
    outcomes = spark.createDataFrame([(1, "r", "x")], OUTCOMES)
    plan = audit.key_counts(rows, None, outcomes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
