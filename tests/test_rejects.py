"""Damaged court files: every line is a header, blank, a charge or a reject."""

import random

from eligo.__main__ import main
from eligo.sinks import ledger, rejects as R
from eligo.sources import rejects as S
from eligo.sources.courts import read_court_paths, with_charge_ids
from tests.test_ledger import COLUMNS, persons, write_file

HEAD = ",".join(COLUMNS)
GOOD = "Town,2015-01-05,{},18.2-95,Guilty,,Misdemeanor,\"A, B\",1,WHITE,Male,51"


def reasons(df):
    return sorted((r["source_file"].rsplit("/", 1)[-1], r["reason"], r["line"]) for r in df.collect())


def write(path, lines):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_every_kind_of_damage_is_kept_with_its_reason(spark, tmp_path):
    f = tmp_path / "in" / "district_criminal_2015_00.csv"
    bad = ["Town,2015-01-05,3", GOOD.format(4) + ",more", GOOD.format(5).replace("2015-01-05", "5 Jan"), GOOD.format("x"),
           'Town,2015-01-05,6,18.2-95,Guilty,,Misdemeanor,"A, half']
    write(f, [HEAD, GOOD.format(1), bad[0], "", bad[1], HEAD, bad[2], "   ", bad[3], GOOD.format(2), bad[4], bad[0], GOOD.format("")])
    lines = S.read_court_lines(spark, str(f))
    assert reasons(S.rejected_lines(lines)) == sorted((f.name, reason, line) for line, reason in [
        (bad[0], S.REASONS[0]), (bad[0], S.REASONS[0]), (bad[1], S.REASONS[0]), (bad[2], S.REASONS[1]), (bad[3], S.REASONS[2]),
        (bad[4], S.REASONS[0])])
    good = S.charge_rows(lines).collect()
    assert sorted(str(r["person_id"]) for r in good) == ["1", "2", "None"]
    assert {(r["Charge"], r["Plea"], r["Race"]) for r in good} == {("A, B", None, "WHITE")}
    assert {(r["reason"], r["n"]) for r in S.reject_counts(S.rejected_lines(lines)).collect()} == {
        (S.REASONS[0], 4), (S.REASONS[1], 1), (S.REASONS[2], 1)}


def test_files_without_damage_give_the_same_rows_and_ids(spark, tmp_path):
    a = tmp_path / "a"
    write_file(a, "district_criminal_2015_anon_00.csv", [1, 2, 2, 3])
    write_file(a, "district_criminal_2016_anon_00.csv", [4])
    write(a / "circuit_criminal_2016_anon_01.csv", [
        "fips,Locality,HearingDate,person_id,CodeSection,DispositionCode,HearingPlea,ChargeType,Charge,Class,Race,Sex",
        '51,"City, old",2009-10-19,43,18.2-95,Nolle Prosequi,,Misdemeanor,LARCENY,1,White,Female'])
    one = with_charge_ids(read_court_paths(spark, f"{a}/*.csv"))
    two = with_charge_ids(S.charge_rows(S.read_court_lines(spark, f"{a}/*.csv")))
    assert one.columns == two.columns and one.schema == two.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    prints = lambda df: sorted(map(str, ledger.fingerprints(df).collect()))
    assert prints(one) == prints(two)
    assert S.rejected_lines(S.read_court_lines(spark, f"{a}/*.csv")).count() == 0


def test_no_line_of_randomly_damaged_files_is_lost(spark, tmp_path):
    rng = random.Random(5)
    total = 0
    for i in range(4):
        lines = [GOOD.format(p) for p in range(40)]
        for j in rng.sample(range(40), 15):
            text = lines[j]
            at = rng.randrange(len(text))
            lines[j] = rng.choice([text[:at], text[:at] + rng.choice(',"x') + text[at:], text[at:] or "x"])
        lines = [x for x in lines if x.strip()]
        total += len(lines)
        write(tmp_path / "in" / f"district_criminal_201{i}_00.csv", [HEAD, *lines])
    lines = S.read_court_lines(spark, f"{tmp_path}/in/*.csv")
    n_good, n_bad = S.charge_rows(lines).count(), S.rejected_lines(lines).count()
    assert n_good + n_bad == total and n_bad > 0


def test_loading_writes_both_tables_once(spark, tmp_path, capsys):
    a, root = tmp_path / "a", str(tmp_path / "db")
    write(a / "district_criminal_2015_00.csv", [HEAD, GOOD.format(1), "cut"])
    write(a / "district_criminal_2015_01.csv", [HEAD, "all", "damaged", "damaged"])
    args = ["ingest", "--csv", f"{a}/*.csv", "--root", root, "--as-of", "2020-01-01"]
    for more in ([], ["--append"], ["--append"]):
        main(args + more)
        assert persons(spark, root) == [1]
        assert [(r["file"], r["line"]) for r in R.read_rejects(spark, root).orderBy("file", "line").collect()] == [
            ("district_criminal_2015_00.csv", "cut"), ("district_criminal_2015_01.csv", "all"),
            ("district_criminal_2015_01.csv", "damaged"), ("district_criminal_2015_01.csv", "damaged")]
    assert S.REASONS[0] in capsys.readouterr().out
    # Another load adds its rejects and leaves the earlier ones.
    b = tmp_path / "b"
    write(b / "district_criminal_2016_00.csv", [HEAD, GOOD.format(2), "late"])
    got = R.load_court_files(spark, f"{b}/*.csv", root, as_of="2020-01-01", clear_existing=False)
    assert got.load.loaded == ["district_criminal_2016_00.csv"] and [r["line"] for r in got.rejects.collect()] == ["late"]
    assert R.read_rejects(spark, root).count() == 5 and persons(spark, root) == [1, 2]
    # A refresh begins both tables anew, also where nothing is rejected.
    write(b / "district_criminal_2016_00.csv", [HEAD, GOOD.format(7)])
    R.load_court_files(spark, f"{b}/*.csv", root, as_of="2020-01-01")
    assert R.read_rejects(spark, root).count() == 0 and persons(spark, root) == [7]
    assert not list((tmp_path / "db" / "_staging").iterdir())
