"""Randomised histories (with hot persons and hot days) against the brute-force row-level oracle."""

import dataclasses
import random

import pytest

from eligo.config import RunConfig
from eligo.plans.classify import classify_rows
from tests.helpers import charge, frame, oracle

CODES = ["4.1-305", "18.2-250.1", "18.2-96", "18.2-248.1", "18.2-266", "18.2-95", None]
DISPS = ["Guilty", "Guilty In Absentia", "Dismissed", "Nolle Prosequi", "Not Guilty", "Prepaid"]
PLEAS = ["Guilty", "Alford", None, "Not Guilty"]
CLASSES = ["1", "2", "3", "4", "6", None]
CUTOFF = "2019-12-31"


def random_rows(seed, n_people=30, hot_rows=400):
    rnd = random.Random(seed)
    rows, next_id = [], 1
    days = [f"{y}-{m:02d}-01" for y in range(1990, 2021) for m in (1, 4, 7, 10)]
    for person in range(n_people):
        n = hot_rows if person == 0 else rnd.randint(1, 12)
        # The hot person has few distinct days, so many rows share a day.
        person_days = rnd.sample(days, 5) if person == 0 else days
        for _ in range(n):
            rows.append(charge(next_id * 7 % 100003, person if person != n_people - 1 else None,
                               rnd.choice(person_days), ctype=rnd.choice(["Misdemeanor", "Felony"]),
                               disp=rnd.choice(DISPS), code=rnd.choice(CODES), plea=rnd.choice(PLEAS),
                               cls=rnd.choice(CLASSES)))
            next_id += 1
    return rows


COLS = ("expungability, base_label, sameday_disqualifier, lifetime_disqualifier, has_conviction, "
        "last_hearing_delta, last_felony_conviction_delta, next_conviction_delta, has_class_1_or_2, "
        "has_class_3_or_4, arrest_disqualifier, pending_after_misdemeanor")


def spark_result(spark, rows, cfg):
    names = [c.strip() for c in COLS.split(",")]
    out = classify_rows(frame(spark, rows), cfg).select("id", *names).collect()
    return {r["id"]: tuple(r[n] for n in names) for r in out}


def oracle_result(rows, **kw):
    names = [c.strip() for c in COLS.split(",")]
    df = oracle([r for r in rows if r[1] is not None], f"SELECT id, {COLS} FROM final", cutoff=CUTOFF, **kw)
    res = {}
    for rec in df.to_dict("records"):
        vals = []
        for n in names:
            v = rec[n]
            if v is None or (isinstance(v, float) and v != v):
                v = None
            elif n.endswith("_delta"):
                v = int(v)
            elif not isinstance(v, str):
                v = bool(v)
            vals.append(v)
        res[int(rec["id"])] = tuple(vals)
    return res


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("dialect", ["d3", "d2", "d1"])
def test_random_histories_match_oracle(spark, seed, dialect):
    rows = random_rows(seed)
    cfg = RunConfig(cutoff_date=CUTOFF, dialect=dialect)
    got = spark_result(spark, rows, cfg)
    expected = oracle_result(rows, dialect=dialect)
    null_person_ids = {r[0] for r in rows if r[1] is None}
    assert {k: v for k, v in got.items() if k not in null_person_ids} == expected


def test_result_independent_of_partitioning_and_order(spark):
    rows = random_rows(7)
    cfg = RunConfig(cutoff_date=CUTOFF)
    base = spark_result(spark, rows, cfg)
    shuffled = list(rows)
    random.Random(3).shuffle(shuffled)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = frame(spark, shuffled).repartition(5)
        names = [c.strip() for c in COLS.split(",")]
        out = classify_rows(df, cfg).select("id", *names).collect()
        again = {r["id"]: tuple(r[n] for n in names) for r in out}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert again == base


def test_person_independence(spark):
    rows = random_rows(11)
    cfg = RunConfig(cutoff_date=CUTOFF)
    full = spark_result(spark, rows, cfg)
    only_one = [r for r in rows if r[1] == 3]
    alone = spark_result(spark, only_one, cfg)
    assert alone == {k: v for k, v in full.items() if k in alone}


def test_adjustments_never_raise_eligibility(spark):
    rows = random_rows(5)
    out = classify_rows(frame(spark, rows), RunConfig(cutoff_date=CUTOFF)).collect()
    rank = {"Automatic": 0, "Automatic (pending)": 1, "Petition": 2, "Petition (pending)": 3, "Not eligible": 4}
    for r in out:
        assert rank[r["expungability"]] >= rank[r["base_label"]]


def test_rules_off_matches_oracle(spark):
    rows = random_rows(9)
    cfg = dataclasses.replace(RunConfig(cutoff_date=CUTOFF), sameday_rule=False, lifetime_rule=False)
    got = spark_result(spark, rows, cfg)
    expected = oracle_result(rows, sameday=False, lifetime=False)
    null_person_ids = {r[0] for r in rows if r[1] is None}
    assert {k: v for k, v in got.items() if k not in null_person_ids} == expected


def _duck(rows, sql_with_ch):
    import duckdb
    import pandas as pd
    from tests.helpers import COLS
    pdf = pd.DataFrame(rows, columns=COLS)
    con = duckdb.connect()
    con.register("input_rows", pdf)
    con.execute("CREATE TABLE input_charges AS SELECT id::BIGINT AS id, person_id::BIGINT AS person_id, "
                "CAST(hearing_date AS DATE) AS hearing_date, code_section::VARCHAR AS code_section, "
                "charge_type::VARCHAR AS charge_type, charge_class::VARCHAR AS charge_class, "
                "disposition_code::VARCHAR AS disposition_code, plea::VARCHAR AS plea, race::VARCHAR AS race, "
                "sex::VARCHAR AS sex, fips::VARCHAR AS fips FROM input_rows")
    return con.execute(sql_with_ch).fetchall()


def test_lookback_flags_match_oracle(spark):
    from oracle_queries import CH, LOOKBACK
    from eligo.operators.lookback import lookback_flags
    rows = [r for r in random_rows(21) if r[1] is not None]
    got = {r["id"]: (r["seven_year"], r["ten_year"], r["class_12"], r["class_34"])
           for r in lookback_flags(frame(spark, rows)).collect()}
    sql = LOOKBACK.replace(CH, "charges AS (SELECT * FROM input_charges)") + \
        " SELECT id, seven_year, ten_year, class_12, class_34 FROM lb"
    expected = {i: tuple(v) for i, *v in _duck(rows, "WITH " + sql)}
    assert got == expected


def test_mode_impute_matches_oracle(spark):
    from eligo.operators.history import with_person_key
    from eligo.operators.impute import impute_mode
    rnd = random.Random(4)
    rows = []
    for i, r in enumerate(random_rows(13)):
        if r[1] is None:
            continue
        race = rnd.choice(["A", "B", "C", None, None])
        sex = rnd.choice(["F", "M", None])
        rows.append(r[:8] + (race, sex) + r[10:])
    got = {r["id"]: (r["race"], r["sex"])
           for r in impute_mode(with_person_key(frame(spark, rows))).collect()}
    sql = """WITH charges AS (SELECT * FROM input_charges),
      rm AS (SELECT person_id, race FROM (SELECT person_id, race, row_number() OVER (PARTITION BY person_id
             ORDER BY cnt DESC, race) rk FROM (SELECT person_id, race, count(*) cnt FROM charges
             WHERE race IS NOT NULL GROUP BY 1, 2)) WHERE rk = 1),
      sm AS (SELECT person_id, sex FROM (SELECT person_id, sex, row_number() OVER (PARTITION BY person_id
             ORDER BY cnt DESC, sex) rk FROM (SELECT person_id, sex, count(*) cnt FROM charges
             WHERE sex IS NOT NULL GROUP BY 1, 2)) WHERE rk = 1)
      SELECT c.id, coalesce(c.race, rm.race, 'MISSING'), coalesce(c.sex, sm.sex, 'MISSING')
      FROM charges c LEFT JOIN rm ON c.person_id = rm.person_id LEFT JOIN sm ON c.person_id = sm.person_id"""
    expected = {i: (a, b) for i, a, b in _duck(rows, sql)}
    assert got == expected


def boundary_rows(seed, n_people=60):
    """Histories whose day gaps sit at and around the 3/7/10-year thresholds."""
    import datetime as dt
    rnd = random.Random(seed)
    gaps = [1, 1094, 1095, 1096, 2555, 2556, 2557, 3651, 3652, 3653, 0]
    rows, next_id = [], 1
    for person in range(n_people):
        day = dt.date(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 4000))
        for _ in range(rnd.randint(2, 8)):
            rows.append(charge(next_id, person, day, ctype=rnd.choice(["Misdemeanor", "Felony"]),
                               disp=rnd.choice(DISPS[:5]), code=rnd.choice(CODES), plea=rnd.choice(PLEAS),
                               cls=rnd.choice(CLASSES)))
            next_id += 1
            day = day + dt.timedelta(days=rnd.choice(gaps))
    return rows


@pytest.mark.parametrize("dialect", ["d3", "d2"])
def test_boundary_gaps_match_oracle(spark, dialect):
    rows = boundary_rows(17)
    cfg = RunConfig(cutoff_date=CUTOFF, dialect=dialect)
    assert spark_result(spark, rows, cfg) == oracle_result(rows, dialect=dialect)


def test_generated_histories_match_oracle(spark):
    """Hypothesis-generated histories: few persons, many shared days, gaps near the thresholds."""
    import datetime as dt

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    base = dt.date(2000, 1, 1)
    offsets = st.sampled_from([0, 0, 1, 1094, 1095, 1096, 2556, 2557, 3652, 3653, 5000])
    charge_st = st.tuples(
        st.integers(0, 3),                                    # person
        st.lists(offsets, min_size=1, max_size=3).map(sum),   # day offset from 2000-01-01
        st.sampled_from(["Misdemeanor", "Felony"]),
        st.sampled_from(["Guilty", "Dismissed", "Nolle Prosequi", "Guilty In Absentia"]),
        st.sampled_from(["18.2-96", "18.2-266", "18.2-95", "4.1-305", None]),
        st.sampled_from(["Guilty", None, "Alford"]),
        st.sampled_from(["1", "3", "6", None]),
    )
    cases = []

    @settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(charge_st, min_size=1, max_size=25), st.randoms(use_true_random=False))
    def collect(items, rnd):
        ids = rnd.sample(range(1, 10_000), len(items))
        cases.append([charge(i, p, base + dt.timedelta(days=d), ctype=t, disp=disp, code=code, plea=plea, cls=cls)
                      for i, (p, d, t, disp, code, plea, cls) in zip(ids, items)])

    collect()
    rows = [r for case in cases for r in case]
    # Give each case its own persons so one Spark run checks every case.
    shifted = []
    for n, case in enumerate(cases):
        shifted += [(r[0] + n * 10_000, r[1] + n * 10,) + r[2:] for r in case]
    cfg = RunConfig(cutoff_date=CUTOFF)
    assert spark_result(spark, shifted, cfg) == oracle_result(shifted)
    assert rows


@pytest.mark.parametrize("limit", [0, 1, 3])
def test_other_lifetime_limits_match_oracle(spark, limit):
    import dataclasses as dc
    rows = random_rows(31)
    cfg = dc.replace(RunConfig(cutoff_date=CUTOFF), lifetime_limit=limit)
    got = spark_result(spark, rows, cfg)
    expected = oracle_result(rows, limit=limit)
    null_person_ids = {r[0] for r in rows if r[1] is None}
    assert {k: v for k, v in got.items() if k not in null_person_ids} == expected


@pytest.mark.parametrize("sameday,lifetime", [(False, True), (True, False)])
def test_one_rule_off_matches_oracle(spark, sameday, lifetime):
    rows = random_rows(41)
    cfg = dataclasses.replace(RunConfig(cutoff_date=CUTOFF), sameday_rule=sameday, lifetime_rule=lifetime)
    got = spark_result(spark, rows, cfg)
    expected = oracle_result(rows, sameday=sameday, lifetime=lifetime)
    null_person_ids = {r[0] for r in rows if r[1] is None}
    assert {k: v for k, v in got.items() if k not in null_person_ids} == expected
