"""Small hand-made histories with known labels (cutoff 2020-12-31)."""

import datetime as dt

from eligo import constants as K
from eligo.config import RunConfig
from eligo.plans.classify import classify_rows
from tests.helpers import charge, frame

CFG = RunConfig(cutoff_date="2020-12-31")


def labels(spark, rows, cfg=CFG, col="expungability"):
    out = classify_rows(frame(spark, rows), cfg).select("id", col).collect()
    return {r["id"]: r[col] for r in out}


def d(s):
    return dt.date.fromisoformat(s)


def test_clean_dismissal(spark):
    assert labels(spark, [charge(1, 1, "2015-01-01", disp="Dismissed", plea="Not Guilty")]) == {1: K.AUTOMATIC}


def test_dismissal_with_recent_arrest(spark):
    rows = [charge(1, 1, "2015-01-01", disp="Dismissed"), charge(2, 1, "2013-01-01", disp="Dismissed")]
    assert labels(spark, rows) == {1: K.PETITION, 2: K.AUTOMATIC}


def _gap_rows(gap, later_disp="Dismissed", earlier_disp="Dismissed"):
    first = d("2005-01-01")
    return [charge(1, 1, first, disp=earlier_disp), charge(2, 1, first + dt.timedelta(days=gap), disp=later_disp)]


def test_arrest_boundary(spark):
    for gap, expected in ((1095, True), (1096, False)):
        flags = labels(spark, _gap_rows(gap), col="arrest_disqualifier")
        assert flags[2] is expected, gap


def test_seven_and_ten_year_boundaries(spark):
    for gap, n7, n10 in ((2556, True, True), (2557, False, True), (3652, False, True), (3653, False, False)):
        rows = _gap_rows(gap, later_disp="Guilty", earlier_disp="Dismissed")
        out = classify_rows(frame(spark, rows), CFG).filter("id = 1").collect()[0]
        assert out["next_conviction_disqualifier_after_misdemeanor"] is n7, gap
        assert out["next_conviction_disqualifier_after_felony"] is n10, gap
        assert out["next_conviction_delta"] == gap


def test_b_misdemeanor_pending(spark):
    assert labels(spark, [charge(1, 1, "2016-01-01", code="18.2-96")]) == {1: K.AUTOMATIC_PENDING}


def test_same_day_pair(spark):
    rows = [charge(1, 1, "2005-05-05", code="18.2-96"), charge(2, 1, "2005-05-05", code="18.2-266")]
    assert labels(spark, rows) == {1: K.PETITION, 2: K.NOT_ELIGIBLE}
    assert labels(spark, rows, col="base_label") == {1: K.AUTOMATIC, 2: K.NOT_ELIGIBLE}


def test_deferral_a(spark):
    rows = [charge(1, 1, "2010-01-01", disp="Dismissed", plea="Guilty", code="4.1-305")]
    assert labels(spark, rows) == {1: K.AUTOMATIC}
    assert labels(spark, rows, col="code_section_category") == {1: K.CS_A}


def test_lifetime_limit(spark):
    rows = [charge(i, 1, f"{1990 + 4 * i}-01-01", disp="Dismissed") for i in range(4)]
    rows.append(charge(9, 1, "2006-01-01", disp="Guilty", code="18.2-96"))
    out = labels(spark, rows)
    assert out[9] == K.NOT_ELIGIBLE
    assert all(out[i] == K.PETITION for i in range(4))
    assert labels(spark, rows, col="lifetime_disqualifier")[9] is True


def test_lifetime_inside_one_day_orders_by_id(spark):
    # Five eligible convictions on one day: the running count passes 2 at the third id.
    rows = [charge(i, 1, "2001-01-01", disp="Guilty", code="18.2-96") for i in (50, 10, 40, 20, 30)]
    out = labels(spark, rows, col="lifetime_disqualifier")
    assert out == {10: False, 20: False, 30: True, 40: True, 50: True}


def test_felony_dismissal(spark):
    assert labels(spark, [charge(1, 1, "2010-01-01", ctype="Felony", disp="Dismissed")]) == {1: K.PETITION}


def test_null_plea_is_not_deferral(spark):
    out = labels(spark, [charge(1, 1, "2010-01-01", disp="Dismissed", plea=None)], col="disposition_category")
    assert out == {1: K.DISMISSED}


def test_invalid_rows_dropped(spark):
    rows = [charge(1, 1, "2010-01-01", disp="Prepaid"), charge(2, 1, "2010-01-01", ctype="Infraction"),
            charge(3, 1, "2021-01-01"), charge(4, 1, "2010-01-01")]
    assert set(labels(spark, rows)) == {4}


def test_null_person_is_alone(spark):
    # Charges without a person id do not share a history with each other.
    rows = [charge(1, None, "2015-01-01", disp="Dismissed"), charge(2, None, "2014-01-01", disp="Guilty")]
    out = classify_rows(frame(spark, rows), CFG).select("id", "person_id", "has_conviction",
                                                         "expungability").collect()
    got = {r["id"]: (r["person_id"], r["has_conviction"], r["expungability"]) for r in out}
    assert got[1] == (None, False, K.AUTOMATIC)
    assert got[2][1] is True


def test_rules_off_gives_null_flags(spark):
    import dataclasses
    cfg = dataclasses.replace(CFG, sameday_rule=False, lifetime_rule=False)
    rows = [charge(1, 1, "2005-05-05", code="18.2-96"), charge(2, 1, "2005-05-05", code="18.2-266")]
    out = classify_rows(frame(spark, rows), cfg).collect()
    assert {r["id"]: r["expungability"] for r in out} == {1: K.AUTOMATIC, 2: K.NOT_ELIGIBLE}
    assert all(r["sameday_disqualifier"] is None and r["lifetime_disqualifier"] is None for r in out)


def test_randomize_run_id_resolved_once(spark):
    import dataclasses
    cfg = dataclasses.replace(CFG, id="randomize")
    out = classify_rows(frame(spark, [charge(1, 1, "2015-01-01"), charge(2, 2, "2015-01-01")]), cfg)
    ids = {r["run_id"] for r in out.collect()}
    assert len(ids) == 1 and "randomize" not in ids


def test_caller_rule_set(spark):
    """A caller's own rules run through the same pipeline (same-day and lifetime rules included)."""
    from eligo.operators.rules import Rule, RuleSet
    strict = RuleSet("only_clean_dismissals", (
        Rule("clean", K.AUTOMATIC, lambda x: x.dismissed & ~x.convictions & ~x.arrests),
    ))
    rows = [charge(1, 1, "2015-01-01", disp="Dismissed"), charge(2, 2, "2015-01-01", disp="Guilty"),
            charge(3, 2, "2016-06-01", disp="Dismissed")]
    out = classify_rows(frame(spark, rows), CFG, strict).select("id", "expungability").collect()
    assert {r["id"]: r["expungability"] for r in out} == {1: K.AUTOMATIC, 2: K.NOT_ELIGIBLE, 3: K.NOT_ELIGIBLE}


def test_empty_and_all_invalid_inputs(spark):
    from eligo.plans.classify import classify
    features, outcomes = classify(frame(spark, []), CFG)
    assert features.count() == 0 and outcomes.count() == 0
    invalid = [charge(1, 1, "2015-01-01", disp="Prepaid"), charge(2, 2, "2015-01-01", ctype="Infraction")]
    features, outcomes = classify(frame(spark, invalid), CFG)
    assert outcomes.count() == 0 and len(features.columns) == 23
