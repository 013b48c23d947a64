"""Exhaustive rule-table checks: Spark CASE vs a plain-Python sequential-override evaluation."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import types as T

from eligo import constants as K
from eligo.operators import rules as R
from eligo.schemas import DECISION_KEYS


def py_label(row, strict_pending: bool) -> str:
    """Later writes win, exactly as the rule table is written."""
    cc, dc, cs = row["charge_category"], row["disposition_category"], row["code_section_category"]
    arr, conv, fel = row["arrest_disqualifier"], row["has_conviction"], row["felony_conviction_disqualifier"]
    n7, n10 = row["next_conviction_disqualifier_after_misdemeanor"], row["next_conviction_disqualifier_after_felony"]
    p7, p10 = row["pending_after_misdemeanor"], row["pending_after_felony"]
    c12, c34 = row["has_class_1_or_2"], row["has_class_3_or_4"]
    ok3 = (not c34) or (not fel) or (not c12)
    ok3p = ((not c34) and (not fel) and (not c12)) if strict_pending else ok3
    M, F = cc == K.MISDEMEANOR, cc == K.FELONY
    s1 = dc == K.DISMISSED and M and not arr and not conv
    s2 = dc == K.DEFERRAL and M and cs == K.CS_A
    s3 = dc == K.CONVICTION and M and cs in (K.CS_A, K.CS_B) and not n7
    s4 = s3 and p7
    s5 = dc == K.DEFERRAL and M and cs in (K.CS_ELSEWHERE, K.CS_B)
    s6 = dc == K.DISMISSED and F
    s7 = dc == K.DISMISSED and M and (arr or conv)
    s8 = dc in (K.CONVICTION, K.DEFERRAL) and F and cs != K.CS_12 and ok3 and not n10
    s9 = dc == K.CONVICTION and M and cs == K.CS_ELSEWHERE and ok3 and not n7
    s10 = dc in (K.CONVICTION, K.DEFERRAL) and F and cs != K.CS_12 and ok3p and not n10 and p10
    s11 = dc == K.CONVICTION and M and cs == K.CS_ELSEWHERE and ok3p and not n7 and p7
    label = K.NOT_ELIGIBLE
    if s1 or s2 or s3:
        label = K.AUTOMATIC
    if s4:
        label = K.AUTOMATIC_PENDING
    if s5 or s6 or s7 or s8 or s9:
        label = K.PETITION
    if s10 or s11:
        label = K.PETITION_PENDING
    return label


EXPECTED = {
    "d3": {K.AUTOMATIC: 1280, K.AUTOMATIC_PENDING: 256, K.PETITION: 5392, K.PETITION_PENDING: 784,
           K.NOT_ELIGIBLE: 4576},
    "d2": {K.AUTOMATIC: 1280, K.AUTOMATIC_PENDING: 256, K.PETITION: 6064, K.PETITION_PENDING: 112,
           K.NOT_ELIGIBLE: 4576},
}


@pytest.mark.parametrize("name,rule_set,strict", [("d3", R.D3, False), ("d2", R.D2, True)])
def test_decision_table_matches_python(spark, name, rule_set, strict):
    table = R.decision_table(spark, rule_set)
    rows = table.collect()
    assert len(rows) == 12288
    assert len({tuple(r[k] for k in DECISION_KEYS) for r in rows}) == 12288
    assert Counter(r["expungability"] for r in rows) == EXPECTED[name]
    for r in rows:
        assert r["expungability"] == py_label(r.asDict(), strict), r


def test_python_enumeration_agrees():
    rows = R.decision_table_rows(lambda row: py_label(row, False))
    assert Counter(r["expungability"] for r in rows) == EXPECTED["d3"]


D1_KEYS = ("charge_category", "disposition_category", "code_section_category",
           "next_conviction_disqualifier_after_misdemeanor", "next_conviction_disqualifier_after_felony",
           "same_day_charge", "lifetime_flag", "has_conviction", "arrest_disqualifier", "has_class_1_or_2",
           "has_class_3_or_4", "any_felony")


def py_label_d1(r):
    M, F = r["charge_category"] == K.MISDEMEANOR, r["charge_category"] == K.FELONY
    dc, cs = r["disposition_category"], r["code_section_category"]
    bad = r["has_class_1_or_2"] or r["has_class_3_or_4"] or r["any_felony"] or r["same_day_charge"]
    n7, n10 = r["next_conviction_disqualifier_after_misdemeanor"], r["next_conviction_disqualifier_after_felony"]
    conv, arr = r["has_conviction"], r["arrest_disqualifier"]
    label = None
    if M and dc == K.DISMISSED and not conv and not arr:
        label = K.AUTOMATIC
    if M and dc != K.CONVICTION and (dc == K.DEFERRAL or conv or arr):
        label = K.PETITION
    if M and dc == K.CONVICTION and not n7 and not bad and cs in (K.CS_A, K.CS_B):
        label = K.AUTOMATIC
    if M and dc == K.CONVICTION and not n7 and not bad and cs == K.CS_ELSEWHERE:
        label = K.PETITION
    if M and dc == K.CONVICTION and (n7 or bad or cs == K.CS_12_D1):
        label = K.NOT_ELIGIBLE
    if F and cs != K.CS_12_D1 and not n10 and not bad:
        label = K.PETITION
    if F and (cs == K.CS_12_D1 or n10 or bad):
        label = K.NOT_ELIGIBLE
    return label


def test_first_rule_table(spark):
    domains = [(K.MISDEMEANOR, K.FELONY), (K.CONVICTION, K.DISMISSED, K.DEFERRAL),
               (K.CS_A, K.CS_B, K.CS_12_D1, K.CS_ELSEWHERE)] + [(False, True)] * 9
    combos = list(itertools.product(*domains))
    assert len(combos) == 12288
    schema = T.StructType([T.StructField(k, T.StringType() if i < 3 else T.BooleanType())
                           for i, k in enumerate(D1_KEYS)])
    df = spark.createDataFrame(combos, schema).withColumn("label", R.D1.label())
    for r in df.collect():
        expected = py_label_d1(r.asDict())
        assert expected is not None  # every combination is covered by some rule
        assert r["label"] == expected


def test_lookup_join_equals_case(spark):
    table = R.decision_table(spark)
    probe = table.select(*DECISION_KEYS).withColumnRenamed("charge_category", "charge_category")
    joined = R.lookup_labels(probe, table)
    assert joined.count() == 12288
    assert joined.filter("expungability IS NULL").count() == 0
