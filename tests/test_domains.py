"""Domain tests: disposition values of all kinds, and the prototype's two example persons."""


from eligo import constants as K
from eligo.functions.categories import disposition_category
from eligo.operators.lookback import lookback_flags
from tests.helpers import charge, frame

# Valid codes and others that occur in court files.
DISPOSITIONS = K.VALID_DISPOSITIONS + K.RARE_DISPOSITIONS + ("Prepaid", "Mistrial", "Other", "")
PLEAS = ("Guilty", "Nolo Contendere", "Not Guilty", "Tried In Absentia", "Alford", "", None)


def test_every_disposition_and_plea(spark):
    rows = [(d, p) for d in DISPOSITIONS + (None,) for p in PLEAS]
    df = spark.createDataFrame(rows, "d string, p string").select("d", "p", disposition_category("d", "p").alias("c"))
    for r in df.collect():
        d, p, c = r["d"], r["p"], r["c"]
        base = K.DISPOSITION_CATEGORY_MAP.get(d, d)
        if base == K.DISMISSED and p in K.DEFERRAL_PLEAS:
            assert c == K.DEFERRAL, r
        else:
            assert c == base, r
        if d in K.VALID_DISPOSITIONS:
            assert c in (K.CONVICTION, K.DISMISSED, K.DEFERRAL)


def test_prototype_example_persons(spark):
    a, b = 313180000000698, 270150000000668
    rows = [
        charge(1, a, "2016-12-21", "Infraction", "Prepaid", "G.46.2-878"),
        charge(2, a, "2008-06-26", "Felony", "Guilty", "18.2-250"),
        charge(3, a, "2009-10-29", "Felony", "Sentence/Probation Revoked", "19.2-306"),
        charge(11, b, "2016-12-29", "Misdemeanor", "Nolle Prosequi", "B.46.2-301"),
        charge(12, b, "2000-10-23", "Felony", "Sentence/Probation Revoked", "18.2-95"),
        charge(13, b, "2000-06-07", "Felony", "Resolved", "18.2-95"),
        charge(14, b, "2018-01-08", "Misdemeanor", "Guilty", "B.46.2-301"),
        charge(15, b, "2018-01-08", "Misdemeanor", "Guilty", "18.2-323.1"),
        charge(16, b, "2018-01-08", "Infraction", "Dismissed", "46.2-1013"),
        charge(17, b, "2009-10-19", "Felony", "Guilty", "18.2-250"),
        charge(18, b, "2009-07-14", "Felony", "Nolle Prosequi", "18.2-250"),
        charge(19, b, "2010-02-08", "Misdemeanor", "Guilty In Absentia", "B.46.2-301"),
    ]
    out = {r["id"]: (r["seven_year"], r["ten_year"], r["class_12"], r["class_34"])
           for r in lookback_flags(frame(spark, rows)).collect()}
    expected = {
        1: (False, True, False, False), 2: (False, False, False, False), 3: (True, True, False, False),
        11: (True, True, False, False), 12: (False, False, False, False), 13: (False, False, False, False),
        14: (False, True, False, False), 15: (False, True, False, False), 16: (False, True, False, False),
        17: (False, False, False, False), 18: (False, False, False, False), 19: (True, True, False, False),
    }
    assert out == expected
