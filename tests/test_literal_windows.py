"""The strict-day window features equal the literal shift / fill / same-day repair definition."""

import random

import pandas as pd

from eligo.config import RunConfig
from eligo.plans.classify import classify_rows
from tests.helpers import charge, frame


def literal(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per person sorted by (date, id): lag 1 / last felony conviction before / next conviction after,
    then every row of a (person, day) takes the first row's value (backward) or the last row's (forward)."""
    pdf = pdf.sort_values(["person_id", "hearing_date", "id"]).reset_index(drop=True)
    g = pdf.groupby("person_id")
    pdf["last_hearing"] = g["hearing_date"].shift(1)
    conv = pdf["disposition_category"] == "Conviction"
    pdf["conv_date"] = pdf["hearing_date"].where(conv)
    pdf["fel_conv_date"] = pdf["conv_date"].where(pdf["charge_type"] == "Felony")
    pdf["last_fel"] = pdf.groupby("person_id")["fel_conv_date"].shift(1)
    pdf["last_fel"] = pdf.groupby("person_id")["last_fel"].ffill()
    pdf["next_conv"] = pdf.groupby("person_id")["conv_date"].shift(-1)
    pdf["next_conv"] = pdf.groupby("person_id")["next_conv"].bfill()
    day = pdf.groupby(["person_id", "hearing_date"])
    pdf["last_hearing"] = day["last_hearing"].transform(lambda s: s.iloc[0])
    pdf["last_fel"] = day["last_fel"].transform(lambda s: s.iloc[0])
    pdf["next_conv"] = day["next_conv"].transform(lambda s: s.iloc[-1])
    return pdf


def test_literal_definition_matches(spark):
    rnd = random.Random(42)
    rows = []
    for i in range(600):
        rows.append(charge(i, rnd.randint(1, 40), f"{rnd.randint(2000, 2018)}-0{rnd.randint(1, 3)}-01",
                           ctype=rnd.choice(["Misdemeanor", "Felony"]),
                           disp=rnd.choice(["Guilty", "Dismissed", "Nolle Prosequi"])))
    out = classify_rows(frame(spark, rows), RunConfig(cutoff_date="2019-12-31")).select(
        "id", "person_id", "hearing_date", "charge_type", "disposition_category", "last_hearing_date",
        "last_felony_conviction_date", "next_conviction_date").toPandas()
    lit = literal(out.copy()).set_index("id")
    out = out.set_index("id").loc[lit.index]

    def same(a, b):
        a = pd.to_datetime(a)
        b = pd.to_datetime(b)
        return ((a == b) | (a.isna() & b.isna())).all()

    assert same(out["last_hearing_date"], lit["last_hearing"])
    assert same(out["last_felony_conviction_date"], lit["last_fel"])
    assert same(out["next_conviction_date"], lit["next_conv"])
