"""Rules as data: equal to the built-in set, faults refused, and the report against brute force."""

import pytest
from pyspark.sql import functions as F

from eligo import constants as K
from eligo.config import RunConfig
from eligo.operators import rulebook as B, rules as R
from eligo.plans.classify import classify
from eligo.schemas import DECISION_KEYS
from tests.helpers import charge, frame


@pytest.fixture(scope="module")
def d3(spark):
    return B.rule_set("d3 as data", B.D3_DATA)


def test_data_labels_every_combination_like_the_built_in_rules(spark, d3):
    table = R.decision_table(spark, R.D3).withColumn("by_data", d3.label())
    assert table.count() == 12288
    assert table.filter("by_data <> expungability").count() == 0


def test_data_labels_charges_like_the_built_in_rules(spark, d3):
    rows = [charge(i, i % 7, f"20{10 + i % 9}-0{1 + i % 9}-11", ctype=["Misdemeanor", "Felony"][i % 2],
                   disp=["Guilty", "Dismissed", "Nolle Prosequi"][i % 3], plea=["Guilty", None][i % 2],
                   code=["18.2-95", "18.2-96", None][i % 3], cls=["1", "4", None][i % 3]) for i in range(120)]
    charges, cfg = frame(spark, rows), RunConfig(cutoff_date="2019-12-31")
    built_in = {r["charge_id"]: r["expungability"] for r in classify(charges, cfg)[1].collect()}
    by_data = {r["charge_id"]: r["expungability"] for r in classify(charges, cfg, d3)[1].collect()}
    assert len(built_in) == 120 and by_data == built_in


def test_missing_values(spark):
    """A null flag is false, a null category is no value; a negated condition on a null category holds."""
    row = spark.createDataFrame([(None,) * 12], ", ".join(
        f"{k} {'string' if k in R.CATEGORY_DOMAINS else 'boolean'}" for k in DECISION_KEYS))
    held = {
        "flag false": {"has_conviction": False}, "flag true": {"has_conviction": True},
        "flag either": {"has_conviction": [True, False]}, "category": {"charge_category": K.FELONY},
        "category, any value": {"charge_category": [K.FELONY, K.MISDEMEANOR]}, "not": {"not": {"charge_category": K.FELONY}},
        "empty": {}, "all": {"all": [{}, {"has_conviction": True}]}, "any": {"any": [{}, {"has_conviction": True}]}}
    got = row.select(*[B.condition(c).alias(n) for n, c in held.items()]).first().asDict()
    assert got == {"flag false": True, "flag true": False, "flag either": True, "category": False,
                   "category, any value": False, "not": True, "empty": True, "all": False, "any": True}


@pytest.mark.parametrize("rules, place", [
    ([], "rules"),
    ([{"name": "a", "label": K.PETITION}], "rules[0]"),
    ([{"name": "a", "label": "Petiton", "when": {}}], "rules[0].label"),
    ([{"name": "a", "label": K.PETITION, "when": {}}, {"name": "a", "label": K.PETITION, "when": {}}], "rules[1].name"),
    ([{"name": "a", "label": K.PETITION, "when": {"felony": True}}], "rules[0].when.felony"),
    ([{"name": "a", "label": K.PETITION, "when": {"has_conviction": 1}}], "rules[0].when.has_conviction"),
    ([{"name": "a", "label": K.PETITION, "when": {"has_conviction": "true"}}], "rules[0].when.has_conviction"),
    ([{"name": "a", "label": K.PETITION, "when": {"charge_category": "felony"}}], "rules[0].when.charge_category"),
    ([{"name": "a", "label": K.PETITION, "when": {"charge_category": []}}], "rules[0].when.charge_category"),
    ([{"name": "a", "label": K.PETITION, "when": {"any": []}}], "rules[0].when.any"),
    ([{"name": "a", "label": K.PETITION, "when": {"any": [{}, {"not": "x"}]}}], "rules[0].when.any[1].not"),
])
def test_faults_are_refused_with_their_place(spark, rules, place):
    with pytest.raises(B.RuleError) as fault:
        B.rule_set("faulty", rules)
    assert str(fault.value).startswith(place + ":")


def test_rule_files(spark):
    given = B.from_mapping({"name": "mine", "rules": B.D3_DATA[:2], "default": K.PETITION})
    assert (given.name, given.default, [r.name for r in given.rules]) == ("mine", K.PETITION, ["S1", "S2"])
    with pytest.raises(B.RuleError):
        B.from_mapping({"rules": B.D3_DATA, "rule": []})
    with pytest.raises(B.RuleError):
        B.from_mapping({"rules": B.D3_DATA, "default": "none"})


def brute_report(rows, rules, default):
    """The report from each row's list of matching rules."""
    out = []
    for i, (name, label, test) in enumerate(rules):
        matched = [r for r in rows if test(r)]
        decided, needed, hidden = 0, 0, set()
        for r in matched:
            places = [j for j, rule in enumerate(rules) if rule[2](r)]
            if places[-1] != i:
                hidden.add(places[-1])
                continue
            decided += 1
            before = rules[places[-2]][1] if len(places) > 1 else default
            needed += before != label
        state = "unmatched" if not matched else "shadowed" if not decided else "needed" if needed else "redundant"
        out.append((i + 1, name, label, len(matched), decided, needed, ",".join(rules[j][0] for j in sorted(hidden)), state))
    return out


def test_report_of_dead_rules(spark):
    """One rule of every state, over all combinations, against brute force."""
    misdemeanor, felony = {"charge_category": K.MISDEMEANOR}, {"charge_category": K.FELONY}
    given = [
        ("never", K.PETITION, {**felony, "all": [misdemeanor]}, lambda r: False),
        ("hidden", K.PETITION, {**felony, "has_conviction": True}, lambda r: r["charge_category"] == K.FELONY and r["has_conviction"]),
        ("felony", K.AUTOMATIC, felony, lambda r: r["charge_category"] == K.FELONY),
        ("same label", K.AUTOMATIC, {**felony, "arrest_disqualifier": True},
         lambda r: r["charge_category"] == K.FELONY and r["arrest_disqualifier"]),
        ("default label", K.NOT_ELIGIBLE, {**misdemeanor, "has_conviction": True},
         lambda r: r["charge_category"] == K.MISDEMEANOR and r["has_conviction"]),
    ]
    rules = B.rule_set("dead", [{"name": n, "label": label, "when": when} for n, label, when, _ in given])
    got = [tuple(r) for r in B.rule_audit(spark, rules).orderBy("place").collect()]
    rows = R.decision_table_rows(lambda row: "")
    assert got == brute_report(rows, [(n, label, test) for n, label, _, test in given], K.NOT_ELIGIBLE)
    assert [r[-1] for r in got] == ["unmatched", "shadowed", "needed", "redundant", "redundant"]
    assert got[1][6] == "felony,same label"


def test_every_canonical_rule_decides_somewhere(spark, d3):
    by_data = B.rule_audit(spark, d3).orderBy("place").collect()
    assert by_data == B.rule_audit(spark, R.D3).orderBy("place").collect()
    assert {r["state"] for r in by_data} == {"needed"}


def test_report_of_no_rows(spark, d3):
    report = B.rule_coverage(R.decision_table(spark).filter(F.lit(False)), d3).collect()
    assert [(r["rule"], r["n_matched"], r["state"]) for r in report] == [(f"S{i}", 0, "unmatched") for i in range(1, 12)]
