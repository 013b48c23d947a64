"""Rule sets as data: conditions over the twelve decision keys, and a report of what each rule does.

A rule is a mapping ``{"name": ..., "label": ..., "when": condition}``; as everywhere, a later rule overrides an earlier
one. A condition is a mapping whose entries must all hold:

* a decision key with its value, or with a list of values of which one must be met;
* ``any``: a list of conditions of which one must hold; ``all``: a list of which every one must;
* ``not``: a condition that must not hold.

The empty condition always holds. A missing (null) flag counts as false, and a missing category is no value of its
list, as in the built-in rule sets. Unknown keys, values outside a key's domain, unknown labels, empty lists and names
used twice are refused with the place of the fault, so a misspelt rule never turns silently into one that does nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo import constants as K
from eligo.operators.rules import CATEGORY_DOMAINS, Rule, RuleSet, decision_table, facts
from eligo.schemas import DECISION_KEYS

# Rules share one long of flags per row.
MAX_RULES = 62


class RuleError(ValueError):
    """A rule that cannot be read; the message begins with its place."""


def _values(key: str, given, place: str) -> Column:
    listed = given if isinstance(given, (list, tuple)) else [given]
    domain = CATEGORY_DOMAINS.get(key, (False, True))
    if not listed:
        raise RuleError(f"{place}: no value is listed")
    for value in listed:
        # 0 and 1 equal False and True in Python, but are no flags.
        if not any(value is v or (isinstance(v, str) and value == v) for v in domain):
            raise RuleError(f"{place}: {value!r} is none of {list(domain)}")
    if key in CATEGORY_DOMAINS:
        return F.coalesce(F.col(key).isin(*listed), F.lit(False))
    flag = F.coalesce(F.col(key), F.lit(False))
    return F.lit(True) if len(set(listed)) == 2 else (flag if listed[0] else ~flag)


def _parts(given, place: str) -> list[Column]:
    if not isinstance(given, (list, tuple)) or not given:
        raise RuleError(f"{place}: a list of conditions is expected")
    return [condition(one, f"{place}[{i}]") for i, one in enumerate(given)]


def condition(given: Mapping, place: str = "when") -> Column:
    """The condition as a Boolean column (never null)."""
    if not isinstance(given, Mapping):
        raise RuleError(f"{place}: a mapping is expected, not {given!r}")
    held = F.lit(True)
    for key, value in given.items():
        here = f"{place}.{key}"
        if key == "any":
            part = functools.reduce(lambda a, b: a | b, _parts(value, here))
        elif key == "all":
            part = functools.reduce(lambda a, b: a & b, _parts(value, here))
        elif key == "not":
            part = ~condition(value, here)
        elif key in DECISION_KEYS:
            part = _values(key, value, here)
        else:
            raise RuleError(f"{here}: unknown key; expected any, all, not or one of {list(DECISION_KEYS)}")
        held = held & part
    return held


def rule_set(name: str, rules: Sequence[Mapping], default: str = K.NOT_ELIGIBLE) -> RuleSet:
    """A rule set from rules given as data, for ``classify(charges, cfg, rule_set)`` and all that takes rule sets."""
    if default not in K.LABELS:
        raise RuleError(f"default: {default!r} is none of {list(K.LABELS)}")
    if not isinstance(rules, (list, tuple)) or not rules or len(rules) > MAX_RULES:
        raise RuleError(f"rules: a list of 1 to {MAX_RULES} rules is expected")
    made, names = [], set()
    for i, rule in enumerate(rules):
        place = f"rules[{i}]"
        if not isinstance(rule, Mapping) or set(rule) != {"name", "label", "when"}:
            raise RuleError(f"{place}: a mapping with name, label and when is expected")
        if not isinstance(rule["name"], str) or not rule["name"] or rule["name"] in names:
            raise RuleError(f"{place}.name: {rule['name']!r} is empty, no text or used before")
        if rule["label"] not in K.LABELS:
            raise RuleError(f"{place}.label: {rule['label']!r} is none of {list(K.LABELS)}")
        names.add(rule["name"])
        held = condition(rule["when"], f"{place}.when")
        made.append(Rule(rule["name"], rule["label"], lambda _, held=held: held))
    return RuleSet(name, tuple(made), default)


def from_mapping(values: Mapping) -> RuleSet:
    """A rule set from a parsed file: ``name``, ``rules`` and, if wanted, ``default``."""
    unknown = set(values) - {"name", "rules", "default"}
    if unknown or "rules" not in values:
        raise RuleError(f"a rule file has name, rules and default; unknown: {sorted(unknown)}")
    return rule_set(values.get("name", "rules"), values["rules"], values.get("default", K.NOT_ELIGIBLE))


def rule_flags(rules: RuleSet) -> Column:
    """One long per row: bit ``i`` is set if rule ``i`` (from 0) matches."""
    if len(rules.rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit the flags")
    view = facts(rules.cs_12)
    bits = [F.when(rule.when(view), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(rules.rules)]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits)


def rule_coverage(rows: DataFrame, rules: RuleSet, weight: str | None = None) -> DataFrame:
    """What each rule does on ``rows``, which have the columns that the rules look at. ``weight`` names a column that says
    how many charges a row stands for (the reduced table's ``_n``). One row per rule, in order:

    ``place`` (from 1), ``rule``, ``label``; ``n_matched`` rows match it; ``n_decided`` rows get their label from it (no
    later rule matches them); ``n_needed`` of these would get another label without it; ``hidden_by``: the later rules
    that win over it somewhere; ``state``: ``unmatched``, ``shadowed`` (matched, but a later rule wins everywhere),
    ``redundant`` (decides, but no label needs it) or ``needed``.

    The rows are counted by their rule flags first (partial counts per task; there are never more flags than
    combinations of the keys), so what is exchanged does not grow with the rows. No rows: every rule is ``unmatched``.
    """
    names, labels = [r.name for r in rules.rules], [rules.default, *[r.label for r in rules.rules]]
    text = lambda values: F.array(*[F.lit(v) for v in values])
    flags = (rows.select(rule_flags(rules).alias("_flags"), (F.col(weight) if weight else F.lit(1)).alias("_n"))
             .groupBy("_flags").agg(F.sum("_n").alias("_n")))
    flags = flags.withColumn("_places", F.expr(
        f"filter(sequence(1, {len(names)}), i -> (shiftright(_flags, i - 1) & 1L) = 1L)"))
    # Place 0 is the default label.
    flags = flags.withColumn("_winner", F.coalesce(F.array_max("_places"), F.lit(0)))
    flags = flags.withColumn("_second", F.coalesce(F.array_max(F.array_remove("_places", F.col("_winner"))), F.lit(0)))
    label_of = lambda place: F.element_at(text(labels), place + 1)
    flags = flags.withColumn("_differs", label_of(F.col("_winner")) != label_of(F.col("_second")))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0).cast("long"))
    per_rule = []
    for i, (name, label) in enumerate(zip(names, labels[1:]), start=1):
        matched, decided = F.array_contains("_places", i), F.col("_winner") == i
        per_rule.append(F.struct(
            F.lit(i).alias("place"), F.lit(name).alias("rule"), F.lit(label).alias("label"),
            count(matched).alias("n_matched"), count(decided).alias("n_decided"),
            count(decided & F.col("_differs")).alias("n_needed"),
            F.collect_set(F.when(matched & ~decided, F.col("_winner"))).alias("winners")))
    out = flags.agg(F.array(*per_rule).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    state = (F.when(F.col("n_matched") == 0, "unmatched").when(F.col("n_decided") == 0, "shadowed")
             .when(F.col("n_needed") == 0, "redundant").otherwise("needed"))
    hidden = F.concat_ws(",", F.transform(F.array_sort("winners"), lambda w: F.element_at(text(names), w)))
    return out.select("place", "rule", "label", "n_matched", "n_decided", "n_needed", hidden.alias("hidden_by"),
                      state.alias("state"))


def rule_audit(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """:func:`rule_coverage` over all 12,288 combinations of the decision keys: which rules can never decide."""
    return rule_coverage(decision_table(spark, rules).select(*DECISION_KEYS), rules)


_OPEN_CLASS = [{"has_class_3_or_4": False}, {"felony_conviction_disqualifier": False}, {"has_class_1_or_2": False}]
_COVERED_MISDEMEANOR = {
    "disposition_category": K.CONVICTION, "charge_category": K.MISDEMEANOR, "code_section_category": [K.CS_A, K.CS_B],
    "next_conviction_disqualifier_after_misdemeanor": False}
_FELONY = {
    "disposition_category": [K.CONVICTION, K.DEFERRAL], "charge_category": K.FELONY,
    "not": {"code_section_category": K.CS_12}, "any": _OPEN_CLASS, "next_conviction_disqualifier_after_felony": False}
_OTHER_MISDEMEANOR = {
    "disposition_category": K.CONVICTION, "charge_category": K.MISDEMEANOR, "code_section_category": K.CS_ELSEWHERE,
    "any": _OPEN_CLASS, "next_conviction_disqualifier_after_misdemeanor": False}

# The canonical rules as data: an example for rule files, held equal to the built-in set by the tests.
D3_DATA = [
    {"name": "S1", "label": K.AUTOMATIC, "when": {
        "disposition_category": K.DISMISSED, "charge_category": K.MISDEMEANOR, "arrest_disqualifier": False,
        "has_conviction": False}},
    {"name": "S2", "label": K.AUTOMATIC, "when": {
        "disposition_category": K.DEFERRAL, "charge_category": K.MISDEMEANOR, "code_section_category": K.CS_A}},
    {"name": "S3", "label": K.AUTOMATIC, "when": _COVERED_MISDEMEANOR},
    {"name": "S4", "label": K.AUTOMATIC_PENDING, "when": {**_COVERED_MISDEMEANOR, "pending_after_misdemeanor": True}},
    {"name": "S5", "label": K.PETITION, "when": {
        "disposition_category": K.DEFERRAL, "charge_category": K.MISDEMEANOR,
        "code_section_category": [K.CS_ELSEWHERE, K.CS_B]}},
    {"name": "S6", "label": K.PETITION, "when": {"disposition_category": K.DISMISSED, "charge_category": K.FELONY}},
    {"name": "S7", "label": K.PETITION, "when": {
        "disposition_category": K.DISMISSED, "charge_category": K.MISDEMEANOR,
        "any": [{"arrest_disqualifier": True}, {"has_conviction": True}]}},
    {"name": "S8", "label": K.PETITION, "when": _FELONY},
    {"name": "S9", "label": K.PETITION, "when": _OTHER_MISDEMEANOR},
    {"name": "S10", "label": K.PETITION_PENDING, "when": {**_FELONY, "pending_after_felony": True}},
    {"name": "S11", "label": K.PETITION_PENDING, "when": {**_OTHER_MISDEMEANOR, "pending_after_misdemeanor": True}},
]
