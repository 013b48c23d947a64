"""Rule sets: declarative (name, label, predicate) lists evaluated as one CASE column.

In every rule set a later rule overrides an earlier one, so the CASE tests
the rules in reverse order and the first true branch wins. Predicates are
built from a :class:`Facts` view of the decision-key columns, so the same
rule set labels charge rows, category groups or the generated decision table.
"""

from __future__ import annotations

import dataclasses
import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo import constants as K
from eligo.schemas import DECISION_KEYS


class Facts:
    """Boolean views of the decision keys of one row (columns named as in the features table)."""

    def __init__(self, cs_12: str = K.CS_12):
        self._cs_12 = cs_12

    @staticmethod
    def _flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    def _is(self, name: str, value: str) -> Column:
        return F.coalesce(F.col(name) == F.lit(value), F.lit(False))

    # categories
    @functools.cached_property
    def misdemeanor(self): return self._is("charge_category", K.MISDEMEANOR)
    @functools.cached_property
    def felony(self): return self._is("charge_category", K.FELONY)
    @functools.cached_property
    def conviction(self): return self._is("disposition_category", K.CONVICTION)
    @functools.cached_property
    def dismissed(self): return self._is("disposition_category", K.DISMISSED)
    @functools.cached_property
    def deferral(self): return self._is("disposition_category", K.DEFERRAL)
    @functools.cached_property
    def cs_a(self): return self._is("code_section_category", K.CS_A)
    @functools.cached_property
    def cs_b(self): return self._is("code_section_category", K.CS_B)
    @functools.cached_property
    def cs_12(self): return self._is("code_section_category", self._cs_12)
    @functools.cached_property
    def cs_elsewhere(self): return self._is("code_section_category", K.CS_ELSEWHERE)
    # history flags
    @functools.cached_property
    def arrests(self): return self._flag("arrest_disqualifier")
    @functools.cached_property
    def convictions(self): return self._flag("has_conviction")
    @functools.cached_property
    def felony10(self): return self._flag("felony_conviction_disqualifier")
    @functools.cached_property
    def sevenyear(self): return self._flag("next_conviction_disqualifier_after_misdemeanor")
    @functools.cached_property
    def tenyear(self): return self._flag("next_conviction_disqualifier_after_felony")
    @functools.cached_property
    def within7(self): return self._flag("pending_after_misdemeanor")
    @functools.cached_property
    def within10(self): return self._flag("pending_after_felony")
    @functools.cached_property
    def class1_2(self): return self._flag("has_class_1_or_2")
    @functools.cached_property
    def class3_4(self): return self._flag("has_class_3_or_4")
    # first-table extras
    @functools.cached_property
    def anyfelony(self): return self._flag("any_felony")
    @functools.cached_property
    def sameday(self): return self._flag("same_day_charge")
    @functools.cached_property
    def lifetime(self): return self._flag("lifetime_flag")


@functools.lru_cache(maxsize=None)
def facts(cs_12: str = K.CS_12) -> Facts:
    """Shared fact columns (unresolved column expressions, valid on any frame with these columns)."""
    return Facts(cs_12=cs_12)


@dataclasses.dataclass(frozen=True)
class Rule:
    name: str
    label: str
    when: Callable[[Facts], Column]


@dataclasses.dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[Rule, ...]
    default: str = K.NOT_ELIGIBLE
    cs_12: str = K.CS_12

    def label(self) -> Column:
        """The label column: the last matching rule in list order, else the default."""
        x = facts(self.cs_12)
        expr = None
        for rule in reversed(self.rules):
            cond = rule.when(x)
            expr = F.when(cond, F.lit(rule.label)) if expr is None else expr.when(cond, F.lit(rule.label))
        return expr.otherwise(F.lit(self.default))


def _ok3_any(x: Facts) -> Column:
    # Written as an OR in the canonical table (any one of the three suffices).
    return ~x.class3_4 | ~x.felony10 | ~x.class1_2


def _ok3_all(x: Facts) -> Column:
    return ~x.class3_4 & ~x.felony10 & ~x.class1_2


def _s3(x):
    return x.conviction & x.misdemeanor & (x.cs_a | x.cs_b) & ~x.sevenyear


def _s8(x, ok3):
    return ((x.conviction | x.deferral) & x.felony & ~x.cs_12 & ok3(x) & ~x.tenyear)


def _s9(x, ok3):
    return x.conviction & x.misdemeanor & x.cs_elsewhere & ok3(x) & ~x.sevenyear


def _common_rules(pending_ok3) -> tuple[Rule, ...]:
    return (
        Rule("S1", K.AUTOMATIC, lambda x: x.dismissed & x.misdemeanor & ~x.arrests & ~x.convictions),
        Rule("S2", K.AUTOMATIC, lambda x: x.deferral & x.misdemeanor & x.cs_a),
        Rule("S3", K.AUTOMATIC, _s3),
        Rule("S4", K.AUTOMATIC_PENDING, lambda x: _s3(x) & x.within7),
        Rule("S5", K.PETITION, lambda x: x.deferral & x.misdemeanor & (x.cs_elsewhere | x.cs_b)),
        Rule("S6", K.PETITION, lambda x: x.dismissed & x.felony),
        Rule("S7", K.PETITION, lambda x: x.dismissed & x.misdemeanor & (x.arrests | x.convictions)),
        Rule("S8", K.PETITION, lambda x: _s8(x, _ok3_any)),
        Rule("S9", K.PETITION, lambda x: _s9(x, _ok3_any)),
        Rule("S10", K.PETITION_PENDING, lambda x: _s8(x, pending_ok3) & x.within10),
        Rule("S11", K.PETITION_PENDING, lambda x: _s9(x, pending_ok3) & x.within7),
    )


# Canonical rules (S10/S11 keep the OR-shaped class condition).
D3 = RuleSet("d3", _common_rules(_ok3_any))
# Older per-person rules: the pending rules need all three class conditions.
D2 = RuleSet("d2", _common_rules(_ok3_all))


def _d1_bad(x):
    return x.class1_2 | x.class3_4 | x.anyfelony | x.sameday


D1 = RuleSet("d1", (
    Rule("S1", K.AUTOMATIC, lambda x: x.misdemeanor & x.dismissed & ~x.convictions & ~x.arrests),
    Rule("S2", K.PETITION, lambda x: x.misdemeanor & ~x.conviction & (x.deferral | x.convictions | x.arrests)),
    Rule("S3", K.AUTOMATIC, lambda x: x.misdemeanor & x.conviction & ~x.sevenyear & ~_d1_bad(x)
         & (x.cs_a | x.cs_b)),
    Rule("S4", K.PETITION, lambda x: x.misdemeanor & x.conviction & ~x.sevenyear & ~_d1_bad(x) & x.cs_elsewhere),
    Rule("S5", K.NOT_ELIGIBLE, lambda x: x.misdemeanor & x.conviction & (x.sevenyear | _d1_bad(x) | x.cs_12)),
    Rule("S6", K.PETITION, lambda x: x.felony & ~x.cs_12 & ~x.tenyear & ~_d1_bad(x)),
    Rule("S7", K.NOT_ELIGIBLE, lambda x: x.felony & (x.cs_12 | x.tenyear | _d1_bad(x))),
), cs_12=K.CS_12_D1)

RULE_SETS = {"d3": D3, "d2": D2, "d1": D1}

# Domains of the decision keys (the decision table is their full product).
CATEGORY_DOMAINS = {
    "charge_category": (K.MISDEMEANOR, K.FELONY),
    "disposition_category": (K.CONVICTION, K.DISMISSED, K.DEFERRAL),
    "code_section_category": (K.CS_A, K.CS_B, K.CS_12, K.CS_ELSEWHERE),
}


def decision_table(spark: SparkSession, rule_set: RuleSet = D3) -> DataFrame:
    """Every combination of the 12 decision keys (2*3*4*2^9 = 12,288 rows) with its label.

    Row ``i`` of ``spark.range`` is decoded into one combination (mixed-radix
    digits: the first key varies fastest), so no join is needed. The size is
    fixed by the key domains, never by the data, so the table is safe to broadcast.
    """
    radix, cols = 1, []
    for key in DECISION_KEYS:
        values = CATEGORY_DOMAINS.get(key, (False, True))
        digit = (F.col("id") / F.lit(radix)).cast("long") % F.lit(len(values))
        if key in CATEGORY_DOMAINS:
            expr = None
            for i, v in enumerate(values):
                expr = F.when(digit == i, F.lit(v)) if expr is None else expr.when(digit == i, F.lit(v))
            cols.append(expr.alias(key))
        else:
            cols.append((digit == 1).alias(key))
        radix *= len(values)
    table = spark.range(radix, numPartitions=1).select(*cols)
    return table.withColumn("expungability", rule_set.label())


def decision_table_rows(rule_set_labeler: Callable[[dict], str]) -> list[dict]:
    """Plain-Python enumeration of the decision table (used by tests as a second opinion)."""
    keys = list(DECISION_KEYS)
    domains = [CATEGORY_DOMAINS.get(k, (False, True)) for k in keys]
    rows = []
    for combo in itertools.product(*domains):
        row = dict(zip(keys, combo))
        row["expungability"] = rule_set_labeler(row)
        rows.append(row)
    return rows


def lookup_labels(df: DataFrame, table: DataFrame) -> DataFrame:
    """Label rows by an equi-join with the decision table on all 12 keys (what the trained tree does).

    The table has a fixed 12,288 rows, so it is broadcast.
    """
    return df.join(F.broadcast(table), list(DECISION_KEYS), "left")
