"""The classification plan: clean -> reduce -> history windows -> rules -> same-day -> lifetime.

The charge rows are read three times (column-pruned) and shuffled in full
only once, for the join back of the group results. The other two shuffles
carry map-side-reduced rows: a partial aggregation to (person, day, category
triple) groups and a partial top-k of ids per group (lifetime thresholds).
Everything else runs on the reduced group table.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, functions as F

from eligo import constants as K
from eligo.config import RunConfig
from eligo.functions.categories import (
    charge_category, code_section_category, disposition_category, old_expungable,
)
from eligo.functions.dates import gap_flag
from eligo.operators import history as H
from eligo.operators.reasons import reason_text
from eligo.operators.rules import RULE_SETS, RuleSet
from eligo.schemas import FEATURES, OUTCOMES

AUTO_LABELS = (K.AUTOMATIC, K.AUTOMATIC_PENDING)


def kept_charges(charges: DataFrame, cfg: RunConfig) -> DataFrame:
    """Cutoff filter (strict), valid dispositions, misdemeanor/felony only (for every dialect); the person key and the
    charge and disposition categories. What is left out is counted by :func:`dropped_counts`."""
    df = charges
    if cfg.apply_cutoff:
        df = df.filter(F.col("hearing_date") < F.lit(cfg.cutoff_date).cast("date"))
    else:
        df = df.filter(F.col("hearing_date").isNotNull())
    df = (df.filter(F.col("disposition_code").isin(*K.VALID_DISPOSITIONS))
          .filter(F.col("charge_type").isin(*K.CHARGE_TYPES)))
    df = H.with_person_key(df)
    return df.withColumns({
        # Never null after the validity filter; saying so keeps the optimizer from adding an inferred
        # not-null filter on this join key that would re-evaluate the whole category expression.
        "disposition_category": F.coalesce(disposition_category(), F.lit(K.MISSING)),
        "charge_category": charge_category(),
    })


def section_category(cfg: RunConfig) -> Column:
    return code_section_category(
        sections_a=cfg.covered_sections_a, sections_b=cfg.covered_sections_b,
        sections_b_misdemeanor=cfg.covered_sections_b_misdemeanor,
        sections_twelve=cfg.excluded_sections_twelve,
        twelve_first=cfg.dialect != "d3",
        twelve_label=K.CS_12_D1 if cfg.dialect == "d1" else K.CS_12,
    )


def clean_for_rules(charges: DataFrame, cfg: RunConfig) -> DataFrame:
    """The charges that take part, with their category triple as text and as codes."""
    return H.with_category_codes(kept_charges(charges, cfg).withColumn("code_section_category", section_category(cfg)))


# Why a charge takes no part in a classification, in the order in which the reasons are looked for.
DROP_REASONS = ("no hearing date", "on or after the cutoff", "invalid disposition", "not a misdemeanor or felony")


def drop_reason(cfg: RunConfig) -> Column:
    """The first reason to leave the charge out; null for the charges that :func:`clean_for_rules` keeps."""
    held = F.coalesce(F.col("disposition_code").isin(*K.VALID_DISPOSITIONS), F.lit(False))
    kind = F.coalesce(F.col("charge_type").isin(*K.CHARGE_TYPES), F.lit(False))
    late = F.lit(cfg.apply_cutoff) & (F.col("hearing_date") >= F.lit(cfg.cutoff_date).cast("date"))
    return (F.when(F.col("hearing_date").isNull(), DROP_REASONS[0]).when(late, DROP_REASONS[1])
            .when(~held, DROP_REASONS[2]).when(~kind, DROP_REASONS[3]))


def dropped_counts(charges: DataFrame, cfg: RunConfig) -> DataFrame:
    """(run_id, reason, n_charges): how many charges the classification leaves out, and why."""
    return (charges.select(drop_reason(cfg).alias("reason")).filter("reason is not null")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_charges"))
            .select(F.lit(cfg.id).alias("run_id"), "reason", "n_charges"))


def _disqualifiers(cfg: RunConfig) -> dict[str, Column]:
    dpy = cfg.days_per_year
    flags = {
        "arrest_disqualifier": gap_flag("last_hearing_delta", cfg.years_since_arrest, dpy),
        "felony_conviction_disqualifier": gap_flag("last_felony_conviction_delta", cfg.years_since_felony, dpy),
        "next_conviction_disqualifier_after_misdemeanor":
            gap_flag("next_conviction_delta", cfg.years_until_conviction_after_misdemeanor, dpy),
        "next_conviction_disqualifier_after_felony":
            gap_flag("next_conviction_delta", cfg.years_until_conviction_after_felony, dpy),
    }
    if cfg.dialect == "d3":
        flags["pending_after_misdemeanor"] = gap_flag(
            "from_present_delta", cfg.years_until_conviction_after_misdemeanor, dpy)
        flags["pending_after_felony"] = gap_flag("from_present_delta", cfg.years_until_conviction_after_felony, dpy)
    else:
        # Older rules: hearing date later than the cutoff minus N calendar years.
        cutoff = F.lit(cfg.cutoff_date).cast("date")
        flags["pending_after_misdemeanor"] = F.col("hearing_date") > F.add_months(
            cutoff, -12 * cfg.years_until_conviction_after_misdemeanor)
        flags["pending_after_felony"] = F.col("hearing_date") > F.add_months(
            cutoff, -12 * cfg.years_until_conviction_after_felony)
    return flags


def group_features(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """History features and rule flags on the reduced (person, day, category) table."""
    groups = H.reduce_to_groups(rows)
    if cfg.lifetime_rule:
        # Both sides are hash-partitioned on the group keys, so this join adds no exchange.
        groups = groups.join(H.smallest_ids(rows, cfg.lifetime_limit + 1), list(H.GROUP_KEYS))
    return rule_inputs(H.history_columns(groups, cfg.cutoff_date), cfg)


def rule_inputs(groups: DataFrame, cfg: RunConfig) -> DataFrame:
    """The configuration's flags on top of the history columns."""
    groups = groups.withColumns(_disqualifiers(cfg))
    if cfg.dialect == "d2":
        # Older rules test felony class without the conviction condition.
        groups = groups.withColumns({"has_class_1_or_2": F.col("_any_c12"), "has_class_3_or_4": F.col("_any_c34")})
    if cfg.dialect == "d1":
        groups = groups.withColumns({
            "any_felony": F.col("_last_fel_day").isNotNull(),
            "same_day_charge": F.col("_day_rows") > 1,
        })
    return groups


def label_groups(groups: DataFrame, cfg: RunConfig, rule_set: RuleSet | None = None) -> DataFrame:
    """Base label, same-day rule and the inputs of the lifetime rule, per group."""
    rules = rule_set or RULE_SETS[cfg.dialect]
    g = groups.withColumn("base_label", rules.label())
    not_auto = ~F.col("base_label").isin(*AUTO_LABELS)
    if cfg.sameday_rule:
        day_not_auto = F.bool_or(not_auto).over(H.same_day())
        if cfg.dialect == "d2":
            # Older rules flag only the rows that were automatic.
            sameday = F.col("base_label").isin(*AUTO_LABELS) & day_not_auto
        else:
            sameday = day_not_auto
        g = g.withColumn("sameday_disqualifier", sameday)
        flagged = F.coalesce(F.col("sameday_disqualifier"), F.lit(False))
        g = g.withColumn("sameday_label", F.when(flagged & (F.col("base_label") == K.AUTOMATIC), F.lit(K.PETITION))
                         .when(flagged & (F.col("base_label") == K.AUTOMATIC_PENDING), F.lit(K.PETITION_PENDING))
                         .otherwise(F.col("base_label")))
    else:
        g = g.withColumns({"sameday_disqualifier": F.lit(None).cast("boolean"),
                           "sameday_label": F.col("base_label")})
    if cfg.dialect == "d2":
        counted = F.col("sameday_label").isin(K.AUTOMATIC, K.PETITION)
    else:
        counted = F.col("sameday_label") != F.lit(K.NOT_ELIGIBLE)
    g = g.withColumn("_counted", counted)
    prior = F.coalesce(F.sum(F.when(F.col("_counted"), F.col("_n"))).over(H.days_before()), F.lit(0))
    g = g.withColumn("_need", F.lit(cfg.lifetime_limit + 1) - prior)
    if cfg.lifetime_rule:
        g = g.withColumn("_thr", H.kth_counted_id_of_day(F.col("_counted"), F.col("_need")))
    else:
        g = g.withColumn("_thr", F.lit(None).cast("long"))
    applicable = ((F.col("disposition_category") == F.lit(K.CONVICTION))
                  | ((F.col("disposition_category") == F.lit(K.DEFERRAL))
                     & F.coalesce(F.col("sameday_disqualifier"), F.lit(False))))
    # The reason depends on group values only: evaluated once per group, not per charge. The texts belong to the
    # later rule sets; the first one decides by other conditions and has none.
    reason = F.lit(None).cast("string") if cfg.dialect == "d1" else reason_text()
    return g.withColumns({"_lifetime_applies": applicable, "_reason": reason})


def classify_rows(charges: DataFrame, cfg: RunConfig, rule_set: RuleSet | None = None) -> DataFrame:
    """Wide per-charge result: charge columns, features, labels, reason.

    ``rule_set`` replaces the dialect's rules with a caller's own (a list of
    (name, label, Column predicate) rules over the feature columns); it is
    evaluated on the reduced table like the built-in sets.
    """
    cfg = cfg.resolved()
    rows = clean_for_rules(charges, cfg)
    groups = label_groups(group_features(rows, cfg), cfg, rule_set)
    # The category text comes from the group side: the charge rows travel with the small codes only.
    out = rows.drop(*H.COMBO_KEYS).join(groups.drop("_ids"), list(H.GROUP_KEYS))
    if cfg.lifetime_rule:
        out = out.withColumn("lifetime_disqualifier", over_limit() & F.col("_lifetime_applies"))
        final = F.when(F.col("lifetime_disqualifier"), F.lit(K.NOT_ELIGIBLE)).otherwise(F.col("sameday_label"))
    else:
        out = out.withColumn("lifetime_disqualifier", F.lit(None).cast("boolean"))
        final = F.col("sameday_label")
    out = out.withColumns({
        "expungability": final,
        "run_id": F.lit(cfg.id),
        "old_expungable": old_expungable(),
    })
    lifetime_hit = F.coalesce(F.col("lifetime_disqualifier"), F.lit(False)) & (
        F.col("sameday_label") != F.lit(K.NOT_ELIGIBLE))
    suffix = F.when(lifetime_hit, F.lit(K.LIFETIME_SUFFIX))
    if not cfg.lifetime_rule:  # the lifetime step writes the reason anew; without it the same-day remark stays
        suffix = F.when(F.col("sameday_label") != F.col("base_label"), F.lit(K.SAMEDAY_SUFFIX))
    return out.withColumn("reason", F.concat(F.col("_reason"), suffix.otherwise(F.lit(""))))


def over_limit(suffix: str = "") -> Column:
    """Is the charge past the person's lifetime limit (earlier days count first, then smaller ids of the day)?"""
    need, at = F.col("_need" + suffix), F.col("_thr" + suffix)
    return (need <= 0) | (at.isNotNull() & (F.col("id") >= at))


def label_variants(charges: DataFrame, variants: dict[str, RunConfig]) -> DataFrame:
    """``id`` and one column per named configuration with its label: a comparison in one pass, without a join on ids.

    The configurations must take the same charges (cutoff). The charges are grouped once, by the code-section
    categories of all configurations together; the history is shared, and each configuration adds its labels to
    the groups.
    """
    configs = {name: cfg.resolved() for name, cfg in variants.items()}
    first = next(iter(configs.values()))
    if any((c.cutoff_date, c.apply_cutoff) != (first.cutoff_date, first.apply_cutoff) for c in configs.values()):
        raise ValueError("the compared configurations must have the same cutoff")
    rows = H.with_category_codes(kept_charges(charges, first).withColumn("code_section_category", section_category(first)))
    rows = rows.drop("_csc", "code_section_category")
    domain = H.CATEGORY_DOMAINS["code_section_category"]
    for name, cfg in configs.items():
        code = F.array_position(F.array(*[F.lit(v) for v in domain]), section_category(cfg)).cast("byte")
        rows = rows.withColumn(f"_csc_{name}", code)
    keys = [*H.DAY_KEYS, "_cc", "_dc", *[f"_csc_{name}" for name in configs]]
    groups = H.reduce_to_groups(rows, keys)
    if any(c.lifetime_rule for c in configs.values()):
        groups = groups.join(H.smallest_ids(rows, max(c.lifetime_limit for c in configs.values()) + 1, keys), keys)
    shared = H.history_columns(groups, first.cutoff_date)
    shared = shared.withColumns({"_class_12": F.col("has_class_1_or_2"), "_class_34": F.col("has_class_3_or_4")})
    columns, out = shared.columns, shared
    kept = ("_need", "_thr", "_lifetime_applies", "sameday_label")
    added: list[str] = []
    for name, cfg in configs.items():
        text = F.element_at(F.array(*[F.lit(v) for v in domain]), F.col(f"_csc_{name}").cast("int"))
        one = label_groups(rule_inputs(out.withColumn("code_section_category", text), cfg), cfg)
        if cfg.dialect == "d2":  # rule_inputs put other class flags in place of the shared ones
            one = one.withColumns({"has_class_1_or_2": F.col("_class_12"), "has_class_3_or_4": F.col("_class_34")})
        out = one.select(*columns, *added, *[F.col(c).alias(f"{c}_{name}") for c in kept])
        added += [f"{c}_{name}" for c in kept]
    joined = rows.select("id", *keys).join(out.select(*keys, *added), keys)
    labels = []
    for name, cfg in configs.items():
        label = F.col(f"sameday_label_{name}")
        if cfg.lifetime_rule:
            label = F.when(over_limit("_" + name) & F.col(f"_lifetime_applies_{name}"), F.lit(K.NOT_ELIGIBLE)).otherwise(label)
        labels.append(label.alias(name))
    return joined.select("id", *labels)


def split_tables(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features and outcomes projections (``id`` becomes ``charge_id``)."""
    wide = wide.withColumnRenamed("id", "charge_id")
    have = {f.name: f.dataType for f in wide.schema.fields}

    def project(schema):
        return wide.select(*[F.col(f.name) if have.get(f.name) == f.dataType
                             else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    return project(FEATURES), project(OUTCOMES)


def classify(charges: DataFrame, cfg: RunConfig | None = None,
             rule_set: RuleSet | None = None) -> tuple[DataFrame, DataFrame]:
    """Public entry: charges -> (features, outcomes)."""
    return split_tables(classify_rows(charges, cfg or RunConfig(), rule_set))


def with_rules_off(cfg: RunConfig) -> RunConfig:
    return dataclasses.replace(cfg, sameday_rule=False, lifetime_rule=False)


def classified_file(wide: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The 28-column per-charge file of the older per-person flow (raw + derived + labels).

    ``rows`` are the cleaned charge rows the modes of race and sex are counted
    on (they are the same rows as in ``wide``; counting there avoids
    recomputing the classification).
    """
    from eligo.operators.impute import impute_mode
    w = impute_mode(wide, source=rows)
    return w.select(
        "person_id", F.col("hearing_date").alias("HearingDate"), F.col("code_section").alias("CodeSection"),
        "code_section_category", F.col("charge_type").alias("ChargeType"),
        "charge_category", F.col("charge_class").alias("Class"),
        F.col("disposition_code").alias("DispositionCode"), "disposition_category",
        F.col("plea").alias("Plea"), F.col("race").alias("Race"), F.col("sex").alias("Sex"), "fips",
        F.col("has_conviction").alias("convictions"), F.col("arrest_disqualifier").alias("arrests"),
        F.col("felony_conviction_disqualifier").alias("felony10"),
        F.col("next_conviction_disqualifier_after_misdemeanor").alias("sevenyear"),
        F.col("next_conviction_disqualifier_after_felony").alias("tenyear"),
        F.col("pending_after_misdemeanor").alias("within7"), F.col("pending_after_felony").alias("within10"),
        F.col("has_class_1_or_2").alias("class1_2"), F.col("has_class_3_or_4").alias("class3_4"),
        F.col("expungability").alias("expungable"), "old_expungable",
        F.col("sameday_label").alias("expungable_no_lifetimelimit"), "reason",
        F.coalesce(F.col("sameday_disqualifier"), F.lit(False)).alias("sameday"),
        F.coalesce(F.col("lifetime_disqualifier"), F.lit(False)).alias("lifetime"),
    )
