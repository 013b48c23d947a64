"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the given tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.config import RunConfig
from eligo.plans import classify as C
from eligo.session import apply_conf
from eligo.sources.fixtures import PARITY_CUTOFF, load_charges

QUERIES: dict = {}

PARITY = RunConfig(cutoff_date=PARITY_CUTOFF)


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return load_charges(spark, sf_dir)


def wide(spark: SparkSession, sf_dir: str, cfg: RunConfig = PARITY) -> DataFrame:
    return C.classify_rows(charges(spark, sf_dir), cfg)


# --- classification -----------------------------------------------------------------

@register
def label_counts(spark, sf_dir):
    return (wide(spark, sf_dir).groupBy("expungability")
            .agg(F.count(F.lit(1)).alias("n_charges")))


@register
def classify_outcomes(spark, sf_dir):
    return C.split_tables(wide(spark, sf_dir))[1]


@register
def classify_features(spark, sf_dir):
    return C.split_tables(wide(spark, sf_dir))[0]


D2 = dataclasses.replace(PARITY, dialect="d2", apply_cutoff=False)
D1 = dataclasses.replace(PARITY, dialect="d1")


def _by_charge(df: DataFrame, *cols) -> DataFrame:
    return df.select(F.col("id").alias("charge_id"), *cols)


# --- features -----------------------------------------------------------------------

@register
def disposition_category(spark, sf_dir):
    from eligo.functions.categories import disposition_category as dc
    return charges(spark, sf_dir).select("id", "disposition_code", "plea", dc().alias("disposition_category"))


@register
def code_section_category(spark, sf_dir):
    rows = C.clean_for_rules(charges(spark, sf_dir), PARITY)
    return rows.select("id", "code_section", "code_section_category")


@register
def has_conviction(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "has_conviction")


@register
def last_hearing_date(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "last_hearing_date", "last_hearing_delta")


@register
def last_felony_conviction_date(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "last_felony_conviction_date", "last_felony_conviction_delta")


@register
def next_conviction_date(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "next_conviction_date", "next_conviction_delta")


@register
def gap_days(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "last_hearing_delta", "last_felony_conviction_delta",
                      "next_conviction_delta", "from_present_delta")


@register
def gap_flags(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "arrest_disqualifier", "felony_conviction_disqualifier",
                      "next_conviction_disqualifier_after_misdemeanor", "next_conviction_disqualifier_after_felony",
                      "pending_after_misdemeanor", "pending_after_felony")


@register
def class_flags(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "has_class_1_or_2", "has_class_3_or_4")


# --- rules --------------------------------------------------------------------------

@register
def base_label_d3(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "base_label")


@register
def base_label_d2(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D2), "base_label")


@register
def base_label_d1(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D1), "base_label")


@register
def decision_table_join(spark, sf_dir):
    from eligo.operators.rules import decision_table, lookup_labels
    from eligo.schemas import DECISION_KEYS
    features = wide(spark, sf_dir).select("id", *DECISION_KEYS)
    return _by_charge(lookup_labels(features, decision_table(spark)), "expungability")


@register
def sameday_rule(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "sameday_disqualifier", F.col("sameday_label"))


@register
def lifetime_rule(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir), "lifetime_disqualifier", "expungability")


@register
def lifetime_rule_d2(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D2), "sameday_disqualifier", "lifetime_disqualifier", "expungability")


@register
def rules_off(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, C.with_rules_off(PARITY)), "sameday_disqualifier",
                      "lifetime_disqualifier", "expungability")


@register
def reason_text(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D2), "expungability", "reason")


@register
def old_rule_flag(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D2), "old_expungable")


@register
def interval_flags_d2(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, D2),
                      F.col("arrest_disqualifier").alias("arrests"),
                      F.col("felony_conviction_disqualifier").alias("felony10"),
                      F.col("next_conviction_disqualifier_after_misdemeanor").alias("sevenyear"),
                      F.col("next_conviction_disqualifier_after_felony").alias("tenyear"),
                      F.col("pending_after_misdemeanor").alias("within7"),
                      F.col("pending_after_felony").alias("within10"))


# --- ingest ---------------------------------------------------------------------------

INGEST_AS_OF = PARITY_CUTOFF


def cleaned(spark, sf_dir):
    """Charges through the ingest chain (raw layout -> rename -> date filter -> race -> fips)."""
    from eligo.operators.clean import clean_charges, to_raw_layout
    return clean_charges(to_raw_layout(charges(spark, sf_dir)), as_of=INGEST_AS_OF)


@register
def race_standardize(spark, sf_dir):
    from eligo.functions.text import standardize_race
    return charges(spark, sf_dir).select("id", F.col("race").alias("race_raw"),
                                         standardize_race("race").alias("race"))


@register
def race_standardize_alt(spark, sf_dir):
    from eligo.functions.text import standardize_race_field
    return charges(spark, sf_dir).select("id", standardize_race_field("race").alias("race_field"))


@register
def fips_pad(spark, sf_dir):
    from eligo.functions.text import fix_fips
    return charges(spark, sf_dir).select("id", F.col("fips").alias("fips_raw"), fix_fips("fips").alias("fips"))


@register
def ingest_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


# --- history variants -------------------------------------------------------------------

@register
def lookback_flags_d0(spark, sf_dir):
    from eligo.operators.lookback import FLAGS, lookback_flags
    return _by_charge(lookback_flags(charges(spark, sf_dir)), *FLAGS)


@register
def feature_summary_d0(spark, sf_dir):
    from eligo.operators.lookback import flag_summary, lookback_flags
    return flag_summary(lookback_flags(charges(spark, sf_dir)))


@register
def mode_impute(spark, sf_dir):
    from eligo.operators.impute import impute_mode
    rows = C.clean_for_rules(charges(spark, sf_dir), D2)
    return _by_charge(impute_mode(rows), "race", "sex")


# --- per-person and old-vs-new totals -----------------------------------------------------

def _person_counts(spark, sf_dir, cfg=None):
    from eligo import constants as K
    from eligo.operators.reports import conditional_counts
    w = wide(spark, sf_dir, cfg or D2)
    label = F.col("expungability")
    return conditional_counts(w, ["person_id"], {
        "automatic": label == K.AUTOMATIC,
        "petition": label == K.PETITION,
        "automatic_pending": label == K.AUTOMATIC_PENDING,
        "petition_pending": label == K.PETITION_PENDING,
        "not_eligible": label == K.NOT_ELIGIBLE,
        "old_petition": F.col("old_expungable"),
        "old_not_eligible": ~F.col("old_expungable"),
    })


@register
def person_label_counts(spark, sf_dir):
    return _person_counts(spark, sf_dir)


TOTAL_COLS = ["automatic", "petition", "not_eligible", "old_petition", "old_not_eligible"]


def _totals(spark, sf_dir):
    from eligo.operators.reports import column_sums
    return column_sums(_person_counts(spark, sf_dir), TOTAL_COLS)


@register
def old_vs_new_totals(spark, sf_dir):
    t = _totals(spark, sf_dir)
    return t.withColumn("difference", (F.col("old_petition") + F.col("old_not_eligible"))
                        - (F.col("automatic") + F.col("petition") + F.col("not_eligible")))


@register
def old_vs_new_unpivot(spark, sf_dir):
    from eligo import constants as K
    from eligo.operators.reports import unpivot
    long = unpivot(_totals(spark, sf_dir), [], TOTAL_COLS, "name", "value")
    label = None
    for raw, text in K.TOTAL_LABELS.items():
        label = (F.when(F.col("name") == raw, F.lit(text)) if label is None
                 else label.when(F.col("name") == raw, F.lit(text)))
    return long.withColumns({
        "law": F.when(F.col("name").contains("old"), F.lit("Old Law")).otherwise(F.lit("New Law")),
        "label": label,
    })


# --- distributions ----------------------------------------------------------------------

@register
def code_distribution(spark, sf_dir):
    from eligo.operators.reports import distribution
    return distribution(cleaned(spark, sf_dir), "code_section")


@register
def code_cumulative(spark, sf_dir):
    from eligo.operators.reports import cumulative_share, distribution
    return cumulative_share(distribution(cleaned(spark, sf_dir), "code_section"), "code_section")


@register
def race_distribution(spark, sf_dir):
    from eligo.operators.reports import distribution
    return distribution(cleaned(spark, sf_dir), "race")


@register
def code_by_race(spark, sf_dir):
    from eligo.operators.reports import counts, cumulative_share, distribution, share_of_total
    clean = cleaned(spark, sf_dir)
    # At most 99 values can each hold more than 1 % of the rows, so the list is broadcast.
    top = cumulative_share(distribution(clean, "code_section"), "code_section").select("code_section")
    joined = clean.join(F.broadcast(top), "code_section")
    return share_of_total(counts(joined, "code_section", "race"), within=("code_section",))


@register
def top_races(spark, sf_dir):
    from eligo.operators.reports import top_k
    return top_k(cleaned(spark, sf_dir), "race", 10)


@register
def race_by_sex(spark, sf_dir):
    from eligo.operators.reports import count_nonnull_by
    return count_nonnull_by(wide(spark, sf_dir), ["race", "sex"], "expungability")


@register
def distinct_counts(spark, sf_dir):
    from eligo.operators.reports import distinct_counts as dc
    return dc(charges(spark, sf_dir), {"n_persons": "person_id", "n_codes": "code_section"}, rows_of="person_id")


@register
def missing_code_count(spark, sf_dir):
    from eligo.functions.text import is_missing
    return (charges(spark, sf_dir).groupBy(F.year("hearing_date").alias("year"))
            .agg(F.count_if(is_missing("code_section")).alias("n_missing"), F.count(F.lit(1)).alias("n_rows")))


@register
def profile_pivot(spark, sf_dir):
    from eligo.operators.reports import profile_long
    df = charges(spark, sf_dir).withColumn("year", F.year("hearing_date"))
    return profile_long(df, "year", "disposition_code")


@register
def race_field_counts(spark, sf_dir):
    from eligo.functions.text import standardize_race_field
    from eligo.operators.reports import value_counts
    df = charges(spark, sf_dir).filter(F.col("code_section").isin("A.46.2-862"))
    return value_counts(df.select(standardize_race_field("race").alias("race")), "race")


@register
def rare_disposition_localities(spark, sf_dir):
    from eligo import constants as K
    from eligo.operators.reports import value_counts
    return value_counts(charges(spark, sf_dir).filter(F.col("disposition_code").isin(*K.RARE_DISPOSITIONS)),
                        "locality")


@register
def code_pattern_by_year(spark, sf_dir):
    df = charges(spark, sf_dir).filter(F.col("code_section").rlike("18.2-248.1"))
    return df.groupBy(F.year("hearing_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@register
def group_having(spark, sf_dir):
    from eligo.operators.reports import group_mean_having
    return group_mean_having(wide(spark, sf_dir), "race", "last_hearing_delta", min_count=1)


# --- query list (old analysis) ----------------------------------------------------------------

QL_COLS = ["hearing_date", "person_id", "code_section", "disposition_code", "charge_type"]


def _query_list(spark, sf_dir):
    from eligo.operators.querylist import apply_query_list
    return apply_query_list(charges(spark, sf_dir), keep=QL_COLS)


@register
def query_list_union(spark, sf_dir):
    return _query_list(spark, sf_dir)


@register
def query_list_by_year(spark, sf_dir):
    return _query_list(spark, sf_dir).groupBy(F.year("hearing_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n"))


@register
def query_list_by_year_reference(spark, sf_dir):
    return _query_list(spark, sf_dir).groupBy(F.year("hearing_date").alias("year"), "reference").agg(
        F.count(F.lit(1)).alias("n"))


@register
def query_list_by_year_code(spark, sf_dir):
    return _query_list(spark, sf_dir).groupBy(F.year("hearing_date").alias("year"), "code_section").agg(
        F.count(F.lit(1)).alias("n"))


def _year_summary(spark, sf_dir):
    from eligo.operators.querylist import law_totals
    # One pass: a row's weight in the UNION ALL is the number of queries it matches.
    return law_totals(charges(spark, sf_dir).withColumn("year", F.year("hearing_date")), ["year"])


@register
def year_summary(spark, sf_dir):
    return _year_summary(spark, sf_dir)


@register
def year_summary_by_locality(spark, sf_dir):
    """Totals per (locality, year), as per court file."""
    from eligo.operators.querylist import law_totals
    return law_totals(charges(spark, sf_dir).withColumn("year", F.year("hearing_date")), ["locality", "year"])


@register
def year_summary_rolled_up(spark, sf_dir):
    """The totals per locality and year, summed per year."""
    from eligo.operators.querylist import roll_up
    return roll_up(year_summary_by_locality(spark, sf_dir), ["year"])


@register
def year_summary_percent(spark, sf_dir):
    from eligo.operators.reports import unpivot
    long = unpivot(_year_summary(spark, sf_dir), ["year", "total"], ["new_law", "old_law"],
                   "eligibility", "raw_count")
    pct = F.round(F.col("raw_count").cast("double") * F.lit(100.0) / F.col("total").cast("double"), 1)
    return long.withColumns({"percent": F.format_string("%.1f%%", pct),
                             "count_text": F.format_number(F.col("raw_count"), 0)})


# --- samples, increments, comparisons ------------------------------------------------------------

@register
def sample_persons_join(spark, sf_dir):
    from eligo.operators.sampling import sample_rows
    return sample_rows(charges(spark, sf_dir), 100).select("id", "person_id")


EARLIER = dataclasses.replace(PARITY, cutoff_date="2005-12-31")
# The first day of the load that `classify_touched_persons` adds.
LAST_LOAD = "2019-01-01"


@register
def unprocessed_anti_join(spark, sf_dir):
    from eligo.operators.sampling import unprocessed
    # Persons an earlier run (cutoff 2005-12-31) produced outcomes for: those with a classifiable
    # charge before that cutoff (the same set as the run's outcomes, without classifying again).
    ch = charges(spark, sf_dir)
    done = C.clean_for_rules(ch, EARLIER).select("person_id")
    return unprocessed(ch, done).select("id", "person_id")


D2_CUT = dataclasses.replace(PARITY, dialect="d2")


@register
def run_diff(spark, sf_dir):
    both = C.label_variants(charges(spark, sf_dir), {"label_d3": PARITY, "label_d2": D2_CUT})
    return (both.filter(F.col("label_d3") != F.col("label_d2"))
            .select(F.col("id").alias("charge_id"), "label_d3", "label_d2"))


@register
def confusion_matrix(spark, sf_dir):
    from eligo.operators.reports import crosstab_counts
    from eligo.operators.rules import decision_table, lookup_labels
    from eligo.schemas import DECISION_KEYS
    feats = wide(spark, sf_dir).select("base_label", *DECISION_KEYS)
    table = decision_table(spark).withColumnRenamed("expungability", "prediction")
    return crosstab_counts(lookup_labels(feats, table).withColumnRenamed("base_label", "label"),
                           "label", "prediction")


@register
def peek_charges(spark, sf_dir):
    from eligo.operators.sampling import peek
    return peek(charges(spark, sf_dir), 5)


@register
def distinct_persons(spark, sf_dir):
    return charges(spark, sf_dir).select("person_id").distinct()


@register
def person_lookup(spark, sf_dir):
    return charges(spark, sf_dir).filter(F.col("person_id") == 1)


@register
def classified_file_d2(spark, sf_dir):
    ch = charges(spark, sf_dir)
    return C.classified_file(C.classify_rows(ch, D2), C.clean_for_rules(ch, D2))


@register
def person_file_lines(spark, sf_dir):
    from eligo.sinks.tables import person_file_line
    return charges(spark, sf_dir).select("id", "person_id", person_file_line().alias("line"))


@register
def profile_totals(spark, sf_dir):
    from eligo.operators.reports import profile_totals as totals
    return totals(charges(spark, sf_dir), "disposition_code")


# Ad-hoc SQL over a temp view: the most frequent code sections with their running share.
FREQUENT_CODES_SQL = """
SELECT code_section, n, percent,
       round(sum(percent) OVER (ORDER BY percent DESC, code_section), 2) AS cumulative_percent
FROM (SELECT code_section, count(*) AS n,
             round(count(*) * 100D / (SELECT count(*) FROM charges_clean), 2) AS percent
      FROM charges_clean GROUP BY code_section)
WHERE percent > 1
"""


@register
def code_distribution_sql(spark, sf_dir):
    cleaned(spark, sf_dir).createOrReplaceTempView("charges_clean")
    return spark.sql(FREQUENT_CODES_SQL)


@register
def dropped_charges(spark, sf_dir):
    """Charges that the classification leaves out, by reason."""
    return C.dropped_counts(charges(spark, sf_dir), PARITY).select("reason", "n_charges")


@register
def reason_text_no_lifetime(spark, sf_dir):
    """Without the lifetime step the same-day remark stays in the reason."""
    return _by_charge(wide(spark, sf_dir, dataclasses.replace(D2, lifetime_rule=False)), "expungability", "reason")


@register
def large_sample(spark, sf_dir):
    """A sample that takes many buckets whole and cuts one."""
    from eligo.operators.sampling import sample_ids
    return sample_ids(charges(spark, sf_dir), 7_000, key="id")


@register
def ml_tree_predict(spark, sf_dir):
    from eligo.operators.tree import fitted_tree, predict
    from eligo.schemas import DECISION_KEYS
    feats = wide(spark, sf_dir).select("id", *DECISION_KEYS)
    return _by_charge(predict(fitted_tree(spark), feats), F.col("predicted_label"))


# A non-default configuration: other year limits, lifetime limit 3, one more B-list section.
VARIANT = dataclasses.replace(
    PARITY, id="variant", years_since_arrest=5, years_since_felony=8, years_until_conviction_after_misdemeanor=5,
    years_until_conviction_after_felony=12, lifetime_limit=3,
    covered_sections_b=PARITY.covered_sections_b + ("18.2-95",))


@register
def classify_variant_config(spark, sf_dir):
    return _by_charge(wide(spark, sf_dir, VARIANT), "code_section_category", "arrest_disqualifier",
                      "felony_conviction_disqualifier", "pending_after_misdemeanor", "pending_after_felony",
                      "lifetime_disqualifier", "expungability")


@register
def config_variant_diff(spark, sf_dir):
    both = C.label_variants(charges(spark, sf_dir), {"label_default": PARITY, "label_variant": VARIANT})
    return (both.filter(F.col("label_default") != F.col("label_variant"))
            .groupBy("label_default", "label_variant").agg(F.count(F.lit(1)).alias("n_charges")))


@register
def persons_without_counts(spark, sf_dir):
    """Persons in the charges whose label counts are missing: the run (cutoff 2005-12-31) had no
    classifiable charge of theirs."""
    persons = charges(spark, sf_dir).select("person_id").distinct()
    counts = _person_counts(spark, sf_dir, EARLIER)
    return (persons.join(counts, "person_id", "left").filter(F.col("automatic").isNull())
            .select("person_id"))


@register
def profile_pivot_charge_type(spark, sf_dir):
    from eligo.operators.reports import profile_long
    df = charges(spark, sf_dir).withColumn("year", F.year("hearing_date"))
    return profile_long(df, "year", "charge_type")


@register
def profile_pivot_plea(spark, sf_dir):
    from eligo.operators.reports import profile_long
    df = charges(spark, sf_dir).withColumn("year", F.year("hearing_date"))
    return profile_long(df, "year", "plea")


@register
def frequent_codes(spark, sf_dir):
    """The report of ``code_cumulative`` without an exchange of all codes."""
    from eligo.operators.reports import cumulative_share
    from eligo.operators.summaries import frequent_values
    return cumulative_share(frequent_values(cleaned(spark, sf_dir), "code_section"), "code_section")


@register
def distinct_sketch_rollup(spark, sf_dir):
    """Distinct persons per year and in all, from sketches per (locality, year), held against the exact counts."""
    from eligo.operators import summaries as S
    rows = charges(spark, sf_dir).withColumn("year", F.year("hearing_date"))
    stored = S.distinct_sketches(rows, ["locality", "year"], "person_id")
    return S.compared(stored, rows, "year", "person_id")


@register
def classify_touched_persons(spark, sf_dir):
    """Outcomes after the hearings of the last year came in: only their persons are classified, the others' outcomes
    are those of the classification before."""
    from eligo.plans import touched as T
    rows = charges(spark, sf_dir)
    before = C.classify(rows.filter(F.col("hearing_date") < F.lit(LAST_LOAD).cast("date")), PARITY)[1]
    return T.touched_outcomes(rows, T.known_labels(rows, before, PARITY), PARITY)


@register
def key_audit(spark, sf_dir):
    """Ids of the charges against the features and outcomes of their classification."""
    from eligo.operators import audit
    rows = charges(spark, sf_dir)
    features, outcomes = C.classify(rows, PARITY)
    return audit.key_audit(rows, features, outcomes)


@register
def key_audit_across_runs(spark, sf_dir):
    """The same audit with features and outcomes of runs with different cutoffs: features that have no outcome."""
    from eligo.operators import audit
    rows = charges(spark, sf_dir)
    return audit.key_audit(rows.filter("id % 7 <> 0").unionAll(rows.filter("id % 5 = 0")), C.classify(rows, PARITY)[0], C.classify(rows, EARLIER)[1])


@register
def classify_by_rule_data(spark, sf_dir):
    """Outcomes by the canonical rules given as data."""
    from eligo.operators import rulebook as B
    return C.classify(charges(spark, sf_dir), PARITY, B.rule_set("d3", B.D3_DATA))[1]


@register
def rule_coverage_d3(spark, sf_dir):
    """How many charges each rule matches and decides, and which later rules win over it."""
    from eligo.operators import rulebook as B
    rows = C.group_features(C.clean_for_rules(charges(spark, sf_dir), dataclasses.replace(PARITY, lifetime_rule=False)),
                            dataclasses.replace(PARITY, lifetime_rule=False))
    return B.rule_coverage(rows, B.rule_set("d3", B.D3_DATA), weight="_n")
