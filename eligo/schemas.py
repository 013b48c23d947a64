"""Declared schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

S, L, I, B, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


CHARGES = _struct(
    ("id", L), ("person_id", L), ("hearing_date", D), ("code_section", S), ("charge_type", S),
    ("charge_class", S), ("disposition_code", S), ("plea", S), ("race", S), ("sex", S), ("fips", S),
    ("locality", S),
)

RUNS = T.StructType([
    T.StructField("id", S, False), T.StructField("start_at", TS), T.StructField("end_at", TS),
    T.StructField("status", S), T.StructField("cutoff_date", D),
    T.StructField("covered_sections_a", T.ArrayType(S)), T.StructField("covered_sections_b", T.ArrayType(S)),
    T.StructField("covered_sections_b_misdemeanor", T.ArrayType(S)),
    T.StructField("excluded_sections_twelve", T.ArrayType(S)),
    T.StructField("years_since_arrest", I), T.StructField("years_since_felony", I),
    T.StructField("years_until_conviction_after_misdemeanor", I),
    T.StructField("years_until_conviction_after_felony", I),
    T.StructField("lifetime_rule", B), T.StructField("sameday_rule", B),
    T.StructField("dialect", S), T.StructField("apply_cutoff", B), T.StructField("lifetime_limit", I),
])

RUN_STATUSES = ("In Progress", "Completed", "Failed", "Canceled")

FEATURES = _struct(
    ("charge_id", L), ("run_id", S), ("disposition_category", S), ("charge_category", S),
    ("code_section_category", S), ("has_conviction", B), ("last_hearing_date", D),
    ("last_felony_conviction_date", D), ("next_conviction_date", D), ("last_hearing_delta", I),
    ("last_felony_conviction_delta", I), ("next_conviction_delta", I), ("from_present_delta", I),
    ("arrest_disqualifier", B), ("felony_conviction_disqualifier", B),
    ("next_conviction_disqualifier_after_misdemeanor", B), ("next_conviction_disqualifier_after_felony", B),
    ("pending_after_misdemeanor", B), ("pending_after_felony", B), ("has_class_1_or_2", B),
    ("has_class_3_or_4", B), ("lifetime_disqualifier", B), ("sameday_disqualifier", B),
)

OUTCOMES = _struct(("charge_id", L), ("run_id", S), ("expungability", S))

# Keys of the decision table, in table order, then the label.
DECISION_KEYS = (
    "charge_category", "disposition_category", "code_section_category", "arrest_disqualifier",
    "has_conviction", "felony_conviction_disqualifier", "next_conviction_disqualifier_after_misdemeanor",
    "next_conviction_disqualifier_after_felony", "pending_after_misdemeanor", "pending_after_felony",
    "has_class_1_or_2", "has_class_3_or_4",
)

# Charges a run left out, by reason (the first that applies) and their number.
DROPPED = _struct(("run_id", S), ("reason", S), ("n_charges", L))

# The court CSV column names (district layout, circuit layout, combined).
DISTRICT_COLUMNS = ("Locality", "HearingDate", "person_id", "CodeSection", "FinalDisposition", "HearingPlea",
                    "CaseType", "Charge", "Class", "Race", "Gender", "fips")
CIRCUIT_COLUMNS = ("Locality", "HearingDate", "person_id", "CodeSection", "DispositionCode", "HearingPlea",
                   "ChargeType", "Charge", "Class", "Race", "Sex", "fips")
COURT_COLUMNS = ("Locality", "HearingDate", "person_id", "CodeSection", "DispositionCode", "Plea",
                 "ChargeType", "Charge", "Class", "Race", "Sex", "fips", "CourtType")

