"""Fixed values.

Everything in this module is a fixed value that must equal the rule source for
results to match: disposition and plea vocabularies, category names, labels,
code-section lists, the query list of the old analysis, and reason texts.
They are stated plainly, in their natural order, and used by reference
elsewhere.
"""

# --- Fixed values: dispositions -------------------------------------------------

# Disposition codes kept for classification (everything else is dropped).
VALID_DISPOSITIONS = (
    "Guilty",
    "Guilty In Absentia",
    "Dismissed",
    "Nolle Prosequi",
    "Not Guilty",
    "Not Guilty/Acquitted",
    "No Indictment Presented",
    "Not True Bill",
    "Dismissed/Other",
)

# Disposition code -> disposition category ('Dismissed' maps to itself).
DISPOSITION_CATEGORY_MAP = {
    "Nolle Prosequi": "Dismissed",
    "No Indictment Presented": "Dismissed",
    "Not True Bill": "Dismissed",
    "Dismissed/Other": "Dismissed",
    "Not Guilty": "Dismissed",
    "Not Guilty/Acquitted": "Dismissed",
    "Guilty In Absentia": "Conviction",
    "Guilty": "Conviction",
}

# A dismissal after one of these pleas is a deferral dismissal.
DEFERRAL_PLEAS = ("Alford", "Guilty", "Nolo Contendere")

# Dispositions that were eligible under the old law.
OLD_LAW_DISPOSITIONS = (
    "Dismissed",
    "Dismissed/Other",
    "Nolle Prosequi",
    "Not Guilty/Acquitted",
    "Not Guilty By Reason Of Insanity",
    "Not True Bill",
    "Not Guilty",
    "Not Guilty/Insanity",
)

# Raw disposition codes that mean a conviction in the look-back prototype.
RAW_CONVICTION_CODES = ("Guilty", "Guilty In Absentia")

# --- Fixed values: categories -------------------------------------------------

CONVICTION = "Conviction"
DISMISSED = "Dismissed"
DEFERRAL = "Deferral Dismissal"

MISDEMEANOR = "Misdemeanor"
FELONY = "Felony"
CHARGE_TYPES = (MISDEMEANOR, FELONY)

CS_A = "covered in 19.2-392.6 - A"
CS_B = "covered in 19.2-392.6 - B"
CS_12 = "excluded by 19.2-392.12"
CS_ELSEWHERE = "covered elsewhere"
# The first rule table spells the excluded category differently.
CS_12_D1 = "covered in 19.2-392.12"

MISSING = "MISSING"

# --- Fixed values: labels -----------------------------------------------------

AUTOMATIC = "Automatic"
AUTOMATIC_PENDING = "Automatic (pending)"
PETITION = "Petition"
PETITION_PENDING = "Petition (pending)"
NOT_ELIGIBLE = "Not eligible"
LABELS = (AUTOMATIC, AUTOMATIC_PENDING, PETITION, PETITION_PENDING, NOT_ELIGIBLE)

# --- Fixed values: default code-section lists and years -----------------------

COVERED_SECTIONS_A = ("4.1-305", "18.2-250.1")
COVERED_SECTIONS_B = (
    "4.1-305",
    "18.2-96",
    "18.2-103",
    "18.2-119",
    "18.2-120",
    "18.2-134",
    "18.2-250.1",
    "18.2-415",
)
COVERED_SECTIONS_B_MISDEMEANOR = ("18.2-248.1",)
EXCLUDED_SECTIONS_TWELVE = (
    "18.2-36.1",
    "18.2-36.2",
    "18.2-51.4",
    "18.2-51.5",
    "18.2-57.2",
    "18.2-266",
    "46.2-341.24",
)

DEFAULT_CUTOFF = "2020-12-31"
YEARS_SINCE_ARREST = 3
YEARS_SINCE_FELONY = 10
YEARS_AFTER_MISDEMEANOR = 7
YEARS_AFTER_FELONY = 10
# Length of a year in days for the canonical rules (numpy's 'Y' unit).
DAYS_PER_YEAR = 365.2425
# Length of a year in days for the older per-person rules and the prototype.
DAYS_PER_YEAR_JULIAN = 365.25
# The lifetime rule allows this many expungements.
LIFETIME_LIMIT = 2

# --- Fixed values: race standardisation (applied in this order, later wins) ----

RACE_RULES = (
    (r"BLACK", "Black"),
    (r"WHITE|CAUCASIAN", "White"),
    (r"(?<![A-Z])ASIAN", "Asian or Pacific Islander"),
    (r"AMERICAN INDIAN|NATIVE", "American Indian or Alaskan Native"),
    (r"OTHER|MISSING|UNKNOWN", "Unknown"),
)

# Exploratory race recode (after upper-casing, dropping parentheses, trimming).
RACE_FIELD_MAP = {
    "WHITE CAUCASIAN": "WHITE",
    "AMERICAN INDIAN": "AMERICAN INDIAN OR ALASKAN NATIVE",
    "OTHER": "UNKNOWN",
    "MISSING": "UNKNOWN",
}

# --- Fixed values: query list of the old analysis -----------------------------

QUERY_LIST = (
    {
        "reference": "19.2-392.6.A",
        "title": "Automatic sealing of offenses resulting in a deferred and dismissed disposition or conviction.",
        "code_section": ("4.1-305", "18.2-250.1"),
        "disposition_code": ("Dismissed",),
    },
    {
        "reference": "19.2-392.6.B",
        "title": "Automatic sealing of offenses resulting in a deferred and dismissed disposition or conviction.",
        "code_section": ("4.1-305", "18.2-96", "18.2-103", "18.2-119", "18.2-120", "18.2-134"),
        "disposition_code": ("Guilty",),
    },
    {
        "reference": "19.2-392.6.B-misdemeanor",
        "title": "Automatic sealing of offenses resulting in a deferred and dismissed disposition or conviction.",
        "code_section": ("18.2-248.1", "18.2-250.1", "18.2-415"),
        "disposition_code": ("Guilty",),
        "charge_type": ("Misdemeanor",),
    },
    {
        "reference": "19.2-392.12",
        "title": "Sealing of offenses resulting in a deferred and dismissed disposition or conviction by petition.",
        "code_section": ("18.2-36.1", "18.2-36.2", "18.2-51.4", "18.2-51.5", "18.2-57.2", "18.2-266", "46.2-341.24"),
        "disposition_code": ("Deferred", "Dismissed"),
    },
)

# --- Fixed values: reason texts ------------------------------------------------

REASON_FELONY_DISMISSAL = "Dismissal of felony charges"
REASON_MISD_12 = (
    "Conviction or deferred dismissal of misdemeanor charges that are excluded from expungement by 19.2-392.12"
)
REASON_FEL_CLASS12 = (
    "Conviction or deferred dismissal of felony charges, but with a prior conviction of a Class 1 or 2 felony "
    "or any other felony punishable by imprisonment for life"
)
REASON_MISD_DISMISSAL_ARREST = "Dismissal of misdemeanor charges, but with arrests or charges in the past 3 years"
REASON_MISD_CONV_SEVEN = (
    "Conviction of misdemeanor charges that are not excluded from expungement by 19.2-392.12, but with "
    "convictions of another kind within 7 years from disposition date"
)
REASON_FEL_TEN = (
    "Conviction or deferred dismissal of felony charges, but with convictions within 10 years from disposition date"
)
REASON_MISD_DISMISSAL_CLEAN = (
    "Dismissal of misdemeanor charges with no arrests or charges in the past 3 years and no convictions on "
    "the person's record"
)
REASON_MISD_DISMISSAL_CONV = (
    "Dismissal of misdemeanor charges with no arrests or charges in the past 3 years, but with prior "
    "convictions on the person's record"
)
REASON_DEFERRAL_A = "Deferred dismissal of misdemeanor charges covered under 19.2-392.6-A"
REASON_DEFERRAL_OTHER = "Deferred dismissal of misdemeanor charges not covered under 19.2-392.6-A"
REASON_FEL_CLASS34 = (
    "Conviction or deferred dismissal of felony charges, but with a class 3 or 4 felony conviction within "
    "the past 20 years"
)
REASON_MISD_B = (
    "Conviction of misdemeanor charges listed in 19.2-392.6 B with no convictions within 7 years from "
    "disposition date"
)
REASON_MISD_B_PENDING = (
    "Conviction of misdemeanor charges listed in 19.2-392.6 B with no convictions since the disposition date. "
    "However, because the disposition date is within 7 years of the current date, the record is not yet "
    "eligible for expungement"
)
REASON_MISD_FELONY_TEN = (
    "Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement "
    "under 19.2-392.12, but with felony convictions within the last 10 years"
)
REASON_FEL_FELONY_TEN = (
    "Conviction or deferred dismissal of felony charges, but with a felony conviction within the last 10 years"
)
REASON_MISD_CLASS12 = (
    "Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement "
    "under 19.2-392.12, but with a prior conviction for a class 1 or 2 felony or another felony punishable "
    "by imprisonment for life"
)
REASON_MISD_CLASS34 = (
    "Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement "
    "under 19.2-392.12, but with a prior conviction for a class 3 or 4 felony within the past 20 years"
)
REASON_FEL_12 = "Conviction or deferred dismissal of felony charges that are ineligible for expungement under 19.2-392.12"
REASON_FEL_OK = (
    "Conviction or deferred dismissal of felony charges that are not ones listed under 19.2-392.12, with no "
    "felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class "
    "1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another "
    "kind within 10 years from disposition date"
)
REASON_FEL_OK_PENDING = (
    "Conviction or deferred dismissal of felony charges that are not ones listed under 19.2-392.12, with no "
    "felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class "
    "1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another "
    "kind since disposition date. However, because the disposition date is within 10 years of the current "
    "date, the record is not yet eligible for expungement"
)
REASON_MISD_OK = (
    "Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement "
    "under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within "
    "the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and "
    "no convictions of another kind within 7 years from disposition date"
)
REASON_MISD_OK_PENDING = (
    "Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement "
    "under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within "
    "the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and "
    "no convictions of another kind since the disposition date. However, because the disposition date is "
    "within 7 years of the current date, the record is not yet eligible for expungement"
)

SAMEDAY_SUFFIX = (
    "; HOWEVER, the outcome is changed to petition because of a conviction on the same day of something "
    "that is not automatically expungable"
)
LIFETIME_SUFFIX = (
    "; HOWEVER, the outcome is changed to not eligible because the lifetime limit of two expungements has "
    "been exceeded"
)

# --- Fixed values: analysis vocabularies --------------------------------------

# Rare dispositions looked up in the edge-case analysis.
RARE_DISPOSITIONS = ("Complied With Law", "Resolved", "Certified Misdemeanor", "Granted", "Denied")

# Labels of the old-vs-new totals.
TOTAL_LABELS = {
    "automatic": "Automatic Exp.",
    "petition": "Exp. w/ Petition",
    "not_eligible": "Not Eligible",
    "old_petition": "Exp. w/ Petition",
    "old_not_eligible": "Not Eligible",
}
