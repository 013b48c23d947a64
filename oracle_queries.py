"""DuckDB SQL for the parity check.

Written independently of the Spark code: the classification here is the
direct row-level definition (windows over every charge row, a running count
ordered by (hearing date, id) for the lifetime rule), while the Spark plan
reduces rows to category groups first. Both must agree row for row.
"""

from __future__ import annotations

from eligo.sources.fixtures import CHARGES_SQL, PARITY_CUTOFF

# Fixed values (the same as eligo.constants), spelled out as SQL lists.
VALID = ("'Guilty','Guilty In Absentia','Dismissed','Nolle Prosequi','Not Guilty','Not Guilty/Acquitted',"
         "'No Indictment Presented','Not True Bill','Dismissed/Other'")
SEC_A = "'4.1-305','18.2-250.1'"
SEC_B = "'4.1-305','18.2-96','18.2-103','18.2-119','18.2-120','18.2-134','18.2-250.1','18.2-415'"
SEC_BM = "'18.2-248.1'"
SEC_12 = "'18.2-36.1','18.2-36.2','18.2-51.4','18.2-51.5','18.2-57.2','18.2-266','46.2-341.24'"

DISPOSITION_CASE = """CASE disposition_code
      WHEN 'Nolle Prosequi' THEN 'Dismissed' WHEN 'No Indictment Presented' THEN 'Dismissed'
      WHEN 'Not True Bill' THEN 'Dismissed' WHEN 'Dismissed/Other' THEN 'Dismissed'
      WHEN 'Not Guilty' THEN 'Dismissed' WHEN 'Not Guilty/Acquitted' THEN 'Dismissed'
      WHEN 'Guilty In Absentia' THEN 'Conviction' WHEN 'Guilty' THEN 'Conviction'
      ELSE disposition_code END"""


def _labels_sql(dialect: str) -> str:
    """Base label CASE (first branch = rule written last)."""
    D, M, F = "disposition_category", "charge_category = 'Misdemeanor'", "charge_category = 'Felony'"
    cs = "code_section_category"
    if dialect == "d1":
        bad = "(has_class_1_or_2 OR has_class_3_or_4 OR any_felony OR same_day_charge)"
        c12 = "'covered in 19.2-392.12'"
        return f"""CASE
      WHEN {F} AND ({cs} = {c12} OR next_conviction_disqualifier_after_felony OR {bad}) THEN 'Not eligible'
      WHEN {F} AND {cs} <> {c12} AND NOT next_conviction_disqualifier_after_felony AND NOT {bad} THEN 'Petition'
      WHEN {M} AND {D} = 'Conviction' AND (next_conviction_disqualifier_after_misdemeanor OR {bad}
           OR {cs} = {c12}) THEN 'Not eligible'
      WHEN {M} AND {D} = 'Conviction' AND NOT next_conviction_disqualifier_after_misdemeanor AND NOT {bad}
           AND {cs} = 'covered elsewhere' THEN 'Petition'
      WHEN {M} AND {D} = 'Conviction' AND NOT next_conviction_disqualifier_after_misdemeanor AND NOT {bad}
           AND {cs} IN ('covered in 19.2-392.6 - A', 'covered in 19.2-392.6 - B') THEN 'Automatic'
      WHEN {M} AND {D} <> 'Conviction' AND ({D} = 'Deferral Dismissal' OR has_conviction OR arrest_disqualifier)
           THEN 'Petition'
      WHEN {M} AND {D} = 'Dismissed' AND NOT has_conviction AND NOT arrest_disqualifier THEN 'Automatic'
      ELSE 'Not eligible' END"""
    ok3 = "(NOT has_class_3_or_4 OR NOT felony_conviction_disqualifier OR NOT has_class_1_or_2)"
    ok3p = ok3 if dialect == "d3" else (
        "(NOT has_class_3_or_4 AND NOT felony_conviction_disqualifier AND NOT has_class_1_or_2)")
    s8 = (f"({D} IN ('Conviction','Deferral Dismissal') AND {F} AND {cs} <> 'excluded by 19.2-392.12' "
          f"AND {{ok}} AND NOT next_conviction_disqualifier_after_felony)")
    s9 = (f"({D} = 'Conviction' AND {M} AND {cs} = 'covered elsewhere' AND {{ok}} "
          f"AND NOT next_conviction_disqualifier_after_misdemeanor)")
    s3 = (f"({D} = 'Conviction' AND {M} AND {cs} IN ('covered in 19.2-392.6 - A','covered in 19.2-392.6 - B') "
          f"AND NOT next_conviction_disqualifier_after_misdemeanor)")
    return f"""CASE
      WHEN ({s8.format(ok=ok3p)} AND pending_after_felony) OR ({s9.format(ok=ok3p)} AND pending_after_misdemeanor)
        THEN 'Petition (pending)'
      WHEN ({D} = 'Deferral Dismissal' AND {M} AND {cs} IN ('covered elsewhere','covered in 19.2-392.6 - B'))
        OR ({D} = 'Dismissed' AND {F})
        OR ({D} = 'Dismissed' AND {M} AND (arrest_disqualifier OR has_conviction))
        OR {s8.format(ok=ok3)} OR {s9.format(ok=ok3)} THEN 'Petition'
      WHEN {s3} AND pending_after_misdemeanor THEN 'Automatic (pending)'
      WHEN ({D} = 'Dismissed' AND {M} AND NOT arrest_disqualifier AND NOT has_conviction)
        OR ({D} = 'Deferral Dismissal' AND {M} AND {cs} = 'covered in 19.2-392.6 - A')
        OR {s3} THEN 'Automatic'
      ELSE 'Not eligible' END"""


def _sql_list(values) -> str:
    return ",".join("'" + v + "'" for v in values)


def pipeline_sql(dialect: str = "d3", sameday: bool = True, lifetime: bool = True,
                 cutoff: str = PARITY_CUTOFF, apply_cutoff: bool = True, source: str = CHARGES_SQL,
                 years=(3, 10, 7, 10), limit: int = 2, sections=None) -> str:
    """CTE chain ending in relation ``final`` (one row per classified charge).

    ``years`` = (since arrest, since felony, until conviction after misdemeanor, after felony);
    ``sections`` = optional (A, B, B-misdemeanor, 12) lists replacing the defaults.
    """
    y_arr, y_fel, y_mis, y_felony_after = years
    SEC_A_, SEC_B_, SEC_BM_, SEC_12_ = (SEC_A, SEC_B, SEC_BM, SEC_12) if sections is None else tuple(
        _sql_list(x) for x in sections)
    cut = f"DATE '{cutoff}'"
    where = f"hearing_date < {cut}" if apply_cutoff else "hearing_date IS NOT NULL"
    if dialect == "d3":
        csc = f"""CASE WHEN cs IN ({SEC_A_}) AND disposition_category = 'Deferral Dismissal' THEN 'covered in 19.2-392.6 - A'
        WHEN cs IN ({SEC_B_}) OR (cs IN ({SEC_BM_}) AND charge_category = 'Misdemeanor') THEN 'covered in 19.2-392.6 - B'
        WHEN cs IN ({SEC_12_}) THEN 'excluded by 19.2-392.12' ELSE 'covered elsewhere' END"""
    else:
        twelve = "covered in 19.2-392.12" if dialect == "d1" else "excluded by 19.2-392.12"
        csc = f"""CASE WHEN cs IN ({SEC_12_}) THEN '{twelve}'
        WHEN cs IN ({SEC_A_}) AND disposition_category = 'Deferral Dismissal' THEN 'covered in 19.2-392.6 - A'
        WHEN cs IN ({SEC_B_}) OR (cs IN ({SEC_BM_}) AND charge_category = 'Misdemeanor') THEN 'covered in 19.2-392.6 - B'
        ELSE 'covered elsewhere' END"""
    if dialect == "d2":
        c12 = "charge_category = 'Felony' AND coalesce(charge_class IN ('1','2'), false)"
        c34 = "charge_category = 'Felony' AND coalesce(charge_class IN ('3','4'), false)"
    else:
        c12 = "fel_conv AND coalesce(charge_class IN ('1','2'), false)"
        c34 = "fel_conv AND coalesce(charge_class IN ('3','4'), false)"
    dpy = 365.2425 if dialect == "d3" else 365.25
    if dialect == "d3":
        pend7 = f"coalesce(from_present_delta < {y_mis * dpy}, false)"
        pend10 = f"coalesce(from_present_delta < {y_felony_after * dpy}, false)"
    else:
        pend7 = f"hearing_date > CAST({cut} - INTERVAL {y_mis} YEAR AS DATE)"
        pend10 = f"hearing_date > CAST({cut} - INTERVAL {y_felony_after} YEAR AS DATE)"
    before = "PARTITION BY person_id ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    after = "PARTITION BY person_id ORDER BY day RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    auto = "('Automatic','Automatic (pending)')"
    if not sameday:
        sd = "CAST(NULL AS BOOLEAN)"
    elif dialect == "d2":
        sd = f"(base_label IN {auto} AND bool_or(base_label NOT IN {auto}) OVER (PARTITION BY person_id, hearing_date))"
    else:
        sd = f"bool_or(base_label NOT IN {auto}) OVER (PARTITION BY person_id, hearing_date)"
    counted = ("sameday_label IN ('Automatic','Petition')" if dialect == "d2"
               else "sameday_label <> 'Not eligible'")
    if lifetime:
        lt = f"""(SUM(CASE WHEN {counted} THEN 1 ELSE 0 END) OVER (PARTITION BY person_id ORDER BY hearing_date, id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > {limit})
            AND (disposition_category = 'Conviction'
                 OR (disposition_category = 'Deferral Dismissal' AND coalesce(sameday_disqualifier, false)))"""
    else:
        lt = "CAST(NULL AS BOOLEAN)"
    return f"""charges AS ({source}),
c0 AS (
  SELECT *, {DISPOSITION_CASE} AS dc0, charge_type AS charge_category, coalesce(code_section, 'MISSING') AS cs
  FROM charges
  WHERE {where} AND disposition_code IN ({VALID}) AND charge_type IN ('Misdemeanor','Felony')
),
c1 AS (
  SELECT *, CASE WHEN plea IN ('Alford','Guilty','Nolo Contendere') AND dc0 = 'Dismissed'
                 THEN 'Deferral Dismissal' ELSE dc0 END AS disposition_category
  FROM c0
),
c2 AS (
  SELECT *, {csc} AS code_section_category,
    CAST(hearing_date - DATE '1970-01-01' AS INTEGER) AS day,
    disposition_category = 'Conviction' AS conv,
    disposition_category = 'Conviction' AND charge_category = 'Felony' AS fel_conv
  FROM c1
),
c3 AS (
  SELECT *,
    bool_or(conv) OVER (PARTITION BY person_id) AS has_conviction,
    bool_or({c12}) OVER (PARTITION BY person_id) AS has_class_1_or_2,
    bool_or({c34}) OVER (PARTITION BY person_id) AS has_class_3_or_4,
    max(day) OVER ({before}) AS last_day,
    max(CASE WHEN fel_conv THEN day END) OVER ({before}) AS last_fel_day,
    min(CASE WHEN conv THEN day END) OVER ({after}) AS next_conv_day,
    count(*) OVER (PARTITION BY person_id, hearing_date) AS day_rows
  FROM c2
),
c4 AS (
  SELECT *,
    CAST(DATE '1970-01-01' + last_day AS DATE) AS last_hearing_date,
    CAST(DATE '1970-01-01' + last_fel_day AS DATE) AS last_felony_conviction_date,
    CAST(DATE '1970-01-01' + next_conv_day AS DATE) AS next_conviction_date,
    CAST(day - last_day AS INTEGER) AS last_hearing_delta,
    CAST(day - last_fel_day AS INTEGER) AS last_felony_conviction_delta,
    CAST(next_conv_day - day AS INTEGER) AS next_conviction_delta,
    CAST({cut} - hearing_date AS INTEGER) AS from_present_delta,
    last_fel_day IS NOT NULL AS any_felony,
    day_rows > 1 AS same_day_charge
  FROM c3
),
c5 AS (
  SELECT *,
    coalesce(last_hearing_delta < {y_arr * dpy}, false) AS arrest_disqualifier,
    coalesce(last_felony_conviction_delta < {y_fel * dpy}, false) AS felony_conviction_disqualifier,
    coalesce(next_conviction_delta < {y_mis * dpy}, false) AS next_conviction_disqualifier_after_misdemeanor,
    coalesce(next_conviction_delta < {y_felony_after * dpy}, false) AS next_conviction_disqualifier_after_felony,
    {pend7} AS pending_after_misdemeanor,
    {pend10} AS pending_after_felony
  FROM c4
),
c6 AS (SELECT *, {_labels_sql(dialect)} AS base_label FROM c5),
c7 AS (SELECT *, {sd} AS sameday_disqualifier FROM c6),
c8 AS (
  SELECT *, CASE WHEN coalesce(sameday_disqualifier, false) AND base_label = 'Automatic' THEN 'Petition'
                 WHEN coalesce(sameday_disqualifier, false) AND base_label = 'Automatic (pending)'
                   THEN 'Petition (pending)'
                 ELSE base_label END AS sameday_label
  FROM c7
),
c9 AS (SELECT *, {lt} AS lifetime_disqualifier FROM c8),
final AS (
  SELECT *, CASE WHEN coalesce(lifetime_disqualifier, false) THEN 'Not eligible' ELSE sameday_label END
    AS expungability
  FROM c9
)"""


def with_pipeline(select: str, **kwargs) -> str:
    return f"WITH {pipeline_sql(**kwargs)}\n{select}"


FEATURE_COLS = (
    "id AS charge_id, 'default' AS run_id, disposition_category, charge_category, code_section_category, "
    "has_conviction, last_hearing_date, last_felony_conviction_date, next_conviction_date, last_hearing_delta, "
    "last_felony_conviction_delta, next_conviction_delta, from_present_delta, arrest_disqualifier, "
    "felony_conviction_disqualifier, next_conviction_disqualifier_after_misdemeanor, "
    "next_conviction_disqualifier_after_felony, pending_after_misdemeanor, pending_after_felony, has_class_1_or_2, "
    "has_class_3_or_4, lifetime_disqualifier, sameday_disqualifier"
)

ORACLE: dict[str, str] = {
    "label_counts": with_pipeline(
        "SELECT expungability, count(*) AS n_charges FROM final GROUP BY expungability"),
    "classify_outcomes": with_pipeline(
        "SELECT id AS charge_id, 'default' AS run_id, expungability FROM final"),
    "classify_features": with_pipeline(f"SELECT {FEATURE_COLS} FROM final"),
}


def _ids(cols: str, **kw) -> str:
    return with_pipeline(f"SELECT id AS charge_id, {cols} FROM final", **kw)


D2 = {"dialect": "d2", "apply_cutoff": False}

REASON_CASE = """CASE
  WHEN disposition_category = 'Dismissed' AND charge_category = 'Felony' THEN 'Dismissal of felony charges'
  WHEN disposition_category = 'Dismissed' AND charge_category = 'Misdemeanor' AND arrest_disqualifier
    THEN 'Dismissal of misdemeanor charges, but with arrests or charges in the past 3 years'
  WHEN disposition_category = 'Dismissed' AND charge_category = 'Misdemeanor' AND has_conviction
    THEN 'Dismissal of misdemeanor charges with no arrests or charges in the past 3 years, but with prior convictions on the person''s record'
  WHEN disposition_category = 'Dismissed' AND charge_category = 'Misdemeanor'
    THEN 'Dismissal of misdemeanor charges with no arrests or charges in the past 3 years and no convictions on the person''s record'
  WHEN disposition_category = 'Deferral Dismissal' AND charge_category = 'Misdemeanor'
       AND code_section_category = 'covered in 19.2-392.6 - A'
    THEN 'Deferred dismissal of misdemeanor charges covered under 19.2-392.6-A'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Misdemeanor'
       AND code_section_category = 'excluded by 19.2-392.12'
    THEN 'Conviction or deferred dismissal of misdemeanor charges that are excluded from expungement by 19.2-392.12'
  WHEN disposition_category = 'Deferral Dismissal' AND charge_category = 'Misdemeanor'
    THEN 'Deferred dismissal of misdemeanor charges not covered under 19.2-392.6-A'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
       AND next_conviction_disqualifier_after_misdemeanor
    THEN 'Conviction of misdemeanor charges that are not excluded from expungement by 19.2-392.12, but with convictions of another kind within 7 years from disposition date'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
       AND code_section_category IN ('covered in 19.2-392.6 - A', 'covered in 19.2-392.6 - B')
       AND base_label IN ('Automatic (pending)', 'Petition (pending)')
    THEN 'Conviction of misdemeanor charges listed in 19.2-392.6 B with no convictions since the disposition date. However, because the disposition date is within 7 years of the current date, the record is not yet eligible for expungement'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
       AND code_section_category IN ('covered in 19.2-392.6 - A', 'covered in 19.2-392.6 - B')
    THEN 'Conviction of misdemeanor charges listed in 19.2-392.6 B with no convictions within 7 years from disposition date'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
       AND has_class_3_or_4 AND felony_conviction_disqualifier AND has_class_1_or_2
    THEN 'Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement under 19.2-392.12, but with a prior conviction for a class 1 or 2 felony or another felony punishable by imprisonment for life'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
       AND base_label IN ('Automatic (pending)', 'Petition (pending)')
    THEN 'Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another kind since the disposition date. However, because the disposition date is within 7 years of the current date, the record is not yet eligible for expungement'
  WHEN disposition_category = 'Conviction' AND charge_category = 'Misdemeanor'
    THEN 'Conviction of misdemeanor charges not listed in 19.2-392.6 A or B and not ineligible for expungement under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another kind within 7 years from disposition date'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Felony'
       AND code_section_category = 'excluded by 19.2-392.12'
    THEN 'Conviction or deferred dismissal of felony charges that are ineligible for expungement under 19.2-392.12'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Felony'
       AND next_conviction_disqualifier_after_felony
    THEN 'Conviction or deferred dismissal of felony charges, but with convictions within 10 years from disposition date'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Felony'
       AND has_class_3_or_4 AND felony_conviction_disqualifier AND has_class_1_or_2
    THEN 'Conviction or deferred dismissal of felony charges, but with a prior conviction of a Class 1 or 2 felony or any other felony punishable by imprisonment for life'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Felony'
       AND base_label IN ('Automatic (pending)', 'Petition (pending)')
    THEN 'Conviction or deferred dismissal of felony charges that are not ones listed under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another kind since disposition date. However, because the disposition date is within 10 years of the current date, the record is not yet eligible for expungement'
  WHEN disposition_category IN ('Deferral Dismissal', 'Conviction') AND charge_category = 'Felony'
    THEN 'Conviction or deferred dismissal of felony charges that are not ones listed under 19.2-392.12, with no felonies within the last 10 years, no class 3 or 4 felony conviction within the past 20 years, no class 1 or 2 felony or any other felony punishable by imprisonment for life, and no convictions of another kind within 10 years from disposition date'
END"""

LIFETIME_SUFFIX_SQL = ("'; HOWEVER, the outcome is changed to not eligible because the lifetime limit of two "
                       "expungements has been exceeded'")

SAMEDAY_SUFFIX_SQL = ("'; HOWEVER, the outcome is changed to petition because of a conviction on the same day of something "
                      "that is not automatically expungable'")

ORACLE.update({
    "disposition_category": f"""WITH charges AS ({CHARGES_SQL})
SELECT id, disposition_code, plea,
  CASE WHEN plea IN ('Alford','Guilty','Nolo Contendere') AND ({DISPOSITION_CASE}) = 'Dismissed'
       THEN 'Deferral Dismissal' ELSE {DISPOSITION_CASE} END AS disposition_category
FROM charges""",
    "code_section_category": with_pipeline("SELECT id, code_section, code_section_category FROM c2"),
    "has_conviction": _ids("has_conviction"),
    "last_hearing_date": _ids("last_hearing_date, last_hearing_delta"),
    "last_felony_conviction_date": _ids("last_felony_conviction_date, last_felony_conviction_delta"),
    "next_conviction_date": _ids("next_conviction_date, next_conviction_delta"),
    "gap_days": _ids("last_hearing_delta, last_felony_conviction_delta, next_conviction_delta, from_present_delta"),
    "gap_flags": _ids("arrest_disqualifier, felony_conviction_disqualifier, "
                      "next_conviction_disqualifier_after_misdemeanor, next_conviction_disqualifier_after_felony, "
                      "pending_after_misdemeanor, pending_after_felony"),
    "class_flags": _ids("has_class_1_or_2, has_class_3_or_4"),
    "base_label_d3": _ids("base_label"),
    "base_label_d2": _ids("base_label", **D2),
    "base_label_d1": _ids("base_label", dialect="d1"),
    "decision_table_join": _ids("base_label AS expungability"),
    "sameday_rule": _ids("sameday_disqualifier, sameday_label"),
    "lifetime_rule": _ids("lifetime_disqualifier, expungability"),
    "lifetime_rule_d2": _ids("sameday_disqualifier, lifetime_disqualifier, expungability", **D2),
    "rules_off": _ids("sameday_disqualifier, lifetime_disqualifier, expungability", sameday=False, lifetime=False),
    "reason_text": _ids(f"""expungability, {REASON_CASE} ||
        CASE WHEN coalesce(lifetime_disqualifier, false) AND sameday_label <> 'Not eligible'
             THEN {LIFETIME_SUFFIX_SQL} ELSE '' END AS reason""", **D2),
    "old_rule_flag": _ids("disposition_category = 'Dismissed' AS old_expungable", **D2),
    "interval_flags_d2": _ids("arrest_disqualifier AS arrests, felony_conviction_disqualifier AS felony10, "
                              "next_conviction_disqualifier_after_misdemeanor AS sevenyear, "
                              "next_conviction_disqualifier_after_felony AS tenyear, "
                              "pending_after_misdemeanor AS within7, pending_after_felony AS within10", **D2),
})


CH = f"charges AS ({CHARGES_SQL})"

RACE_SQL = """CASE
    WHEN regexp_matches(upper(race), 'OTHER|MISSING|UNKNOWN') THEN 'Unknown'
    WHEN regexp_matches(upper(race), 'AMERICAN INDIAN|NATIVE') THEN 'American Indian or Alaskan Native'
    WHEN regexp_matches(upper(race), '(^|[^A-Z])ASIAN') THEN 'Asian or Pacific Islander'
    WHEN regexp_matches(upper(race), 'WHITE|CAUCASIAN') THEN 'White'
    WHEN regexp_matches(upper(race), 'BLACK') THEN 'Black'
    ELSE race END"""
RACE_FIELD_X = r"regexp_replace(regexp_replace(upper(race), '\(.*?\)', '', 'g'), '^\s+|\s+$', '', 'g')"
RACE_FIELD_SQL = f"""CASE {RACE_FIELD_X}
    WHEN 'WHITE CAUCASIAN' THEN 'WHITE' WHEN 'AMERICAN INDIAN' THEN 'AMERICAN INDIAN OR ALASKAN NATIVE'
    WHEN 'OTHER' THEN 'UNKNOWN' WHEN 'MISSING' THEN 'UNKNOWN' ELSE {RACE_FIELD_X} END"""
FIPS_SQL = "CASE WHEN length(fips) < 3 THEN lpad(fips, 3, '0') ELSE fips END"
CLEAN = (f"{CH}, clean AS (SELECT id, person_id, hearing_date, code_section, charge_type, charge_class, "
         f"disposition_code, plea, {RACE_SQL} AS race, sex, {FIPS_SQL} AS fips, locality FROM charges "
         f"WHERE hearing_date <= DATE '{PARITY_CUTOFF}')")
DIST = ("dist AS (SELECT code_section, count(*) AS n, ROUND(CAST(count(*) AS DOUBLE) * 100.0 / "
        "CAST(SUM(count(*)) OVER () AS DOUBLE), 2) AS percent FROM clean GROUP BY code_section)")
CUM = ("cum AS (SELECT *, ROUND(SUM(percent) OVER (ORDER BY percent DESC, code_section ASC NULLS FIRST "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_percent FROM dist WHERE percent > 1.0)")

LOOKBACK = f"""{CH},
r AS (SELECT *, CAST(hearing_date - DATE '1970-01-01' AS INTEGER) AS day,
        coalesce(disposition_code IN ('Guilty', 'Guilty In Absentia'), false) AS conv FROM charges),
r2 AS (SELECT *, conv AND coalesce(charge_type = 'Felony', false) AS fel FROM r),
lb AS (SELECT id,
  coalesce(bool_or(conv) OVER (PARTITION BY person_id ORDER BY day RANGE BETWEEN 2556 PRECEDING AND 1 PRECEDING),
           false) AS seven_year,
  coalesce(bool_or(fel) OVER (PARTITION BY person_id ORDER BY day RANGE BETWEEN 3652 PRECEDING AND 1 PRECEDING),
           false) AS ten_year,
  coalesce(bool_or(fel AND coalesce(charge_class IN ('1','2'), false)) OVER (PARTITION BY person_id ORDER BY day
           RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS class_12,
  coalesce(bool_or(fel AND coalesce(charge_class IN ('3','4'), false)) OVER (PARTITION BY person_id ORDER BY day
           RANGE BETWEEN 7305 PRECEDING AND 1 PRECEDING), false) AS class_34
  FROM r2)"""

PERSON_COUNTS = """pc AS (SELECT person_id,
    CAST(SUM(CASE WHEN expungability = 'Automatic' THEN 1 ELSE 0 END) AS BIGINT) AS automatic,
    CAST(SUM(CASE WHEN expungability = 'Petition' THEN 1 ELSE 0 END) AS BIGINT) AS petition,
    CAST(SUM(CASE WHEN expungability = 'Automatic (pending)' THEN 1 ELSE 0 END) AS BIGINT) AS automatic_pending,
    CAST(SUM(CASE WHEN expungability = 'Petition (pending)' THEN 1 ELSE 0 END) AS BIGINT) AS petition_pending,
    CAST(SUM(CASE WHEN expungability = 'Not eligible' THEN 1 ELSE 0 END) AS BIGINT) AS not_eligible,
    CAST(SUM(CASE WHEN disposition_category = 'Dismissed' THEN 1 ELSE 0 END) AS BIGINT) AS old_petition,
    CAST(SUM(CASE WHEN disposition_category = 'Dismissed' THEN 0 ELSE 1 END) AS BIGINT) AS old_not_eligible
  FROM final GROUP BY person_id)"""
TOTALS = ("tot AS (SELECT CAST(SUM(automatic) AS BIGINT) AS automatic, CAST(SUM(petition) AS BIGINT) AS petition, "
          "CAST(SUM(not_eligible) AS BIGINT) AS not_eligible, CAST(SUM(old_petition) AS BIGINT) AS old_petition, "
          "CAST(SUM(old_not_eligible) AS BIGINT) AS old_not_eligible FROM pc)")


def _ql_select(ref: str, title: str, codes: str, dispositions: str, types: str | None = None) -> str:
    where = f"code_section IN ({codes}) AND disposition_code IN ({dispositions})"
    if types:
        where += f" AND charge_type IN ({types})"
    return (f"SELECT '{ref}' AS reference, '{title}' AS title, hearing_date, person_id, code_section, "
            f"disposition_code, charge_type FROM charges WHERE {where}")


_T1 = "Automatic sealing of offenses resulting in a deferred and dismissed disposition or conviction."
_T2 = "Sealing of offenses resulting in a deferred and dismissed disposition or conviction by petition."
QL = f"""{CH}, ql AS (
  {_ql_select('19.2-392.6.A', _T1, "'4.1-305','18.2-250.1'", "'Dismissed'")}
  UNION ALL {_ql_select('19.2-392.6.B', _T1, "'4.1-305','18.2-96','18.2-103','18.2-119','18.2-120','18.2-134'", "'Guilty'")}
  UNION ALL {_ql_select('19.2-392.6.B-misdemeanor', _T1, "'18.2-248.1','18.2-250.1','18.2-415'", "'Guilty'", "'Misdemeanor'")}
  UNION ALL {_ql_select('19.2-392.12', _T2, SEC_12, "'Deferred','Dismissed'")})"""
OLD_LAW_SQL = ("'Dismissed','Dismissed/Other','Nolle Prosequi','Not Guilty/Acquitted',"
               "'Not Guilty By Reason Of Insanity','Not True Bill','Not Guilty','Not Guilty/Insanity'")
# How many of the queries each charge matches.
QL_MATCHES = f"""SELECT *,
    CAST(coalesce(code_section IN ('4.1-305','18.2-250.1') AND disposition_code = 'Dismissed', false) AS INTEGER)
    + CAST(coalesce(code_section IN ('4.1-305','18.2-96','18.2-103','18.2-119','18.2-120','18.2-134')
           AND disposition_code = 'Guilty', false) AS INTEGER)
    + CAST(coalesce(code_section IN ('18.2-248.1','18.2-250.1','18.2-415') AND disposition_code = 'Guilty'
           AND charge_type = 'Misdemeanor', false) AS INTEGER)
    + CAST(coalesce(code_section IN ({SEC_12}) AND disposition_code IN ('Deferred','Dismissed'), false) AS INTEGER) AS n_queries
  FROM charges"""
YEAR_SUMMARY = f"""{QL},
t AS (SELECT CAST(year(hearing_date) AS INTEGER) AS year, count(*) AS total,
        count(*) FILTER (WHERE disposition_code IN ({OLD_LAW_SQL})) AS old_law FROM charges GROUP BY 1),
nl AS (SELECT CAST(year(hearing_date) AS INTEGER) AS year, count(*) AS new_law FROM ql GROUP BY 1),
ys AS (SELECT t.year, t.total, t.old_law, CAST(coalesce(nl.new_law, 0) AS BIGINT) AS new_law
       FROM t LEFT JOIN nl ON t.year = nl.year)"""

ORACLE.update({
    "race_standardize": f"WITH {CH} SELECT id, race AS race_raw, {RACE_SQL} AS race FROM charges",
    "race_standardize_alt": f"WITH {CH} SELECT id, {RACE_FIELD_SQL} AS race_field FROM charges",
    "fips_pad": f"WITH {CH} SELECT id, fips AS fips_raw, {FIPS_SQL} AS fips FROM charges",
    "ingest_clean": f"WITH {CLEAN} SELECT * FROM clean",
    "lookback_flags_d0": f"WITH {LOOKBACK} SELECT id AS charge_id, seven_year, ten_year, class_12, class_34 FROM lb",
    "feature_summary_d0": f"""WITH {LOOKBACK} SELECT count(*) AS total_rows,
        count(*) FILTER (WHERE seven_year) AS seven_year_rows, count(*) FILTER (WHERE ten_year) AS ten_year_rows,
        count(*) FILTER (WHERE class_12) AS class_12_rows, count(*) FILTER (WHERE class_34) AS class_34_rows
        FROM lb""",
    "mode_impute": with_pipeline("""SELECT f.id AS charge_id, coalesce(f.race, rm.race, 'MISSING') AS race,
        coalesce(f.sex, sm.sex, 'MISSING') AS sex
      FROM final f
      LEFT JOIN (SELECT person_id, race FROM (SELECT person_id, race, row_number() OVER (PARTITION BY person_id
                 ORDER BY cnt DESC, race ASC) AS rk FROM (SELECT person_id, race, count(*) AS cnt FROM final
                 WHERE race IS NOT NULL GROUP BY person_id, race)) WHERE rk = 1) rm ON f.person_id = rm.person_id
      LEFT JOIN (SELECT person_id, sex FROM (SELECT person_id, sex, row_number() OVER (PARTITION BY person_id
                 ORDER BY cnt DESC, sex ASC) AS rk FROM (SELECT person_id, sex, count(*) AS cnt FROM final
                 WHERE sex IS NOT NULL GROUP BY person_id, sex)) WHERE rk = 1) sm ON f.person_id = sm.person_id""",
                                 **D2),
    "person_label_counts": with_pipeline(f", {PERSON_COUNTS} SELECT * FROM pc", **D2).replace(
        ")\n, pc AS", "),\npc AS"),
    "old_vs_new_totals": with_pipeline(f", {PERSON_COUNTS}, {TOTALS} SELECT *, (old_petition + old_not_eligible) - "
                                       "(automatic + petition + not_eligible) AS difference FROM tot", **D2),
    "old_vs_new_unpivot": with_pipeline(f""", {PERSON_COUNTS}, {TOTALS},
        lg AS (UNPIVOT tot ON automatic, petition, not_eligible, old_petition, old_not_eligible
               INTO NAME name VALUE value)
        SELECT name, value, CASE WHEN contains(name, 'old') THEN 'Old Law' ELSE 'New Law' END AS law,
          CASE name WHEN 'automatic' THEN 'Automatic Exp.' WHEN 'petition' THEN 'Exp. w/ Petition'
            WHEN 'not_eligible' THEN 'Not Eligible' WHEN 'old_petition' THEN 'Exp. w/ Petition'
            WHEN 'old_not_eligible' THEN 'Not Eligible' END AS label FROM lg""", **D2),
    "code_distribution": f"WITH {CLEAN}, {DIST} SELECT * FROM dist",
    "code_cumulative": f"WITH {CLEAN}, {DIST}, {CUM} SELECT * FROM cum",
    "race_distribution": f"""WITH {CLEAN} SELECT race, count(*) AS n, ROUND(CAST(count(*) AS DOUBLE) * 100.0 /
        CAST(SUM(count(*)) OVER () AS DOUBLE), 2) AS percent FROM clean GROUP BY race""",
    "code_by_race": f"""WITH {CLEAN}, {DIST}, {CUM}
        SELECT c.code_section, e.race, count(*) AS n, ROUND(CAST(count(*) AS DOUBLE) * 100.0 /
          CAST(SUM(count(*)) OVER (PARTITION BY c.code_section) AS DOUBLE), 2) AS percent
        FROM cum c JOIN clean e ON c.code_section = e.code_section GROUP BY c.code_section, e.race""",
    "top_races": f"""WITH {CLEAN} SELECT race, count(*) AS n FROM clean GROUP BY race
        ORDER BY n DESC, race ASC NULLS FIRST LIMIT 10""",
    "race_by_sex": with_pipeline("SELECT race, sex, count(expungability) AS n FROM final GROUP BY race, sex"),
    "distinct_counts": f"""WITH {CH} SELECT count(person_id) AS n_rows, count(DISTINCT person_id) AS n_persons,
        count(DISTINCT code_section) AS n_codes FROM charges""",
    "missing_code_count": f"""WITH {CH} SELECT CAST(year(hearing_date) AS INTEGER) AS year,
        count(*) FILTER (WHERE code_section IS NULL OR code_section = '') AS n_missing, count(*) AS n_rows
        FROM charges GROUP BY 1""",
    "race_field_counts": f"""WITH {CH}, x AS (SELECT {RACE_FIELD_SQL} AS race FROM charges
        WHERE code_section IN ('A.46.2-862')) SELECT race, count(*) AS n FROM x WHERE race IS NOT NULL
        GROUP BY race""",
    "rare_disposition_localities": f"""WITH {CH} SELECT locality, count(*) AS n FROM charges
        WHERE disposition_code IN ('Complied With Law','Resolved','Certified Misdemeanor','Granted','Denied')
          AND locality IS NOT NULL GROUP BY locality""",
    "code_pattern_by_year": f"""WITH {CH} SELECT CAST(year(hearing_date) AS INTEGER) AS year, count(*) AS n FROM charges
        WHERE regexp_matches(code_section, '18.2-248.1') GROUP BY 1""",
    "group_having": with_pipeline("""SELECT race, count(*) AS n, ROUND(avg(last_hearing_delta), 4) AS mean_value
        FROM final GROUP BY race HAVING count(*) > 1 AND avg(last_hearing_delta) IS NOT NULL"""),
    "query_list_union": f"WITH {QL} SELECT * FROM ql",
    "query_list_by_year": f"WITH {QL} SELECT CAST(year(hearing_date) AS INTEGER) AS year, count(*) AS n FROM ql GROUP BY 1",
    "query_list_by_year_reference": f"""WITH {QL} SELECT CAST(year(hearing_date) AS INTEGER) AS year, reference, count(*) AS n
        FROM ql GROUP BY 1, 2""",
    "query_list_by_year_code": f"""WITH {QL} SELECT CAST(year(hearing_date) AS INTEGER) AS year, code_section, count(*) AS n
        FROM ql GROUP BY 1, 2""",
    "year_summary": f"WITH {YEAR_SUMMARY} SELECT * FROM ys",
    "year_summary_percent": f"""WITH {YEAR_SUMMARY},
        lg AS (UNPIVOT ys ON new_law, old_law INTO NAME eligibility VALUE raw_count)
        SELECT year, total, eligibility, raw_count,
          printf('%.1f%%', ROUND(CAST(raw_count AS DOUBLE) * 100.0 / CAST(total AS DOUBLE), 1)) AS percent,
          format('{{:,}}', raw_count) AS count_text FROM lg""",
    "sample_persons_join": f"""WITH {CH}, ids AS (SELECT person_id FROM (SELECT DISTINCT person_id FROM charges
        WHERE person_id IS NOT NULL) ORDER BY md5(CAST(person_id AS VARCHAR) || ':12345'), person_id LIMIT 100)
        SELECT c.id, c.person_id FROM charges c JOIN ids ON c.person_id = ids.person_id""",
    "unprocessed_anti_join": with_pipeline("""SELECT c.id, c.person_id FROM charges c
        WHERE c.person_id NOT IN (SELECT person_id FROM final)""", cutoff="2005-12-31"),
    "run_diff": f"""SELECT a.charge_id, a.label_d3, b.label_d2 FROM
        ({with_pipeline("SELECT id AS charge_id, expungability AS label_d3 FROM final")}) a JOIN
        ({with_pipeline("SELECT id AS charge_id, expungability AS label_d2 FROM final", dialect="d2")}) b
        ON a.charge_id = b.charge_id WHERE a.label_d3 <> b.label_d2""",
    "confusion_matrix": with_pipeline("SELECT base_label AS label, base_label AS prediction, count(*) AS n "
                                      "FROM final GROUP BY 1, 2"),
    "peek_charges": f"WITH {CH} SELECT * FROM charges ORDER BY id LIMIT 5",
    "distinct_persons": f"WITH {CH} SELECT DISTINCT person_id FROM charges",
    "person_lookup": f"WITH {CH} SELECT * FROM charges WHERE person_id = 1",
})


ORACLE["classified_file_d2"] = with_pipeline(f"""SELECT f.person_id, f.hearing_date AS HearingDate,
    f.code_section AS CodeSection, f.code_section_category, f.charge_type AS ChargeType,
    f.charge_category, f.charge_class AS Class, f.disposition_code AS DispositionCode,
    f.disposition_category, f.plea AS Plea, coalesce(f.race, rm.race, 'MISSING') AS Race,
    coalesce(f.sex, sm.sex, 'MISSING') AS Sex, f.fips, f.has_conviction AS convictions,
    f.arrest_disqualifier AS arrests, f.felony_conviction_disqualifier AS felony10,
    f.next_conviction_disqualifier_after_misdemeanor AS sevenyear,
    f.next_conviction_disqualifier_after_felony AS tenyear, f.pending_after_misdemeanor AS within7,
    f.pending_after_felony AS within10, f.has_class_1_or_2 AS class1_2, f.has_class_3_or_4 AS class3_4,
    f.expungability AS expungable, f.disposition_category = 'Dismissed' AS old_expungable,
    f.sameday_label AS expungable_no_lifetimelimit,
    {REASON_CASE.replace('disposition_category', 'f.disposition_category').replace('charge_category', 'f.charge_category')} ||
      CASE WHEN coalesce(f.lifetime_disqualifier, false) AND f.sameday_label <> 'Not eligible'
           THEN {LIFETIME_SUFFIX_SQL} ELSE '' END AS reason,
    coalesce(f.sameday_disqualifier, false) AS sameday, coalesce(f.lifetime_disqualifier, false) AS lifetime
  FROM final f
  LEFT JOIN (SELECT person_id, race FROM (SELECT person_id, race, row_number() OVER (PARTITION BY person_id
             ORDER BY cnt DESC, race ASC) AS rk FROM (SELECT person_id, race, count(*) AS cnt FROM final
             WHERE race IS NOT NULL GROUP BY person_id, race)) WHERE rk = 1) rm ON f.person_id = rm.person_id
  LEFT JOIN (SELECT person_id, sex FROM (SELECT person_id, sex, row_number() OVER (PARTITION BY person_id
             ORDER BY cnt DESC, sex ASC) AS rk FROM (SELECT person_id, sex, count(*) AS cnt FROM final
             WHERE sex IS NOT NULL GROUP BY person_id, sex)) WHERE rk = 1) sm ON f.person_id = sm.person_id""",
                                             **D2)


def _line_field(c: str) -> str:
    return f"coalesce(regexp_replace(CAST({c} AS VARCHAR), ',', '..'), 'NA')"


ORACLE.update({
    "person_file_lines": f"""WITH {CH} SELECT id, person_id, concat_ws(',', {', '.join(_line_field(c) for c in (
        'person_id', 'hearing_date', 'code_section', 'charge_type', 'charge_class', 'disposition_code', 'plea',
        'race', 'sex', 'fips', 'locality'))}) AS line FROM charges""",
    "code_distribution_sql": f"WITH {CLEAN}, {DIST}, {CUM} SELECT * FROM cum",
    "ml_tree_predict": _ids("base_label AS predicted_label"),
})


VARIANT = {"years": (5, 8, 5, 12), "limit": 3,
           "sections": (("4.1-305", "18.2-250.1"),
                        ("4.1-305", "18.2-96", "18.2-103", "18.2-119", "18.2-120", "18.2-134", "18.2-250.1",
                         "18.2-415", "18.2-95"),
                        ("18.2-248.1",),
                        ("18.2-36.1", "18.2-36.2", "18.2-51.4", "18.2-51.5", "18.2-57.2", "18.2-266", "46.2-341.24"))}

ORACLE.update({
    "classify_variant_config": _ids("code_section_category, arrest_disqualifier, felony_conviction_disqualifier, "
                                    "pending_after_misdemeanor, pending_after_felony, lifetime_disqualifier, "
                                    "expungability", **VARIANT),
    "config_variant_diff": f"""SELECT a.label_default, b.label_variant, count(*) AS n_charges FROM
        ({with_pipeline("SELECT id AS charge_id, expungability AS label_default FROM final")}) a JOIN
        ({with_pipeline("SELECT id AS charge_id, expungability AS label_variant FROM final", **VARIANT)}) b
        ON a.charge_id = b.charge_id WHERE a.label_default <> b.label_variant GROUP BY 1, 2""",
})


ORACLE["persons_without_counts"] = with_pipeline(f""", {PERSON_COUNTS}
    SELECT p.person_id FROM (SELECT DISTINCT person_id FROM charges) p
    LEFT JOIN pc ON p.person_id = pc.person_id WHERE pc.automatic IS NULL""", cutoff="2005-12-31")


def _profile_sql(column: str) -> str:
    """Every year with every value that occurs, and how many charges have both."""
    return f"""WITH {CH}, p AS (SELECT CAST(year(hearing_date) AS INTEGER) AS year,
        coalesce(nullif({column}, ''), 'MISSING') AS value FROM charges),
        pairs AS (SELECT y.year, v.value FROM (SELECT DISTINCT year FROM p) y CROSS JOIN (SELECT DISTINCT value FROM p) v)
        SELECT pairs.year, pairs.value, count(p.value) AS n FROM pairs
        LEFT JOIN p ON p.year IS NOT DISTINCT FROM pairs.year AND p.value = pairs.value GROUP BY 1, 2"""


ORACLE.update({
    "profile_pivot": _profile_sql("disposition_code"),
    "profile_pivot_charge_type": _profile_sql("charge_type"),
    "profile_pivot_plea": _profile_sql("plea"),
    "profile_totals": f"""WITH {CH} SELECT coalesce(nullif(disposition_code, ''), 'MISSING') AS value, count(*) AS n
        FROM charges GROUP BY 1""",
    "dropped_charges": f"""WITH {CH}, r AS (SELECT CASE WHEN hearing_date IS NULL THEN 'no hearing date'
          WHEN hearing_date >= DATE '{PARITY_CUTOFF}' THEN 'on or after the cutoff'
          WHEN disposition_code IS NULL OR disposition_code NOT IN ({VALID}) THEN 'invalid disposition'
          WHEN charge_type IS NULL OR charge_type NOT IN ('Misdemeanor', 'Felony') THEN 'not a misdemeanor or felony' END AS reason
        FROM charges) SELECT reason, count(*) AS n_charges FROM r WHERE reason IS NOT NULL GROUP BY reason""",
    "reason_text_no_lifetime": _ids(f"""expungability, {REASON_CASE} ||
        CASE WHEN sameday_label <> base_label THEN {SAMEDAY_SUFFIX_SQL} ELSE '' END AS reason""",
                                    **D2, lifetime=False),
    "year_summary_rolled_up": f"WITH {YEAR_SUMMARY} SELECT * FROM ys",
    "year_summary_by_locality": f"""WITH {CH}, q AS ({QL_MATCHES}) SELECT locality, CAST(year(hearing_date) AS INTEGER) AS year,
        count(*) AS total, count(*) FILTER (WHERE disposition_code IN ({OLD_LAW_SQL})) AS old_law,
        CAST(sum(n_queries) AS BIGINT) AS new_law FROM q GROUP BY 1, 2""",
    "large_sample": f"""WITH {CH} SELECT id FROM (SELECT DISTINCT id FROM charges)
        ORDER BY md5(CAST(id AS VARCHAR) || ':12345'), id LIMIT 7000""",
})


def _audit_sql(charges: str, outcomes: str) -> str:
    """Problem by problem, each with joins and groups of its own."""
    checks = {
        "charge without id": "SELECT id, 0 AS n FROM ac WHERE id IS NULL",
        "duplicate charge id": "SELECT id, count(*) + (SELECT count(*) FROM af WHERE af.id = ac.id) + (SELECT count(*) FROM ao WHERE ao.id = ac.id) AS n FROM ac GROUP BY id HAVING count(*) > 1",
        "duplicate feature": "SELECT id, count(*) AS n FROM af GROUP BY id HAVING count(*) > 1",
        "duplicate outcome": "SELECT id, count(*) AS n FROM ao GROUP BY id HAVING count(*) > 1",
        "feature without charge": "SELECT id, count(*) + max((SELECT count(*) FROM ao WHERE ao.id = af.id)) AS n FROM af WHERE id NOT IN (SELECT id FROM ac) GROUP BY id",
        "outcome without charge": "SELECT id, count(*) + max((SELECT count(*) FROM af WHERE af.id = ao.id)) AS n FROM ao WHERE id NOT IN (SELECT id FROM ac) GROUP BY id",
        "feature without outcome": "SELECT id, count(*) + max((SELECT count(*) FROM ac WHERE ac.id = af.id)) AS n FROM af WHERE id NOT IN (SELECT id FROM ao) GROUP BY id",
        "outcome without feature": "SELECT id, count(*) + max((SELECT count(*) FROM ac WHERE ac.id = ao.id)) AS n FROM ao WHERE id NOT IN (SELECT id FROM af) GROUP BY id",
        "charge without outcome": "SELECT id, count(*) + max((SELECT count(*) FROM af WHERE af.id = ac.id)) AS n FROM ac WHERE id NOT IN (SELECT id FROM ao) GROUP BY id",
    }
    parts = " UNION ALL ".join(f"SELECT '{k}' AS problem, count(*) AS n_ids, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, min(id) AS first_id FROM ({q})"
                               for k, q in checks.items())
    return f"""WITH ac AS MATERIALIZED ({charges}), af AS MATERIALIZED ({with_pipeline("SELECT id FROM final")}),
        ao AS MATERIALIZED ({outcomes}) {parts}"""


ORACLE.update({
    "key_audit": _audit_sql(f"WITH {CH} SELECT id FROM charges", with_pipeline("SELECT id FROM final")),
    "key_audit_across_runs": _audit_sql(
        f"WITH {CH} SELECT id FROM charges WHERE id % 7 <> 0 UNION ALL SELECT id FROM charges WHERE id % 5 = 0",
        with_pipeline("SELECT id FROM final", cutoff="2005-12-31")),
})


ORACLE.update({
    "frequent_codes": ORACLE["code_cumulative"],
    "distinct_sketch_rollup": f"""WITH {CH}
        SELECT 'key' AS level, CAST(year(hearing_date) AS INTEGER) AS year, count(DISTINCT person_id) AS n_distinct, true AS within_error
        FROM charges GROUP BY 2
        UNION ALL SELECT 'all', NULL, count(DISTINCT person_id), true FROM charges""",
    "classify_touched_persons": ORACLE["classify_outcomes"],
})


# Each rule as a plain condition over the charge's features.
_ANY_CLASS = "(NOT has_class_3_or_4 OR NOT felony_conviction_disqualifier OR NOT has_class_1_or_2)"
_MISD, _FEL = "charge_category = 'Misdemeanor'", "charge_category = 'Felony'"
_CONV, _DISM, _DEF = (f"disposition_category = '{d}'" for d in ("Conviction", "Dismissed", "Deferral Dismissal"))
_A, _B, _TWELVE, _ELSE = (f"code_section_category = '{c}'" for c in (
    "covered in 19.2-392.6 - A", "covered in 19.2-392.6 - B", "excluded by 19.2-392.12", "covered elsewhere"))
_S3 = f"{_CONV} AND {_MISD} AND ({_A} OR {_B}) AND NOT next_conviction_disqualifier_after_misdemeanor"
_S8 = f"({_CONV} OR {_DEF}) AND {_FEL} AND NOT ({_TWELVE}) AND {_ANY_CLASS} AND NOT next_conviction_disqualifier_after_felony"
_S9 = f"{_CONV} AND {_MISD} AND {_ELSE} AND {_ANY_CLASS} AND NOT next_conviction_disqualifier_after_misdemeanor"
D3_RULES_SQL = (
    ("S1", "Automatic", f"{_DISM} AND {_MISD} AND NOT arrest_disqualifier AND NOT has_conviction"),
    ("S2", "Automatic", f"{_DEF} AND {_MISD} AND {_A}"),
    ("S3", "Automatic", _S3),
    ("S4", "Automatic (pending)", f"{_S3} AND pending_after_misdemeanor"),
    ("S5", "Petition", f"{_DEF} AND {_MISD} AND ({_ELSE} OR {_B})"),
    ("S6", "Petition", f"{_DISM} AND {_FEL}"),
    ("S7", "Petition", f"{_DISM} AND {_MISD} AND (arrest_disqualifier OR has_conviction)"),
    ("S8", "Petition", _S8),
    ("S9", "Petition", _S9),
    ("S10", "Petition (pending)", f"{_S8} AND pending_after_felony"),
    ("S11", "Petition (pending)", f"{_S9} AND pending_after_misdemeanor"),
)


def _coverage_sql() -> str:
    """Every (charge, matching rule) as a row; the last rule of a charge decides, the one before it is the runner-up."""
    names = ", ".join(f"({i}, '{n}', '{label}')" for i, (n, label, _) in enumerate(D3_RULES_SQL, 1))
    hits = " UNION ALL ".join(f"SELECT id, {i} AS place FROM final WHERE {c}" for i, (_, _, c) in enumerate(D3_RULES_SQL, 1))
    return with_pipeline(f""", rules(place, rule, label) AS (VALUES {names}),
      hits AS ({hits}),
      ranked AS (SELECT id, place, max(place) OVER (PARTITION BY id) AS winner,
                        lag(place) OVER (PARTITION BY id ORDER BY place) AS below FROM hits),
      named AS (SELECT h.place, h.winner, r.label <> coalesce(b.label, 'Not eligible') AS differs
                FROM ranked h JOIN rules r ON r.place = h.place LEFT JOIN rules b ON b.place = h.below),
      pairs AS (SELECT DISTINCT h.place, h.winner, w.rule FROM ranked h JOIN rules w ON w.place = h.winner WHERE h.winner > h.place),
      hidden AS (SELECT place, string_agg(rule, ',' ORDER BY winner) AS hidden_by FROM pairs GROUP BY place),
      counts AS (SELECT place, count(*) AS n_matched, count(*) FILTER (WHERE place = winner) AS n_decided,
                        count(*) FILTER (WHERE place = winner AND differs) AS n_needed FROM named GROUP BY place),
      out AS (SELECT CAST(r.place AS INTEGER) AS place, r.rule, r.label, coalesce(n_matched, 0) AS n_matched,
                     coalesce(n_decided, 0) AS n_decided, coalesce(n_needed, 0) AS n_needed, coalesce(hidden_by, '') AS hidden_by
              FROM rules r LEFT JOIN counts c ON c.place = r.place LEFT JOIN hidden h ON h.place = r.place)
    SELECT *, CASE WHEN n_matched = 0 THEN 'unmatched' WHEN n_decided = 0 THEN 'shadowed' WHEN n_needed = 0 THEN 'redundant'
                   ELSE 'needed' END AS state FROM out""")


ORACLE.update({
    "classify_by_rule_data": ORACLE["classify_outcomes"],
    "rule_coverage_d3": _coverage_sql(),
})
