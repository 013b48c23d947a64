"""Category columns: disposition, charge and code-section categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eligo import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def disposition_category(disposition_code="disposition_code", plea="plea") -> Column:
    """Disposition code -> Conviction / Dismissed / Deferral Dismissal.

    Unmapped codes pass through unchanged. A dismissal after an Alford,
    Guilty or Nolo Contendere plea is a deferral dismissal; a null plea
    changes nothing.
    """
    code = _c(disposition_code)
    base = _mapped(code)
    deferral = _c(plea).isin(*K.DEFERRAL_PLEAS) & (base == F.lit(K.DISMISSED))
    return F.when(deferral, F.lit(K.DEFERRAL)).otherwise(base)


def _mapped(code: Column) -> Column:
    expr = None
    for raw, category in K.DISPOSITION_CATEGORY_MAP.items():
        expr = (F.when(code == F.lit(raw), F.lit(category)) if expr is None
                else expr.when(code == F.lit(raw), F.lit(category)))
    return expr.otherwise(code)


def charge_category(charge_type="charge_type") -> Column:
    """Charge category is the charge type itself."""
    return _c(charge_type)


def code_section_category(code_section="code_section", disposition_cat="disposition_category",
                          charge_cat="charge_category", *, sections_a=K.COVERED_SECTIONS_A,
                          sections_b=K.COVERED_SECTIONS_B,
                          sections_b_misdemeanor=K.COVERED_SECTIONS_B_MISDEMEANOR,
                          sections_twelve=K.EXCLUDED_SECTIONS_TWELVE, twelve_first: bool = False,
                          twelve_label: str = K.CS_12) -> Column:
    """Code-section category, first match wins.

    Canonical order: A-list with a deferral -> A; B-list, or B-misdemeanor
    list for a misdemeanor -> B; 12-list -> excluded; else covered elsewhere.
    ``twelve_first`` gives the older order, where the 12-list overrides all.
    A null code section counts as 'MISSING' and so falls to 'covered elsewhere'.
    """
    cs = F.coalesce(_c(code_section), F.lit(K.MISSING))
    is_a = cs.isin(*sections_a) & (_c(disposition_cat) == F.lit(K.DEFERRAL))
    is_b = cs.isin(*sections_b) | (cs.isin(*sections_b_misdemeanor) & (_c(charge_cat) == F.lit(K.MISDEMEANOR)))
    is_12 = cs.isin(*sections_twelve)
    if twelve_first:
        return (F.when(is_12, F.lit(twelve_label)).when(is_a, F.lit(K.CS_A)).when(is_b, F.lit(K.CS_B))
                .otherwise(F.lit(K.CS_ELSEWHERE)))
    return (F.when(is_a, F.lit(K.CS_A)).when(is_b, F.lit(K.CS_B)).when(is_12, F.lit(twelve_label))
            .otherwise(F.lit(K.CS_ELSEWHERE)))


def is_conviction(disposition_cat="disposition_category") -> Column:
    return F.coalesce(_c(disposition_cat) == F.lit(K.CONVICTION), F.lit(False))


def is_felony_conviction(disposition_cat="disposition_category", charge_cat="charge_category") -> Column:
    return is_conviction(disposition_cat) & F.coalesce(_c(charge_cat) == F.lit(K.FELONY), F.lit(False))


def old_expungable(disposition_cat="disposition_category") -> Column:
    """Older rule: eligible under the old law when the disposition category is Dismissed."""
    return F.coalesce(_c(disposition_cat) == F.lit(K.DISMISSED), F.lit(False))
