"""Text cleaning: race, fips, file-name year, blanks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eligo import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def standardize_race(col="race") -> Column:
    """Race standardisation on the upper-cased text; a later rule overrides an earlier one.

    Evaluated as one ``CASE`` in reverse rule order (first true branch = last
    matching rule). Text matching no rule stays as it was; null stays null.
    """
    upper = F.upper(_c(col))
    expr = None
    for pattern, label in reversed(K.RACE_RULES):
        cond = upper.rlike(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(_c(col))


def standardize_race_field(col="race") -> Column:
    """Exploratory form: upper-case, drop '(...)' lazily, strip whitespace, then a small recode."""
    cleaned = F.regexp_replace(F.regexp_replace(F.upper(_c(col)), r"\(.*?\)", ""), r"^\s+|\s+$", "")
    expr = None
    for raw, label in K.RACE_FIELD_MAP.items():
        expr = (F.when(cleaned == F.lit(raw), F.lit(label)) if expr is None
                else expr.when(cleaned == F.lit(raw), F.lit(label)))
    return expr.otherwise(cleaned)


def fix_fips(col="fips") -> Column:
    """Left-pad to 3 characters with '0'; longer codes are kept whole (plain lpad would truncate)."""
    c = _c(col)
    return F.when(F.length(c) < 3, F.lpad(c, 3, "0")).otherwise(c)


def year_from_file_name(col) -> Column:
    """'.../district_criminal_2019_anon_07.csv' -> '2019'."""
    return F.regexp_replace(F.regexp_replace(_c(col), r".+criminal_", ""), r"_anon.+$", "")


def is_missing(col) -> Column:
    """Null or empty string."""
    c = _c(col)
    return c.isNull() | (c == F.lit(""))


def first_comma_to_dots(col) -> Column:
    """Replace the first comma of a field by '..' (for comma-free CSV exports)."""
    return F.regexp_replace(_c(col), r"^([^,]*),", "$1..")
