"""Column-expression builders (all JVM-side; no Python UDFs)."""

from eligo.functions.categories import (  # noqa: F401
    charge_category, code_section_category, disposition_category, is_conviction, is_felony_conviction,
    old_expungable,
)
from eligo.functions.dates import day_number, from_day_number, gap_flag  # noqa: F401
from eligo.functions.text import (  # noqa: F401
    fix_fips, standardize_race, standardize_race_field, year_from_file_name,
)
