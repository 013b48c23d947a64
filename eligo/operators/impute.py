"""Fill missing race / sex with the person's most frequent value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from eligo import constants as K
from eligo.operators.history import PERSON_KEYS
from eligo.operators.sampling import salted_join


def all_modes(source: DataFrame, cols=("race", "sex"), keys=PERSON_KEYS) -> DataFrame:
    """One row per person with ``_mode_<col>``: the most frequent non-null value, the smallest of equals.

    One aggregation; each task first counts a person's values on its own.
    """
    return source.groupBy(*keys).agg(*[F.mode(F.col(c).cast("string"), True).alias(f"_mode_{c}") for c in cols])


def impute_mode(rows: DataFrame, cols=("race", "sex"), keys=PERSON_KEYS, source: DataFrame | None = None) -> DataFrame:
    """Replace nulls of each column by the person's mode; 'MISSING' when the person has no value.

    ``source`` (default ``rows``) is where the modes are counted. Pass the cleaned charge rows when ``rows`` is an
    expensive derived result: it is then computed once and joined as a whole. Without ``source`` the rows that
    miss nothing pass by, and only the others are joined. The join spreads one person's rows over several parts.
    """
    modes = all_modes(rows if source is None else source, cols, keys)

    def filled(part: DataFrame) -> DataFrame:
        out = salted_join(part, modes, *keys, how="left", by="id")
        return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_mode_{c}"), F.lit(K.MISSING)) for c in cols}) \
            .drop(*[f"_mode_{c}" for c in cols])

    if source is not None:
        return filled(rows)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return rows.filter(~missing).unionByName(filled(rows.filter(missing)))
