"""Query-list filters: each query is a conjunction of IN-lists; an absent key means "any"."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eligo import constants as K
from eligo.operators.reports import union_all

FILTER_KEYS = ("code_section", "disposition_code", "charge_type")


def query_predicate(query: Mapping) -> Column:
    pred = F.lit(True)
    for key in FILTER_KEYS:
        if key in query:
            pred = pred & F.coalesce(F.col(key).isin(*query[key]), F.lit(False))
    return pred


def filter_on_query(df: DataFrame, query: Mapping, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows matching one query, tagged with its ``reference`` and ``title``."""
    out = df.filter(query_predicate(query)).withColumns({
        "reference": F.lit(query["reference"]), "title": F.lit(query["title"])})
    return out.select("reference", "title", *(keep or [c for c in df.columns]))


def apply_query_list(df: DataFrame, queries: Sequence[Mapping] = K.QUERY_LIST,
                     keep: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL of the per-query matches: a row matching two queries appears twice.

    One scan: each row gets the array of the queries it matches, and
    ``explode`` emits one copy per match (the UNION ALL multiplicity).
    """
    tags = F.array(*[F.when(query_predicate(q), F.struct(F.lit(q["reference"]).alias("reference"),
                                                           F.lit(q["title"]).alias("title")))
                     for q in queries])
    cols = list(keep or df.columns)
    return (df.select(*cols, F.explode(F.array_compact(tags)).alias("_q"))
            .select(F.col("_q.reference").alias("reference"), F.col("_q.title").alias("title"), *cols))


def apply_query_list_by_union(df: DataFrame, queries: Sequence[Mapping] = K.QUERY_LIST,
                              keep: Sequence[str] | None = None) -> DataFrame:
    """The same result as a literal UNION ALL of per-query filters (one scan per query)."""
    return union_all([filter_on_query(df, q, keep) for q in queries])


def match_count(queries: Sequence[Mapping] = K.QUERY_LIST) -> Column:
    """Number of queries a row matches (its multiplicity in the UNION ALL), without materialising the union."""
    return reduce_sum([F.when(query_predicate(q), F.lit(1)).otherwise(F.lit(0)) for q in queries])


def reduce_sum(cols: list[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def old_law(col: str = "disposition_code") -> Column:
    """Eligible under the old law: the disposition is one of the dismissal-like codes."""
    return F.coalesce(F.col(col).isin(*K.OLD_LAW_DISPOSITIONS), F.lit(False))


def law_totals(df: DataFrame, keys, queries: Sequence[Mapping] = K.QUERY_LIST) -> DataFrame:
    """Per key combination (e.g. source file and year): all rows, old-law rows, and new-law rows
    (query-list matches, counted with UNION ALL multiplicity), in one aggregation."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(old_law()).alias("old_law"),
                                 F.sum(match_count(queries)).cast("long").alias("new_law"))


def roll_up(totals: DataFrame, keys) -> DataFrame:
    """Sum per-file totals to coarser keys (e.g. per year)."""
    return totals.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in ("total", "old_law", "new_law")])
