"""Analysis reports: counts, shares, cumulative shares, cross-tabs, profiles, reshaping.

Every report aggregates first (partial aggregation before the shuffle). A grand
total is a scalar subquery, so the groups of a share are never gathered in one
task; the only window without a partition key (cumulative share) runs on the
values with more than one percent, which are at most 99.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """``COUNT(*)`` per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Counts of non-null values, largest first (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(col)))


def share_of_total(grouped: DataFrame, count_col: str = "n", name: str = "percent",
                   within: tuple[str, ...] = (), decimals: int = 2) -> DataFrame:
    """``ROUND(n * 100.0 / total, decimals)`` on grouped rows; the total is over all rows, or per ``within``."""
    total = F.sum(count_col).over(Window.partitionBy(*within)) if within else grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(name, F.round(F.col(count_col).cast("double") * F.lit(100.0)
                                            / total.cast("double"), decimals))


def distribution(df: DataFrame, key: str, count_name: str = "n", decimals: int = 2) -> DataFrame:
    """Count per value of ``key`` with its share of all rows, in percent."""
    return share_of_total(counts(df, key, name=count_name), count_name, decimals=decimals)


def cumulative_share(dist: DataFrame, key: str, percent_col: str = "percent", min_percent: float = 1.0,
                     name: str = "cumulative_percent", decimals: int = 2) -> DataFrame:
    """Keep values with share > ``min_percent``, then a running sum of shares, largest first.

    The filter comes before the running sum (WHERE before the window).
    """
    w = (Window.orderBy(F.desc(percent_col), F.asc(key))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (dist.filter(F.col(percent_col) > F.lit(min_percent))
            .withColumn(name, F.round(F.sum(percent_col).over(w), decimals)))


def top_k(df: DataFrame, key: str, k: int, count_name: str = "n") -> DataFrame:
    """The ``k`` most frequent values (ties by value); planned as TakeOrderedAndProject."""
    return counts(df, key, name=count_name).orderBy(F.desc(count_name), F.asc(key)).limit(k)


def count_nonnull_by(df: DataFrame, keys: list[str], col: str, name: str = "n") -> DataFrame:
    """``COUNT(col)`` per key combination (nulls of ``col`` not counted)."""
    return df.groupBy(*keys).agg(F.count(col).alias(name))


def conditional_counts(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One ``count_if`` per named condition, per key combination."""
    return df.groupBy(*keys).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n)
                                   for n, c in conditions.items()])


def column_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sums ignoring nulls (one row)."""
    return df.agg(*[F.sum(F.col("`" + c.replace("`", "``") + "`")).cast("long").alias(c) for c in cols])


def _profile_counts(df: DataFrame, key: str, col: str, missing: str) -> DataFrame:
    """(key, value, n) of the combinations that occur; blank and null values count under ``missing``."""
    label = F.coalesce(F.nullif(F.col(col).cast("string"), F.lit("")), F.lit(missing))
    return df.groupBy(key, label.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def profile_long(df: DataFrame, key: str, col: str, missing: str = "MISSING") -> DataFrame:
    """Category profile: (key, value, n) for every key and every value of ``col`` that occur, absent pairs 0.

    The rows are counted once per pair; every key then carries its counts as a map and is laid out over the list of
    the values found (a scalar, so a profile is for columns of categories). No value is left out; a null key is a key.
    """
    counted = _profile_counts(df, key, col, missing)
    values = counted.agg(F.sort_array(F.collect_set("value"))).scalar()
    keys = counted.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("_has"))
    laid = keys.select(key, "_has", F.explode(values).alias("value"))
    return laid.select(key, "value", F.coalesce(F.try_element_at("_has", F.col("value")), F.lit(0)).cast("long").alias("n"))


def profile_totals(df: DataFrame, col: str, missing: str = "MISSING") -> DataFrame:
    """(value, n): a profile's column totals."""
    label = F.coalesce(F.nullif(F.col(col).cast("string"), F.lit("")), F.lit(missing))
    return df.groupBy(label.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, key: str, col: str, missing: str = "MISSING") -> DataFrame:
    """Wide category profile: one row per ``key``, one count column per value of ``col`` that occurs, absent ones 0.

    More values than ``spark.sql.pivotMaxValues`` (10,000 by default) raise an error; none is left out.
    """
    wide = _profile_counts(df, key, col, missing).groupBy(key).pivot("value").agg(F.sum("n"))
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    return wide.select(key, *[F.coalesce(F.col(quoted(c)), F.lit(0)).alias(c) for c in wide.columns[1:]])


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "name",
            value: str = "value") -> DataFrame:
    """Wide -> long."""
    return df.unpivot(ids, values, name, value)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (no de-duplication)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def group_mean_having(df: DataFrame, key: str, col: str, min_count: int = 1,
                      decimals: int = 4) -> DataFrame:
    """Count and mean (nulls removed) per group, keeping groups with more than ``min_count`` rows."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(col), decimals).alias("mean_value"))
            .filter((F.col("n") > min_count) & F.col("mean_value").isNotNull()))


def crosstab_counts(df: DataFrame, row: str, col: str, name: str = "n") -> DataFrame:
    """Long-form contingency table (e.g. label x prediction)."""
    return counts(df, row, col, name=name)


def distinct_counts(df: DataFrame, cols: dict[str, str], rows_of: str | None = None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """``COUNT(col)`` and ``COUNT(DISTINCT col)`` in one pass (one row).

    ``approx`` uses HyperLogLog++ sketches (``approx_count_distinct``, relative
    error ``rsd``), which merge per task instead of shuffling every distinct value.
    """
    aggs = []
    if rows_of:
        aggs.append(F.count(rows_of).alias("n_rows"))
    for name, col in cols.items():
        aggs.append((F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)).alias(name))
    return df.agg(*aggs)
