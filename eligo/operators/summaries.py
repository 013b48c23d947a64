"""Summaries that merge: frequent values without an exchange of the vocabulary, and stored distinct sketches.

Both are built in the tasks, so what is exchanged does not grow with the number of different values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Registers of a distinct sketch: 2 ** 12 bytes each.
SKETCH_BITS = 12


def frequent_values(df: DataFrame, key: str, min_percent: float = 1.0, decimals: int = 2, name: str = "n") -> DataFrame:
    """(key, n, percent) of at least every value with a share above ``min_percent``, with exact counts; null is a value.

    First pass: ``freqItems`` keeps at most 100 / ``min_percent`` values a task and merges these; it may name too many
    values but misses none above that share. Second pass: the named values, and all others together as one, are
    counted exactly. Two scans, and two exchanges of some hundred rows a task, however many values there are.
    """
    if not 0.01 <= min_percent < 100:
        raise ValueError(f"min_percent is {min_percent}; it must be in [0.01, 100)")
    # Null needs no summary: it is always counted.
    named = df.select(F.col(key).alias("_v")).filter("_v IS NOT NULL").stat.freqItems(["_v"], min_percent / 100)
    value = F.col(key)
    candidate = value.isNull() | F.coalesce(F.array_contains(named.scalar(), value), F.lit(False))
    counted = (df.select(key, candidate.alias("_named")).groupBy(F.when(F.col("_named"), value).alias(key), "_named")
               .agg(F.count(F.lit(1)).alias(name)))
    # One window over all rows: at most 100 / min_percent values, null, and the others as one.
    total = F.sum(name).over(Window.partitionBy())
    percent = F.round(F.col(name).cast("double") * F.lit(100.0) / total.cast("double"), decimals)
    return counted.withColumn("percent", percent).filter("_named").select(key, name, "percent")


def distinct_sketches(df: DataFrame, keys: list[str], col: str, bits: int = SKETCH_BITS) -> DataFrame:
    """One sketch of the distinct non-null values of ``col`` per key combination, to be stored and merged.

    A sketch holds at most 2 ** ``bits`` bytes; a key combination that a third of all rows share is sketched in the
    tasks first. A key combination without any value has an empty sketch.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, bits).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Stored sketches merged upwards: one per combination of ``keys`` (none: one row), without reading the rows again."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """The stated relative error: three standard errors of merged sketches."""
    return 3 * 1.04 / 2 ** (bits / 2)


def compared(sketches: DataFrame, rows: DataFrame, key: str, col: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(level, key, n_distinct, within_error) per value of ``key`` (level 'key'; null is a value) and over all rows (level
    'all', key null): the exact count, and whether the estimate from the merged sketches is within the stated error.

    Exact counts and estimates meet in one aggregation by (level, key), without a join.
    """
    all_key = F.lit(None).cast(rows.schema[key].dataType).alias(key)
    none = F.lit(None).cast("long")

    def tagged(df: DataFrame, level: str, k: Column, exact: Column, estimate: Column) -> DataFrame:
        return df.select(F.lit(level).alias("level"), k, exact.alias("exact"), estimate.alias("estimate"))

    estimate = F.hll_sketch_estimate("sketch")
    frames = [tagged(rows.groupBy(key).agg(F.count_distinct(col).alias("d")), "key", F.col(key), F.col("d"), none),
              tagged(rows.agg(F.count_distinct(col).alias("d")), "all", all_key, F.col("d"), none),
              tagged(merged_sketches(sketches, [key]), "key", F.col(key), none, estimate),
              tagged(merged_sketches(sketches, []), "all", all_key, none, estimate)]
    both = frames[0].unionAll(frames[1]).unionAll(frames[2]).unionAll(frames[3])
    met = both.groupBy("level", key).agg(F.max("exact").alias("n_distinct"), F.max("estimate").alias("_e"))
    off = F.abs(F.coalesce("_e", F.lit(0)) - F.col("n_distinct"))
    return met.select("level", key, "n_distinct", (off <= F.lit(sketch_error(bits)) * F.col("n_distinct")).alias("within_error"))
