"""Person samples, sample joins and incremental (anti-join) selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Parts that one person's rows are spread over in a join with one row per person.
SALTS = 8


def sample_key(key: str = "person_id", seed: int = 12345) -> Column:
    """Deterministic pseudo-random order of ids: md5 of 'id:seed' (the same in any engine or partitioning)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def sample_ids(df: DataFrame, n: int, seed: int = 12345, key: str = "person_id") -> DataFrame:
    """Exactly ``n`` distinct non-null ids (or all, if fewer), without replacement: the first ``n`` in md5 order.

    The ids fall into 4,096 buckets by the first three digits of their order key. The buckets' sizes (at most
    4,096 rows) say how many ids lie before each, and ids are ranked within their bucket only, so no task merges
    the sample, whatever its size. Nothing runs until the result is used.
    """
    order = sample_key(key, seed)
    ids = df.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_order", order)
    ids = ids.withColumn("_bucket", F.substring("_order", 1, 3))
    sizes = ids.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size"))
    needed = sizes.filter(F.col("_before") < n).select("_bucket", "_before")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", key))
    return (ids.join(F.broadcast(needed), "_bucket").withColumn("_rank", rank)
            .filter(F.col("_before") + F.col("_rank") <= n).select(key))


def sample_rows(df: DataFrame, n: int, seed: int = 12345, key: str = "person_id") -> DataFrame:
    """All rows of ``n`` sampled persons."""
    return salted_join(df, sample_ids(df, n, seed, key), key)


def salted_join(rows: DataFrame, ids: DataFrame, *keys: str, how: str = "inner", by: str | None = None) -> DataFrame:
    """Join ``rows`` with a side that has one row per key, null-safe, one key's rows spread over SALTS parts.

    The small side is repeated once per part. ``by`` (default: all columns) tells the rows of a key apart.
    """
    part = F.pmod(F.xxhash64(*([by] if by else rows.columns)), F.lit(SALTS)).cast("int")
    left = rows.withColumn("_part", part)
    right = ids.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    right = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [F.col("_part") == F.col("_of"), *[F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]]
    return left.join(right, on, how).drop("_part", "_of", *[f"_key_{k}" for k in keys])


def unprocessed(work: DataFrame, done: DataFrame, key: str = "person_id") -> DataFrame:
    """Rows of ``work`` whose key has no entry in ``done``: the open ids by an anti join, then their rows."""
    left = work.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")
    return salted_join(work, left, key)


def peek(df: DataFrame, n: int = 5, order: str = "id") -> DataFrame:
    """First ``n`` rows by a key (a deterministic LIMIT)."""
    return df.orderBy(order).limit(n)
