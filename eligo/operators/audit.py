"""Key audit of charges and a run's results: duplicate ids, orphans and missing results in one exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# What the audit looks for, in report order.
PROBLEMS = ("charge without id", "duplicate charge id", "duplicate feature", "duplicate outcome", "feature without charge",
            "outcome without charge", "feature without outcome", "outcome without feature", "charge without outcome")


def _tagged(charges: DataFrame, features: DataFrame | None, outcomes: DataFrame | None) -> DataFrame:
    """(charge_id, tag): the key of every row of the tables, and which table it is from."""
    frames = [charges.select(F.col("id").alias("charge_id"), F.lit("c").alias("tag"))]
    for df, tag in ((features, "f"), (outcomes, "o")):
        if df is not None:
            frames.append(df.select("charge_id", F.lit(tag).alias("tag")))
    return reduce(DataFrame.unionAll, frames)


def key_counts(charges: DataFrame, features: DataFrame | None = None, outcomes: DataFrame | None = None) -> DataFrame:
    """(charge_id, c, f, o): how many rows each table has of every charge id.

    One union grouped by key, without joins: counts are combined in the map tasks, so an id that a third of all
    rows share arrives once per task, and only ids and three counts are exchanged.
    """
    of = lambda tag: F.count_if(F.col("tag") == tag).alias(tag)
    return _tagged(charges, features, outcomes).groupBy("charge_id").agg(of("c"), of("f"), of("o"))


def _found(with_features: bool) -> dict[str, Column]:
    c, f, o = F.col("c"), F.col("f"), F.col("o")
    known = F.col("charge_id").isNotNull()
    pair = F.lit(with_features)
    return {
        "charge without id": ~known & (c > 0), "duplicate charge id": known & (c > 1), "duplicate feature": known & (f > 1),
        "duplicate outcome": known & (o > 1), "feature without charge": (f > 0) & (~known | (c == 0)),
        "outcome without charge": (o > 0) & (~known | (c == 0)), "feature without outcome": (f > 0) & (o == 0),
        "outcome without feature": pair & (o > 0) & (f == 0), "charge without outcome": known & (c > 0) & (o == 0)}


def key_audit(charges: DataFrame, features: DataFrame | None = None, outcomes: DataFrame | None = None) -> DataFrame:
    """(problem, n_ids, n_rows, first_id) of every problem, zeros included: ids concerned, their rows, the smallest id.

    A null id is one key. 'charge without outcome' also counts the charges that a run leaves out (its drop counts
    say why). Without ``outcomes`` nothing is said about them, and likewise about features.
    """
    checks = _found(features is not None)
    if outcomes is None:
        checks = {k: v for k, v in checks.items() if "outcome" not in k}
    checks = {k: v for k, v in checks.items() if features is not None or "feature" not in k}
    rows = F.col("c") + F.col("f") + F.col("o")
    hits = F.explode(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()])))
    found = (key_counts(charges, features, outcomes).select("charge_id", rows.alias("n"), hits.alias("problem"))
             .groupBy("problem").agg(F.count(F.lit(1)).alias("n_ids"), F.sum("n").alias("n_rows"), F.min("charge_id").alias("first_id")))
    spark = charges.sparkSession
    listed = spark.createDataFrame([(k,) for k in PROBLEMS if k in checks], "problem string")
    return listed.join(found, "problem", "left").select(
        "problem", F.coalesce("n_ids", F.lit(0)).cast("long").alias("n_ids"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "first_id")


def orphan_runs(results: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, n): rows of a result table under run ids that have no record."""
    return results.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).join(runs.select(F.col("id").alias("run_id")), "run_id", "left_anti")


class DuplicateKeys(ValueError):
    pass


def refuse_duplicate_ids(charges: DataFrame) -> None:
    """Raise if two charges share an id or one has none; one aggregation of the ids."""
    bad = {r["problem"]: r for r in key_audit(charges).collect() if r["n_ids"]}
    if bad:
        raise DuplicateKeys("; ".join(f"{r['n_ids']} x {p} ({r['n_rows']} rows, first id {r['first_id']})" for p, r in sorted(bad.items())))
