"""Frequent values and distinct sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from eligo.operators import summaries as S
from eligo.operators.reports import cumulative_share, distribution


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("n", [0, 1, 1000, 2_000_000])
def test_frequent_values_equal_the_full_count(spark, n):
    """Mostly different values; a few with shares on both sides of one percent; nulls; empty texts."""
    u = F.pmod(F.xxhash64("id"), F.lit(1000))
    df = spark.range(0, n, 1, 8).select(
        F.when(u < 300, "hot").when(u < 311, "just above").when(u < 320, "just below").when(u < 340, F.lit(None))
        .when(u < 360, "").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v"))
    got = S.frequent_values(df, "v")
    exact = distribution(df, "v")
    assert rows(cumulative_share(got, "v")) == rows(cumulative_share(exact, "v"))
    counts = {r["v"]: r["n"] for r in exact.collect()} if n <= 1000 else None
    if counts is not None:  # whatever else is named has its exact count, too
        assert all(counts[r["v"]] == r["n"] for r in got.collect())


def test_the_vocabulary_is_not_exchanged(spark):
    """At most some hundred rows a task leave the partial aggregation, with 10 million different values."""
    df = spark.range(0, 10_000_000, 1, 8).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    got = S.frequent_values(df, "v").collect()
    assert {r["v"]: (r["n"], r["percent"]) for r in got}["hot"] == (2_500_000, 25.0)
    assert len(got) <= 101  # 100 named values and null


def test_a_share_that_needs_too_many_counters_is_refused(spark):
    with pytest.raises(ValueError):
        S.frequent_values(spark.range(3), "id", min_percent=0)


def test_stored_sketches_merge_upwards(spark, tmp_path):
    """Two loads, each sketched and stored on its own, one with a hot group; merged without reading rows again."""
    loads = [spark.range(a, b).select((F.col("id") % 70_001).alias("p"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("c"), F.col("id") % 5)).alias("loc"), (F.col("id") % 4).cast("int").alias("year")) for a, b in ((0, 100_000), (50_000, 200_000))]
    for df in loads:
        S.distinct_sketches(df, ["loc", "year"], "p").write.mode("append").parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    got = S.compared(stored, loads[0].unionAll(loads[1]), "year", "p").collect()
    assert {(r["level"], r["year"]) for r in got} == {("all", None), *(("key", y) for y in range(4))}
    assert all(r["within_error"] for r in got) and {r["n_distinct"] for r in got if r["level"] == "all"} == {70_001}
    # A sketch of other rows is found out.
    wrong = S.distinct_sketches(loads[0].filter("p < 1000"), ["loc", "year"], "p")
    assert not any(r["within_error"] for r in S.compared(wrong, loads[0], "year", "p").collect())


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, None)], "p long, year int")
    got = {(r["level"], r["year"]): (r["n_distinct"], r["within_error"]) for r in
           S.compared(S.distinct_sketches(df, ["year"], "p"), df, "year", "p").collect()}
    assert got == {("key", 1): (0, True), ("key", None): (0, True), ("all", None): (0, True)}
    none = df.limit(0)
    assert [(r["level"], r["n_distinct"], r["within_error"]) for r in
            S.compared(S.distinct_sketches(none, ["year"], "p"), none, "year", "p").collect()] == [("all", 0, True)]
