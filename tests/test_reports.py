"""Report operators: shares, cumulative shares, profiles, unions, top-k, samples."""

from pyspark.sql import functions as F

from eligo.operators import reports as RP
from eligo.operators.querylist import apply_query_list, match_count
from eligo.operators.sampling import sample_ids, unprocessed
from tests.helpers import charge, frame


def test_cumulative_share_filters_before_running_sum(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [("c",)] * 19 + [("d",)], "k string")
    out = RP.cumulative_share(RP.distribution(df, "k"), "k").orderBy(F.desc("percent")).collect()
    assert [(r["k"], r["percent"], r["cumulative_percent"]) for r in out] == [
        ("a", 50.0, 50.0), ("b", 30.0, 80.0), ("c", 19.0, 99.0)]


def test_profile_counts_every_value_that_occurs(spark):
    rows = [("f1", "Guilty"), ("f1", ""), ("f2", None), ("f2", "Guilty"), ("f2", "Un.listed `x`"), ("f1", "[a]")]
    out = RP.profile(spark.createDataFrame(rows, "file string, d string"), "file", "d")
    got = {r["file"]: r.asDict() for r in out.collect()}
    assert set(out.columns) == {"file", "Guilty", "MISSING", "Un.listed `x`", "[a]"}
    assert got["f1"] == {"file": "f1", "Guilty": 1, "MISSING": 1, "Un.listed `x`": 0, "[a]": 1}
    sums = RP.column_sums(out, out.columns[1:]).first()
    assert sum(sums) == len(rows)


def test_long_profile_has_every_pair(spark):
    rows = [("f1", "Guilty"), ("f1", ""), ("f2", None), (None, "Guilty"), ("f2", "x`y")]
    df = spark.createDataFrame(rows, "file string, d string")
    got = {(r.file, r.value): r.n for r in RP.profile_long(df, "file", "d").collect()}
    want = {(k, v): 0 for k in ("f1", "f2", None) for v in ("Guilty", "MISSING", "x`y")}
    for k, v in rows:
        want[k, v or "MISSING"] += 1
    assert got == want
    assert {tuple(r) for r in RP.profile_totals(df, "d").collect()} == {("Guilty", 2), ("MISSING", 2), ("x`y", 1)}
    assert RP.profile_long(df.limit(0), "file", "d").count() == 0


def test_share_needs_no_single_task(spark):
    grouped = RP.counts(spark.range(1000).selectExpr("id % 300 AS k"), "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = RP.share_of_total(grouped)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" not in plan.toString()


def test_query_list_counts_duplicates(spark):
    # 18.2-250.1 + Guilty + Misdemeanor matches the B-misdemeanor query only; 4.1-305 Guilty matches B.
    rows = [charge(1, 1, "2015-01-01", code="4.1-305", disp="Guilty"),
            charge(2, 1, "2015-01-01", code="18.2-250.1", disp="Dismissed"),
            charge(3, 1, "2015-01-01", code="18.2-266", disp="Dismissed")]
    df = frame(spark, rows)
    union = apply_query_list(df, keep=["id"]).collect()
    assert sorted((r["id"], r["reference"]) for r in union) == [
        (1, "19.2-392.6.B"), (2, "19.2-392.6.A"), (3, "19.2-392.12")]
    weights = {r["id"]: r["w"] for r in df.select("id", match_count().alias("w")).collect()}
    assert weights == {1: 1, 2: 1, 3: 1}


def test_top_k_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [r["k"] for r in RP.top_k(df, "k", 2).collect()] == ["c", "a"]


def test_sample_is_deterministic_across_partitionings(spark):
    df = spark.range(500).withColumnRenamed("id", "person_id")
    a = {r[0] for r in sample_ids(df, 20).collect()}
    b = {r[0] for r in sample_ids(df.repartition(7), 20).collect()}
    assert a == b and len(a) == 20


def test_unprocessed_anti_join(spark):
    work = frame(spark, [charge(1, 1, "2015-01-01"), charge(2, 2, "2015-01-01")])
    done = spark.createDataFrame([(1,)], "person_id long")
    assert [r["id"] for r in unprocessed(work, done).collect()] == [2]


def test_query_list_single_pass_equals_union(spark):
    from eligo.operators.querylist import apply_query_list_by_union
    from eligo.sources.fixtures import load_charges
    df = load_charges(spark, "/root/testdata/sf0.001")
    keep = ["id", "code_section", "disposition_code"]
    a = sorted(tuple(r) for r in apply_query_list(df, keep=keep).collect())
    b = sorted(tuple(r) for r in apply_query_list_by_union(df, keep=keep).collect())
    assert a == b and len(a) > 0


def test_distinct_counts_exact_and_approx(spark):
    df = spark.range(2000).selectExpr("id % 500 AS p", "cast(id % 7 AS string) AS c")
    exact = RP.distinct_counts(df, {"n_p": "p", "n_c": "c"}, rows_of="p").first()
    assert (exact["n_rows"], exact["n_p"], exact["n_c"]) == (2000, 500, 7)
    approx = RP.distinct_counts(df, {"n_p": "p"}, approx=True, rsd=0.02).first()
    assert abs(approx["n_p"] - 500) <= 30


def test_law_totals_per_file_roll_up(spark):
    from eligo.operators.querylist import law_totals, roll_up
    rows = [charge(1, 1, "2015-01-01", code="4.1-305", disp="Dismissed"),
            charge(2, 1, "2015-02-01", code="18.2-250.1", disp="Dismissed"),
            charge(3, 2, "2015-03-01", code="18.2-95", disp="Guilty")]
    df = frame(spark, rows).withColumn("file", F.when(F.col("id") == 3, "b").otherwise("a")) \
        .withColumn("year", F.year("hearing_date"))
    per_file = {r["file"]: (r["total"], r["old_law"], r["new_law"]) for r in law_totals(df, ["file", "year"]).collect()}
    assert per_file == {"a": (2, 2, 2), "b": (1, 0, 0)}
    assert [tuple(r) for r in roll_up(law_totals(df, ["file", "year"]), ["year"]).collect()] == [(2015, 3, 2, 2)]


def test_mass_index_and_group_mean_having(spark):
    from eligo.functions.numeric import mass_index
    df = spark.createDataFrame([("a", 80.0, 200.0), ("a", None, 180.0), ("b", 50.0, 0.0), ("a", 45.0, 150.0)],
                               "g string, mass double, height double").withColumn("mi", mass_index("mass", "height"))
    vals = [r["mi"] for r in df.collect()]
    assert vals[0] == 20.0 and vals[1] is None and vals[2] is None and vals[3] == 20.0
    out = {r["g"]: (r["n"], r["mean_value"]) for r in RP.group_mean_having(df, "g", "mi", min_count=1).collect()}
    assert out == {"a": (3, 20.0)}


def test_sample_is_the_first_n_in_md5_order(spark):
    import hashlib
    df = spark.range(20000).withColumnRenamed("id", "person_id").repartition(9)
    order = sorted(range(20000), key=lambda i: hashlib.md5(f"{i}:12345".encode()).hexdigest())
    for n in (1, 3000, 20000, 30000):
        assert sorted(r[0] for r in sample_ids(df, n).collect()) == sorted(order[:n])


def _most_rows_in_a_task(spark, df):
    """Rows of the fullest partition of the result, with joins neither broadcast nor coalesced."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return max(r["n"] for r in df().groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_persons_rows_are_spread(spark):
    """A third of the rows belong to one person; no task of the joins gets them all."""
    from eligo.operators.impute import impute_mode
    rows = spark.range(30000).selectExpr("id", "IF(id % 3 = 0, 7L, id) AS person_id", "CAST(IF(id % 5 = 0, 'b', NULL) AS STRING) AS race",
                                         "'M' AS sex", "CAST(IF(id % 3 = 0, 7L, id) AS LONG) AS _pid", "false AS _pnull")
    done = spark.range(1, 30000, 2).withColumnRenamed("id", "person_id").filter("person_id <> 7")
    assert _most_rows_in_a_task(spark, lambda: unprocessed(rows, done)) < 5000
    assert _most_rows_in_a_task(spark, lambda: impute_mode(rows)) < 6000
    out = impute_mode(rows).groupBy("race").count().collect()
    assert {r["race"] for r in out} == {"b", "MISSING"} and sum(r["count"] for r in out) == 30000
    assert unprocessed(rows, done).filter("person_id = 7").count() == 10001
