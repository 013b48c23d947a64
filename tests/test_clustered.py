"""Person-clustered charges: the same rows, few of them read, hot persons spread."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eligo.operators.sampling import sample_rows
from eligo.sinks import clustered
from eligo.sources.fixtures import load_charges
from tests.conftest import SF_MID


def rows_read(df) -> int:
    """Rows that the scan put out when ``df`` ran, before any filter of Spark's."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "charges")
    clustered.write_clustered(load_charges(spark, SF_MID), path, 16)
    return path


def test_lookup_reads_few_rows(spark, stored):
    charges = load_charges(spark, SF_MID)
    total = charges.count()
    for person in (1, 700):
        one = clustered.charges_of(spark, stored, person)
        assert listed(one) == listed(charges.filter(F.col("person_id") == person))
        assert 0 < rows_read(one) <= total / 8


def test_absent_person_is_told_by_the_bloom_filter(spark, tmp_path):
    """Only even ids are stored, so an odd one lies within the span of a file but not in it: nothing is read."""
    path = str(tmp_path / "even")
    rows = load_charges(spark, SF_MID).withColumn("person_id", F.col("person_id") * 2)
    clustered.write_clustered(rows, path, 16)
    absent = [clustered.charges_of(spark, path, person) for person in range(101, 141, 2)]
    assert all(df.collect() == [] for df in absent)
    # The filter may err for an id now and then.
    assert sum(rows_read(df) > 0 for df in absent) <= 4
    names = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(names) == 16


def test_sample_equals_the_join(spark, stored):
    charges = load_charges(spark, SF_MID)
    few = clustered.sampled_charges(spark, stored, 3)
    assert listed(few) == listed(sample_rows(charges, 3))
    assert rows_read(few) <= charges.count() / 4
    many = clustered.sampled_charges(spark, stored, 300)
    assert listed(many) == listed(sample_rows(charges, 300))


def test_listed_persons(spark, stored):
    charges = load_charges(spark, SF_MID)
    ids = [1, 2, 2, *range(40, 80), 10**12]
    assert listed(clustered.charges_of(spark, stored, *ids)) == listed(charges.filter(F.col("person_id").isin(ids)))
    assert clustered.charges_of(spark, stored).count() == 0
    with pytest.raises(ValueError):
        clustered.listed_persons(range(clustered.MAX_LISTED + 1))
    with pytest.raises(ValueError):
        clustered.sampled_charges(spark, stored, clustered.MAX_LISTED + 1)
    with pytest.raises(ValueError):
        clustered.by_person(charges, 0)


def test_hot_and_missing_persons_spread_over_files(spark, tmp_path):
    """A third of the rows of one person, a third of none: no file holds much more than its share."""
    path = str(tmp_path / "hot")
    hot = F.when(F.col("id") % 3 == 0, F.lit(77)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("person_id"))
    rows = load_charges(spark, SF_MID).withColumn("person_id", hot.cast("long"))
    total = rows.count()
    clustered.write_clustered(rows, path, 12)
    sizes = [pq.ParquetFile(f"{path}/{f}").metadata.num_rows for f in os.listdir(path) if f.endswith(".parquet")]
    assert sum(sizes) == total and max(sizes) < 2 * total / 12
    for person in (77, None):
        test = F.col("person_id").eqNullSafe(F.lit(person))
        one = clustered.charges_of(spark, path, person)
        assert listed(one) == listed(rows.filter(test))
        assert rows_read(one) < total / 2


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    clustered.write_clustered(load_charges(spark, SF_MID).filter(F.lit(False)), path, 4)
    assert clustered.charges_of(spark, path, 1, None).count() == 0
    assert clustered.sampled_charges(spark, path, 5).count() == 0


def test_ingested_table_is_clustered(spark, tmp_path):
    from eligo.operators.clean import to_raw_layout
    from eligo.plans.run import run_ingestion
    root = str(tmp_path)
    run_ingestion(to_raw_layout(load_charges(spark, SF_MID)), root, as_of="2030-01-01", person_files=16)
    whole = spark.read.parquet(f"{root}/charges")
    one = clustered.charges_of(spark, f"{root}/charges", 5)
    assert listed(one) == listed(whole.filter("person_id = 5")) and 0 < rows_read(one) <= whole.count() / 8
    with pytest.raises(ValueError):
        run_ingestion(to_raw_layout(load_charges(spark, SF_MID)), root, as_of="2030-01-01", buckets=4, person_files=4)
