"""Charges clustered by person, with a Parquet Bloom filter on the person id.

The rows are range-partitioned by (person, charge id) and sorted so within each file: a row group spans few persons, and
the ids within its span that it does not hold are told by its Bloom filter. A lookup of one person, or of a listed
sample, then skips nearly all row groups. A person with a third of all rows, and the rows without a person, spread over
several files by charge id; several equal rows stay together.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.operators.sampling import sample_ids

# Ids that travel as a filter. Beyond, rows and ids meet in a join (operators.sampling.salted_join).
MAX_LISTED = 1_000
# Spark hands a list of at most this many values to Parquet value by value, a longer one as its span only.
PER_FILTER = 10

BLOOM = {"parquet.bloom.filter.enabled#person_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def by_person(charges: DataFrame, files: int) -> DataFrame:
    """The rows in ``files`` ranges of (person, id), sorted within each; rows without a person come first."""
    if files < 1:
        raise ValueError("at least one file is needed")
    return charges.repartitionByRange(files, "person_id", "id").sortWithinPartitions("person_id", "id")


def write_clustered(charges: DataFrame, path: str, files: int, mode: str = "overwrite") -> None:
    """``files``: about the table's bytes divided by 1 GB. One exchange of the rows, and a sample of their keys."""
    by_person(charges, files).write.mode(mode).options(**BLOOM).parquet(path)


def listed_persons(ids: Iterable[int | None]) -> Column:
    """Is the row of one of these persons (None: of no person)? Neighbouring ids share a filter that Parquet can test."""
    ids = list(ids)
    if len(ids) > MAX_LISTED:
        raise ValueError(f"{len(ids)} ids: a filter takes {MAX_LISTED}; join larger lists (sampling.salted_join)")
    found = sorted({i for i in ids if i is not None})
    parts = [F.col("person_id").isin(*found[i:i + PER_FILTER]) for i in range(0, len(found), PER_FILTER)]
    if None in ids:
        parts.append(F.col("person_id").isNull())
    return functools.reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)


def charges_of(spark: SparkSession, path: str, *persons: int | None) -> DataFrame:
    """All charges of the persons given (an id that does not occur has none)."""
    return spark.read.parquet(path).filter(listed_persons(persons))


def sampled_charges(spark: SparkSession, path: str, n: int, seed: int = 12345) -> DataFrame:
    """All rows of ``n`` (at most 1,000) sampled persons: those of ``sampling.sample_rows``, without its join.

    Only the person ids are read to draw the sample; its ids pass the driver as the filter of the second scan.
    """
    if n > MAX_LISTED:
        raise ValueError(f"a listed sample has at most {MAX_LISTED} persons; use sampling.sample_rows")
    drawn = sample_ids(spark.read.parquet(path), n, seed).collect()
    return charges_of(spark, path, *[r["person_id"] for r in drawn])
