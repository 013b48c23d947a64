"""Reject table: the lines of court files that are no charges, beside the charges under the root.

The lines are parsed once and written once, charges and rejects apart, to a staging folder; the charges then go
through ingestion and its load ledger, and the rejects into ``rejects``, one folder per file name. A file's rejects
replace those that an earlier load of the same file left, so loading it twice, or again after a cut, doubles none.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.sinks import ledger, tables as sinks
from eligo.sources.courts import files_of, with_charge_ids
from eligo.sources.rejects import charge_rows, read_court_lines, rejected_lines

REJECTS = "source_file string, line string, reason string, file string"


class CourtLoad(NamedTuple):
    load: ledger.Load | None
    rejects: DataFrame


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, line, reason, file) of all files loaded."""
    if not sinks.exists(spark, f"{root}/rejects"):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(f"{root}/rejects")


def _write(rejects: DataFrame, root: str, clear_existing: bool) -> None:
    rows = rejects.withColumn("file", ledger.file_name()).hint("rebalance", "file")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if clear_existing else "dynamic").partitionBy(
        "file").parquet(f"{root}/rejects")


def load_court_files(spark: SparkSession, paths, root: str, as_of: str | None = None, clear_existing: bool = True,
                     buckets: int | None = None) -> CourtLoad:
    """Court files into the charges and the reject table; what was loaded, and the rejects of these files."""
    from eligo.plans.run import run_ingestion
    staged = f"{root}/_staging/lines-{uuid.uuid4().hex}"
    lines = read_court_lines(spark, paths)
    parted = lines.withColumn("rejected", F.col("reason").isNotNull().cast("int"))
    parted.write.partitionBy("rejected").parquet(staged)
    try:
        kept = spark.read.schema(parted.schema).parquet(staged)
        good, bad = (kept.filter(F.col("rejected") == n).select(*lines.columns) for n in (0, 1))
        load = run_ingestion(with_charge_ids(charge_rows(good)), root, as_of, clear_existing, buckets)
        _write(rejected_lines(bad), root, clear_existing)
    finally:
        sinks.delete(spark, staged)
    names = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in files_of(spark, paths)], "file string")
    return CourtLoad(load, read_rejects(spark, root).join(names, "file", "left_semi"))
