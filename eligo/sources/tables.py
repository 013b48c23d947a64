"""Table sources: charges scans, lookups, id lists and an optional JDBC reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.config import RunConfig


def read_charges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fetch_charges(spark: SparkSession, path: str, cfg: RunConfig) -> DataFrame:
    """Charges heard strictly before the cutoff; the filter reaches the Parquet scan.

    No global sort: every window of the pipeline orders its own partition.
    """
    return read_charges(spark, path).filter(F.col("hearing_date") < F.lit(cfg.cutoff_date).cast("date"))


def read_charges_jdbc(spark: SparkSession, url: str, table: str, num_partitions: int, lower: int, upper: int,
                      partition_column: str = "id", properties: dict | None = None) -> DataFrame:
    """Parallel JDBC scan split into ranges of ``partition_column`` (one connection per task)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})
