"""Writers for charges, runs, features and outcomes.

A run's features, outcomes and drop counts are written under a fresh attempt folder
(``outcomes/run_id=<id>/attempt=<name>``). Run records are only ever added; the last one of a completed run, written
after its tables, names the attempt, and readers find the tables through it. So a repeated run id replaces exactly
that run in one step: until the new record is there, also when a run fails between any two writes, readers get
the whole earlier run. Attempts that no reader can have found any more are removed afterwards. Every write is a Spark job whose
tasks commit atomically, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eligo.config import RunConfig
from eligo.schemas import CHARGES, DROPPED, FEATURES, OUTCOMES, RUNS
from eligo.sinks import clustered

# Run-partitioned tables and their partition column.
RESULT_TABLES = {"runs": (RUNS, "id"), "features": (FEATURES, "run_id"), "outcomes": (OUTCOMES, "run_id"),
                 "dropped": (DROPPED, "run_id")}


# A stored record: the run's row, its place among the run's records, and the attempt that holds the run's tables.
RECORDS = T.StructType([*RUNS.fields, T.StructField("version", T.LongType()), T.StructField("attempt", T.StringType())])


def attempt_path(root: str, table: str, run_id: str, attempt: str) -> str:
    return f"{root}/{table}/run_id={run_id}/attempt={attempt}"


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables with the declared schemas (no-op for tables that exist)."""
    spark.createDataFrame([], CHARGES).write.mode("ignore").parquet(f"{root}/charges")
    for name, (schema, key) in RESULT_TABLES.items():
        spark.createDataFrame([], RECORDS if name == "runs" else schema).write.mode("ignore").partitionBy(key).parquet(f"{root}/{name}")


def path_of(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = path_of(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = path_of(spark, path)
    fs.delete(p, True)


def person_bucket(n: int) -> "F.Column":
    """Hash bucket of the person (a charge without a person id is its own person)."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("person_id"), -F.col("id") - 1)), F.lit(n)).cast("int")


def bucket_layout(spark: SparkSession, root: str) -> int | None:
    """Person buckets that the charges table is partitioned by (None: not at all)."""
    if not exists(spark, f"{root}/charges_layout"):
        return None
    return spark.read.parquet(f"{root}/charges_layout").first()["buckets"]


def write_charges(charges: DataFrame, root: str, clear_existing: bool = True, buckets: int | None = None,
                  person_files: int | None = None) -> None:
    """Load cleaned charges. A full refresh (default) also clears runs, features, outcomes and drop counts.

    With ``buckets``, the table is partitioned by ``person_bucket`` so a classification can read one bucket of
    persons by partition pruning; the number is stored beside the table, and an append must keep it. A refresh
    overwrites whole tables, whatever the session's overwrite mode: a dynamic overwrite would keep the
    partitions that the new load does not touch. With ``person_files``, the load is stored in so many files by ranges of
    persons with a Bloom filter on their ids (``sinks.clustered``); buckets and ranges exclude each other.
    """
    if buckets and person_files:
        raise ValueError("charges are stored by buckets or by ranges of persons, not both")
    spark = charges.sparkSession
    if clear_existing:
        for name, (schema, key) in RESULT_TABLES.items():  # the records first: without them nothing is read
            (spark.createDataFrame([], RECORDS if name == "runs" else schema).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(key).parquet(f"{root}/{name}"))
        (spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite")
         .parquet(f"{root}/charges_layout"))
    elif exists(spark, f"{root}/charges") and (now := bucket_layout(spark, root)) != buckets:
        raise ValueError(f"{root}/charges has {now or 'no'} person buckets; an append with {buckets or 'none'} would mix layouts")
    writer = charges if not buckets else charges.withColumn("person_bucket", person_bucket(buckets))
    if person_files:
        writer = clustered.by_person(charges, person_files)
    writer = writer.write.options(**(clustered.BLOOM if person_files else {})).mode("overwrite" if clear_existing else "append").option("partitionOverwriteMode", "static")
    if buckets:
        writer = writer.partitionBy("person_bucket")
    writer.parquet(f"{root}/charges")


def run_record(spark: SparkSession, cfg: RunConfig, status: str, start_at: dt.datetime,
               end_at: dt.datetime | None = None) -> DataFrame:
    row = cfg.to_row()
    values = {f.name: row.get(f.name) for f in RUNS.fields}
    values.update({"id": cfg.id, "status": status, "start_at": start_at, "end_at": end_at,
                   "cutoff_date": dt.date.fromisoformat(cfg.cutoff_date)})
    return spark.createDataFrame([tuple(values[f.name] for f in RUNS.fields)], RUNS)


def _records(spark: SparkSession, root: str) -> DataFrame:
    """Every record ever written; few rows per run."""
    if not exists(spark, f"{root}/runs"):
        return spark.createDataFrame([], RECORDS)
    return spark.read.schema(RECORDS).parquet(f"{root}/runs")


def write_run_record(spark: SparkSession, root: str, cfg: RunConfig, status: str, start_at: dt.datetime,
                     end_at: dt.datetime | None = None, attempt: str | None = None) -> None:
    """Add a record of the run; with ``attempt``, the run's tables are those of that attempt from now on.

    The record is one file, which appears whole or not at all.
    """
    last = _records(spark, root).filter(F.col("id") == cfg.id).agg(F.max("version")).first()[0] or 0
    row = run_record(spark, cfg, status, start_at, end_at).drop("id")
    row = row.withColumns({"version": F.lit(last + 1).cast("long"), "attempt": F.lit(attempt).cast("string")})
    row.coalesce(1).write.mode("append").parquet(f"{root}/runs/id={cfg.id}")


def _published(spark: SparkSession, root: str, run_id: str | None = None) -> list[tuple[str, str, int]]:
    """(run id, attempt, version) of every published attempt, the latest first; driver-side, a few rows per run."""
    found = _records(spark, root).filter("attempt is not null")
    if run_id is not None:
        found = found.filter(F.col("id") == run_id)
    return sorted(((r["id"], r["attempt"], r["version"]) for r in found.select("id", "attempt", "version").collect()),
                  key=lambda x: (-x[2], x[1]))


def write_results(features: DataFrame | None, outcomes: DataFrame, root: str, run_id: str,
                  dropped: DataFrame | None = None) -> str:
    """Write a run's tables as a new attempt, which nothing reads before a record names it; the attempt's name.

    Without features the run has none, so features of an earlier run with the same id never outlive it.
    """
    attempt = uuid.uuid4().hex
    for table, df in (("features", features), ("dropped", dropped), ("outcomes", outcomes)):
        if df is not None:
            df.drop(RESULT_TABLES[table][1]).write.parquet(attempt_path(root, table, run_id, attempt))
    return attempt


def remove_unpublished(spark: SparkSession, root: str, run_id: str) -> None:
    """Remove the run's attempts, except the published one and the one before it, which a reader may still hold.

    One job at a time may classify under a run id: an attempt being written by another would go, too.
    """
    keep = {attempt for _, attempt, _ in _published(spark, root, run_id)[:2]}
    for table in ("features", "dropped", "outcomes"):
        folder, fs = path_of(spark, f"{root}/{table}/run_id={run_id}")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("attempt=") and name.removeprefix("attempt=") not in keep:
                fs.delete(status.getPath(), True)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All runs' rows of a table with its declared schema: the last record of each run, or the tables they name."""
    schema = RESULT_TABLES[table][0]
    if table == "runs":
        last = _records(spark, root).groupBy("id").agg(F.max_by(F.struct(*RUNS.names[1:]), F.struct("version", "attempt")).alias("r"))
        return last.select("id", "r.*")
    attempts: dict[str, str] = {}
    for run, attempt, _ in _published(spark, root):
        attempts.setdefault(run, attempt)
    return _read_attempts(spark, root, table, attempts, schema)


def _read_attempts(spark: SparkSession, root: str, table: str, attempts: dict[str, str], schema: T.StructType) -> DataFrame:
    paths = [p for run, attempt in attempts.items() if exists(spark, p := attempt_path(root, table, run, attempt))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """Results of one run, through its last published record."""
    if table == "runs":
        return read_table(spark, root, table).filter(F.col("id") == run_id)
    found = _published(spark, root, run_id)
    return _read_attempts(spark, root, table, {run_id: found[0][1]} if found else {}, RESULT_TABLES[table][0])


def write_person_clustered(df: DataFrame, path: str, prefix_len: int = 5) -> None:
    """Person-clustered export: directory = first characters of the person id.

    ``rebalance`` on the prefix sends each directory's rows to few tasks (so
    the file count stays near the directory count instead of tasks x
    directories), and AQE splits a hot prefix over several tasks and files.
    """
    out = df.withColumn("person_prefix", F.substring(F.col("person_id").cast("string"), 1, prefix_len))
    out.hint("rebalance", "person_prefix").write.mode("overwrite").partitionBy("person_prefix").parquet(path)


PERSON_FILE_FIELDS = ("person_id", "hearing_date", "code_section", "charge_type", "charge_class",
                      "disposition_code", "plea", "race", "sex", "fips", "locality")


def person_file_line(fields=PERSON_FILE_FIELDS):
    """One comma-separated text line per charge; the first comma inside a field becomes '..'
    and a missing value is written as 'NA'."""
    from eligo.functions.text import first_comma_to_dots
    return F.concat_ws(",", *[F.coalesce(first_comma_to_dots(F.col(c).cast("string")), F.lit("NA"))
                              for c in fields])


def append_table(df: DataFrame, path: str) -> None:
    """Create-or-append."""
    df.write.mode("append").parquet(path)


def write_decision_table(spark: SparkSession, path: str, rule_set=None, fmt: str = "parquet") -> None:
    """The labelled decision table (12 keys + label) as a training / reference file (CSV or Parquet)."""
    from eligo.operators.rules import D3, decision_table
    table = decision_table(spark, rule_set or D3)
    writer = table.coalesce(1).write.mode("overwrite")  # 12,288 rows: one small file
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
