"""End-to-end runs: ingest raw charges; classify charges into a run of results."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.config import RunConfig
from eligo.operators.audit import refuse_duplicate_ids
from eligo.operators.clean import clean_charges
from eligo.plans.classify import classify, classify_rows, dropped_counts
from eligo.schemas import FEATURES, OUTCOMES
from eligo.sinks import ledger, tables as sinks

log = logging.getLogger(__name__)


def run_ingestion(raw: DataFrame, root: str, as_of: str | None = None, clear_existing: bool = True,
                  buckets: int | None = None, person_files: int | None = None) -> ledger.Load | None:
    """Raw charges -> cleaned charges table.

    Rows that name their file (``source_file``) go through the load ledger: an append adds only files that the table
    does not hold, and refuses changed files and double ids; a refresh begins the ledger anew. Other rows are narrow
    transforms without a shuffle, and an append of them adds what it is given. ``person_files`` stores the charges
    clustered by person (``sinks.clustered``), which takes an exchange; files that go through the ledger are not.
    """
    clean = lambda rows: clean_charges(rows, as_of)
    if "source_file" in raw.columns and not clear_existing:
        if person_files:
            raise ValueError("an append through the load ledger is not clustered by person")
        return ledger.append_files(raw, root, clean, buckets)
    charges = clean(raw)
    if "source_file" in raw.columns:
        refuse_duplicate_ids(charges)
    sinks.write_charges(charges, root, clear_existing=clear_existing, buckets=buckets, person_files=person_files)
    if "source_file" in raw.columns:
        ledger.record_refresh(raw, root)
    elif clear_existing:
        sinks.delete(raw.sparkSession, f"{root}/loads")
    return None


def _publish(spark: SparkSession, root: str, cfg: RunConfig, staged: str, write_features: bool, charges: DataFrame) -> str:
    """Write the run's tables from the staged classification as an attempt; its name, for the record."""
    wide = spark.read.parquet(staged)
    project = lambda schema: wide.select(*[f.name for f in schema.fields if f.name != "run_id"])
    return sinks.write_results(project(FEATURES) if write_features else None, project(OUTCOMES), root, cfg.id,
                               dropped_counts(charges, cfg))


def _clean_up(spark: SparkSession, root: str, run_id: str, staged: str) -> None:
    """After the record: what is staged and what no reader finds any more."""
    sinks.delete(spark, staged)
    sinks.remove_unpublished(spark, root, run_id)


def run_classification(spark: SparkSession, root: str, cfg: RunConfig | None = None,
                       write_features: bool = False, charges: DataFrame | None = None) -> str:
    """Classify the charges table into ``outcomes`` (and ``features``) under the run id.

    A repeated run id replaces the earlier run, in one step: with the record 'Completed', which names the tables. The
    run record goes from 'In Progress' to 'Completed', 'Canceled' or 'Failed'. The classification runs once, into a staging table, and the result tables are projections of it.
    """
    cfg = (cfg or RunConfig()).resolved()
    start = dt.datetime.now()
    sinks.write_run_record(spark, root, cfg, "In Progress", start)
    status, attempt = "Failed", None
    try:
        source = charges if charges is not None else spark.read.parquet(f"{root}/charges").drop("person_bucket")
        staged = f"{root}/_staging/{cfg.id}-{uuid.uuid4().hex}"
        stage_table(source, cfg, write_features).write.parquet(staged)
        attempt = _publish(spark, root, cfg, staged, write_features, source)
        status = "Completed"
    except KeyboardInterrupt:
        status = "Canceled"
        raise
    except Exception:
        log.exception("classification run %s failed", cfg.id)
        raise
    finally:
        sinks.write_run_record(spark, root, cfg, status, start, dt.datetime.now(), attempt if status == "Completed" else None)
    _clean_up(spark, root, cfg.id, staged)
    return cfg.id


def stage_table(charges: DataFrame, cfg: RunConfig, write_features: bool) -> DataFrame:
    """Outcome columns and, if wanted, feature columns of one classification."""
    if not write_features:
        return classify(charges, cfg)[1].drop("run_id")
    wide = classify_rows(charges, cfg).withColumnRenamed("id", "charge_id")
    return wide.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in
                         [*FEATURES.fields, *OUTCOMES.fields[2:]] if f.name != "run_id"])


def classify_table(spark: SparkSession, input_path: str, output_path: str, cfg: RunConfig | None = None,
                   rule_set=None) -> None:
    """Classify every person of a charges table and append the per-charge file to ``output_path``
    (created on first use). One distributed job, not a loop over persons."""
    import dataclasses

    from eligo.plans.classify import classified_file, classify_rows, clean_for_rules
    cfg = cfg or dataclasses.replace(RunConfig(), dialect="d2", apply_cutoff=False)
    charges = spark.read.parquet(input_path)
    out = classified_file(classify_rows(charges, cfg, rule_set), clean_for_rules(charges, cfg))
    sinks.append_table(out, output_path)


def _staging_key(charges: DataFrame, cfg: RunConfig, buckets: int, write_features: bool) -> str:
    """Names the staged work of one run: another input, configuration or layout never meets it."""
    facts = [repr(cfg), buckets, write_features, sorted(charges.inputFiles())]
    return hashlib.sha256(json.dumps(facts).encode()).hexdigest()[:32]


def run_classification_resumable(spark: SparkSession, root: str, cfg: RunConfig | None = None, buckets: int | None = None,
                                 write_features: bool = False) -> str:
    """Classify the charges table bucket by bucket of persons; a rerun after a failure skips finished buckets.

    Persons are independent, so each bucket is an exact classification of its persons. A bucket counts as finished
    once its job has committed (its success marker is there). The staged buckets belong to one configuration, one
    set of input files and one bucket count; they are deleted when the run is published, so a later run with the
    same id starts anew. With a charges table written by ``run_ingestion(..., buckets=n)`` the number of buckets is
    the table's (another number is refused) and each bucket reads its own partition; else it is ``buckets`` (16),
    and every bucket scans the table.
    """
    cfg = (cfg or RunConfig()).resolved()
    layout = sinks.bucket_layout(spark, root)
    if layout and buckets and buckets != layout:
        raise ValueError(f"{root}/charges has {layout} person buckets, not {buckets}")
    charges = spark.read.parquet(f"{root}/charges")
    if "person_bucket" in charges.columns and not layout:
        raise ValueError(f"{root}/charges is partitioned by person bucket, but their number is not stored beside it")
    n = layout or buckets or 16
    staging = f"{root}/_staging/{cfg.id}-{_staging_key(charges, cfg, n, write_features)}"
    start = dt.datetime.now()
    sinks.write_run_record(spark, root, cfg, "In Progress", start)
    status, attempt = "Failed", None
    try:
        if not layout:
            charges = charges.withColumn("person_bucket", sinks.person_bucket(n))
        for b in range(n):
            if not sinks.exists(spark, f"{staging}/bucket={b}/_SUCCESS"):
                part = charges.filter(F.col("person_bucket") == b).drop("person_bucket")
                stage_table(part, cfg, write_features).write.mode("overwrite").parquet(f"{staging}/bucket={b}")
        attempt = _publish(spark, root, cfg, staging, write_features, charges.drop("person_bucket"))
        status = "Completed"
    except KeyboardInterrupt:
        status = "Canceled"
        raise
    finally:
        sinks.write_run_record(spark, root, cfg, status, start, dt.datetime.now(), attempt if status == "Completed" else None)
    _clean_up(spark, root, cfg.id, staging)
    return cfg.id
