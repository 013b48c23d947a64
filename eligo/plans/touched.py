"""Classification after an append: only persons with new charges are classified, other persons' outcomes are carried over.

A charge's label depends on its person's charges and on the configuration alone. So with an unchanged configuration
the outcomes of a person without new charges stay as they are. A charge is new if it takes part (cutoff, valid
disposition, charge type) and the earlier run has no outcome of it; nothing else has to be told. The charges may only
have been added to: a changed charge under an old id is not seen.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.config import RunConfig
from eligo.operators import history as H
from eligo.plans import run as R
from eligo.plans.classify import classify, kept_charges
from eligo.schemas import RUNS
from eligo.sinks import tables as sinks

log = logging.getLogger(__name__)


def known_labels(charges: DataFrame, previous: DataFrame, cfg: RunConfig) -> DataFrame:
    """(person key, charge_id, expungability) of the charges that take part, with the earlier label (null: a new charge).

    One exchange of ids. Earlier outcomes of charges that are no longer there are left out.
    """
    ids = kept_charges(charges, cfg.resolved()).select(*H.PERSON_KEYS, F.col("id").alias("charge_id"))
    return ids.join(previous.select("charge_id", "expungability"), "charge_id", "left").select(
        *H.PERSON_KEYS, "charge_id", "expungability")


def touched_persons(known: DataFrame) -> DataFrame:
    """The person keys with a new charge."""
    return known.filter("expungability IS NULL").select(*H.PERSON_KEYS).distinct()


def touched_outcomes(charges: DataFrame, known: DataFrame, cfg: RunConfig) -> DataFrame:
    """The outcomes of all charges: touched persons classified over their whole histories, the others carried over.

    ``known`` is read twice; store it first where it is large.
    """
    cfg = cfg.resolved()
    persons = touched_persons(known)
    theirs = H.with_person_key(charges).join(persons, list(H.PERSON_KEYS), "left_semi").select(*charges.columns)
    anew = classify(theirs, cfg)[1]
    carried = known.join(persons, list(H.PERSON_KEYS), "left_anti").select(
        "charge_id", F.lit(cfg.id).alias("run_id"), "expungability")
    return anew.unionByName(carried)


def _same_configuration(record, cfg: RunConfig) -> bool:
    now = {**cfg.to_row(), "cutoff_date": dt.date.fromisoformat(cfg.cutoff_date)}
    facts = [f.name for f in RUNS.fields if f.name not in ("id", "start_at", "end_at", "status")]
    plain = lambda v: list(v) if isinstance(v, (list, tuple)) else v
    return all(plain(record[f]) == plain(now.get(f)) for f in facts)


def run_touched(spark: SparkSession, root: str, base_run: str, cfg: RunConfig) -> str:
    """Classify the charges table as ``run_classification`` does, starting from the completed run ``base_run``.

    The configuration must be the base run's. The new run's id may be the base run's own: its outcomes are then
    replaced in one step. Features are not carried over, so the new run has none.
    """
    cfg = cfg.resolved()
    record = sinks.read_run(spark, root, "runs", base_run).first()
    if record is None or record["status"] != "Completed":
        raise ValueError(f"no completed run {base_run}")
    if not _same_configuration(record, cfg):
        raise ValueError(f"run {base_run} has another configuration; its outcomes cannot be carried over")
    start = dt.datetime.now()
    charges = spark.read.parquet(f"{root}/charges").drop("person_bucket")
    previous = sinks.read_run(spark, root, "outcomes", base_run)
    sinks.write_run_record(spark, root, cfg, "In Progress", start)
    status, attempt = "Failed", None
    folder = f"{root}/_staging/{cfg.id}-{uuid.uuid4().hex}"
    try:
        known_labels(charges, previous, cfg).write.parquet(f"{folder}/known")
        outcomes = touched_outcomes(charges, spark.read.parquet(f"{folder}/known"), cfg)
        outcomes.drop("run_id").write.parquet(f"{folder}/outcomes")
        attempt = R._publish(spark, root, cfg, f"{folder}/outcomes", False, charges)
        status = "Completed"
    except KeyboardInterrupt:
        status = "Canceled"
        raise
    except Exception:
        log.exception("classification run %s failed", cfg.id)
        raise
    finally:
        sinks.write_run_record(spark, root, cfg, status, start, dt.datetime.now(), attempt if status == "Completed" else None)
    R._clean_up(spark, root, cfg.id, folder)
    return cfg.id
