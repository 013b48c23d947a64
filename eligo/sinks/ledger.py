"""Load ledger: which files the charges table holds, so that loading a file twice adds nothing.

A file is known by the number of its rows and the sum of their 64-bit hashes, over the rows as they were read: one
aggregation that is split like any scan, and does not depend on the rows' order or on how the file is cut. The ledger
is a small table under the root, one row per file and step, that is only ever added to:

1. 'pending' is written before a file's charges are appended, 'loaded' after.
2. A file whose content is loaded already, under whatever name, is passed over.
3. A file whose name is loaded with other content is reported, and nothing is loaded.
4. A file that is pending was cut off between the two steps; its charges are appended without those whose id is in
   the table already, so a repeated load neither loses nor doubles a charge.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.operators.audit import key_audit, DuplicateKeys
from eligo.sinks import tables as sinks

LEDGER = "file string, n_rows long, checksum string, status string, load_id string, at timestamp"


class ChangedFile(ValueError):
    """A file's name is in the ledger with other content."""


class Load(NamedTuple):
    loaded: list[str]
    skipped: list[str]


def file_name(col: str = "source_file") -> Column:
    """The name without its folders: a file that was moved is the same file."""
    return F.element_at(F.split(col, "/"), -1)


def fingerprints(raw: DataFrame) -> DataFrame:
    """(file, n_rows, checksum) of every file behind ``raw`` (rows with a column ``source_file``).

    Ids made from the file's name (``made_id``) are not part of its content.
    """
    content = {c: F.col(f"`{c}`") for c in raw.columns if c not in ("source_file", "year", "made_id")}
    if "made_id" in raw.columns and "id" in content:
        content["id"] = F.when(~F.col("made_id"), F.col("id"))
    # A null hashes like nothing at all, so each column's presence is hashed with it.
    row = F.xxhash64(*content.values(), *[c.isNull() for c in content.values()])
    return (raw.select(file_name().alias("file"), row.cast("decimal(38,0)").alias("h")).groupBy("file")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("h").cast("string").alias("checksum")))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every step written; a few rows per file."""
    if not sinks.exists(spark, f"{root}/loads"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{root}/loads")


def _write(prints: DataFrame, root: str, status: str, load_id: str) -> None:
    rows = prints.select("file", "n_rows", "checksum", F.lit(status).alias("status"), F.lit(load_id).alias("load_id"), F.current_timestamp().alias("at"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/loads")


def judged(prints: DataFrame, ledger: DataFrame) -> DataFrame:
    """``prints`` with ``verdict``: 'loaded' (this content is in), 'changed' (this name is in with other content),
    'pending' (begun, not finished) or 'new'. Of two new files with one content the first by name counts as new."""
    same = ledger.groupBy("n_rows", "checksum").agg(F.bool_or(F.col("status") == "loaded").alias("is_in"))
    named = ledger.groupBy("file").agg(F.bool_or(F.col("status") == "loaded").alias("name_in"),
                                       F.collect_set(F.when(F.col("status") == "pending", F.col("checksum"))).alias("begun"))
    first = prints.groupBy("n_rows", "checksum").agg(F.min("file").alias("first"))
    rows = prints.join(same, ["n_rows", "checksum"], "left").join(named, "file", "left").join(first, ["n_rows", "checksum"])
    return rows.select(
        "file", "n_rows", "checksum",
        F.when(F.coalesce("is_in", F.lit(False)) | (F.col("first") != F.col("file")), "loaded")
        .when(F.coalesce("name_in", F.lit(False)), "changed")
        .when(F.coalesce(F.array_contains("begun", F.col("checksum")), F.lit(False)), "pending").otherwise("new").alias("verdict"))


def append_files(raw: DataFrame, root: str, clean, buckets: int | None = None) -> Load:
    """Append the charges of those files behind ``raw`` that the table does not hold yet.

    ``clean`` turns raw rows into charges. Ids that would be double, among the new charges or with those in the table,
    are refused before anything is written.
    """
    spark = raw.sparkSession
    prints = fingerprints(raw)
    by: dict[str, list[str]] = {}
    rows = judged(prints, read_ledger(spark, root)).collect()  # one row per file
    for r in rows:
        by.setdefault(r["verdict"], []).append(r["file"])
    if by.get("changed"):
        raise ChangedFile(f"loaded before with other content: {', '.join(sorted(by['changed']))}")
    todo = [r for r in rows if r["verdict"] in ("new", "pending")]
    if not todo:
        return Load([], sorted(by.get("loaded", [])))
    wanted = spark.createDataFrame([(r["file"], r["n_rows"], r["checksum"]) for r in todo], "file string, n_rows long, checksum string")
    of_file = raw.withColumn("_file", file_name())
    charges = clean(of_file.join(F.broadcast(wanted.select(F.col("file").alias("_file"))), "_file", "left_semi").drop("_file"))
    held = sinks.exists(spark, f"{root}/charges")
    table = spark.read.parquet(f"{root}/charges").select("id") if held else None
    if by.get("pending") and held:
        charges = charges.join(table, "id", "left_anti").select(*charges.columns)
    ids = charges.select("id")
    bad = [r for r in key_audit(ids.unionByName(table) if held else ids).collect() if r["n_ids"]]
    if bad:
        raise DuplicateKeys("; ".join(f"{r['n_ids']} x {r['problem']} (first id {r['first_id']})" for r in bad))
    load_id = uuid.uuid4().hex
    _write(wanted, root, "pending", load_id)
    sinks.write_charges(charges, root, clear_existing=False, buckets=buckets)
    _write(wanted, root, "loaded", load_id)
    return Load(sorted(r["file"] for r in todo), sorted(by.get("loaded", [])))


def record_refresh(raw: DataFrame, root: str) -> None:
    """Begin the ledger anew with the files of a full refresh."""
    spark, prints = raw.sparkSession, fingerprints(raw)
    sinks.delete(spark, f"{root}/loads")
    _write(prints, root, "loaded", uuid.uuid4().hex)
