"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.session import checkpoint_dir

# A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). ``bytes.split()`` without
# arguments splits on exactly these, so Python code gets the same words from the UTF-8 bytes.
WORD = r"[^\x20\x09-\x0D]+"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: what was computed is neither computed twice nor lost with an executor.
    """
    path = work_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process.

    Functions of this package are shipped by value, so their module globals last for one task only.
    """
    import sys
    return sys.__dict__.setdefault("_eligo_llm_cache", {})
