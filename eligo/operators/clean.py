"""Ingest cleaning of raw charge rows (narrow transforms only: no shuffle)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from eligo.functions.text import fix_fips, standardize_race

# Raw column -> charges column (the raw ``id`` is carried along as the charge id).
RAW_TO_CHARGES = {
    "person_id": "person_id",
    "HearingDate": "hearing_date",
    "CodeSection": "code_section",
    "ChargeType": "charge_type",
    "Class": "charge_class",
    "DispositionCode": "disposition_code",
    "Plea": "plea",
    "Race": "race",
    "Sex": "sex",
    "fips": "fips",
    "Locality": "locality",
}


def rename_columns(raw: DataFrame, keep_id: bool = True) -> DataFrame:
    """Rename raw columns to the charges layout and keep only those columns (a table without Locality gets nulls)."""
    cols = (["id"] if keep_id and "id" in raw.columns else []) + list(RAW_TO_CHARGES.values())
    if "Locality" not in raw.columns:
        raw = raw.withColumn("Locality", F.lit(None).cast("string"))
    return raw.withColumnsRenamed({k: v for k, v in RAW_TO_CHARGES.items() if k != v}).select(*cols)


def to_raw_layout(charges: DataFrame) -> DataFrame:
    """Inverse of :func:`rename_columns` (charges layout -> raw court-record layout)."""
    back = {v: k for k, v in RAW_TO_CHARGES.items() if k != v}
    return charges.withColumnsRenamed(back)


def filter_hearing_dates(df: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Keep hearings on or before ``as_of`` (default: today)."""
    bound = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return df.filter(F.col("hearing_date") <= bound)


def standardize_race_column(df: DataFrame) -> DataFrame:
    return df.withColumn("race", standardize_race("race"))


def fix_fips_codes(df: DataFrame) -> DataFrame:
    return df.withColumn("fips", fix_fips("fips"))


def clean_charges(raw: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """rename -> date filter -> race -> fips, as one chain of narrow transforms."""
    return (raw.transform(rename_columns)
            .transform(lambda d: filter_hearing_dates(d, as_of))
            .transform(standardize_race_column)
            .transform(fix_fips_codes))
