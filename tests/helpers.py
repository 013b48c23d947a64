"""Test helpers: build charge frames and run the brute-force DuckDB oracle on them."""

from __future__ import annotations

import datetime as dt

import duckdb
import pandas as pd

from eligo.schemas import CHARGES

COLS = [f.name for f in CHARGES.fields]


def charge(id, person, date, ctype="Misdemeanor", disp="Guilty", code="18.2-95", plea=None, cls=None,
           race=None, sex=None, fips=None, locality=None):
    if isinstance(date, str):
        date = dt.date.fromisoformat(date)
    return (id, person, date, code, ctype, cls, disp, plea, race, sex, fips, locality)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHARGES)


def oracle(rows, select: str, **kw) -> pd.DataFrame:
    """Run the oracle pipeline over ``rows`` (list of charge tuples) and return ``select`` as pandas."""
    from oracle_queries import with_pipeline
    pdf = pd.DataFrame(rows, columns=COLS)
    pdf["hearing_date"] = pd.to_datetime(pdf["hearing_date"]).dt.date
    con = duckdb.connect()
    con.register("input_rows", pdf)
    con.execute("CREATE TABLE input_charges AS SELECT id::BIGINT AS id, person_id::BIGINT AS person_id, "
                "CAST(hearing_date AS DATE) AS hearing_date, code_section::VARCHAR AS code_section, "
                "charge_type::VARCHAR AS charge_type, charge_class::VARCHAR AS charge_class, "
                "disposition_code::VARCHAR AS disposition_code, plea::VARCHAR AS plea, race::VARCHAR AS race, "
                "sex::VARCHAR AS sex, fips::VARCHAR AS fips, locality::VARCHAR AS locality FROM input_rows")
    return con.execute(with_pipeline(select, source="SELECT * FROM input_charges", **kw)).df()
