"""A charges table derived from the driver's ``orders`` table.

``o_orderkey`` is the charge id and ``o_custkey`` the person. Order dates are
put in 30-day bins and each bin becomes 120 days from 1994-01-01, which gives
histories long enough for the 7/10-year rules and many same-day groups. The
category columns cycle through the values that exercise every rule branch.
The same definition is given as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Cutoff used by parity runs (the cutoff filter then removes some rows).
PARITY_CUTOFF = "2019-12-31"

# The cyclic category assignment of the fixture (FIXTURES.md §3).
CODE_SECTIONS = ("4.1-305", "18.2-250.1", "18.2-96", "18.2-103", "18.2-248.1", "18.2-266", "18.2-57.2",
                 "A.46.2-862", None, "18.2-95", "B.46.2-301")
DISPOSITIONS = ("Guilty", "Guilty In Absentia", "Dismissed", "Nolle Prosequi", "Not Guilty",
                "Not Guilty/Acquitted", "No Indictment Presented", "Not True Bill", "Dismissed/Other", "Prepaid",
                None, "Dismissed", "Resolved")
PLEAS = ("Guilty", "Alford", "Nolo Contendere", None, "Not Guilty", "Not Guilty", "Not Guilty")
RACES = ("Black (Non-Hispanic)", "WHITE", "White Caucasian (Non-Hispanic)", "Asian Or Pacific Islander",
         "American Indian", "Alaskan Native", "MISSING", "Other(Includes Not Applicable, Unknown)", "Hispanic",
         None, "caucasian", "black")
CLASSES = {0: "1", 1: "2", 2: "3", 3: "4", 4: None}  # every other remainder of 17 -> '6'


def _cycle(expr: str, values) -> str:
    """The value at position ``expr`` (0-based, always in range) of a constant array.

    An array lookup stays cheap when the optimizer inlines the column into
    several consumers (a long CASE would be copied into each of them).
    """
    def lit(v):
        return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "\\'") + "'"
    return f"element_at(array({', '.join(lit(v) for v in values)}), CAST({expr} AS INT) + 1)"


# Spark SQL text of the view (one selectExpr: the plan is built in a single call).
CHARGES_SPARK_EXPRS = (
    "o_orderkey AS id",
    "o_custkey AS person_id",
    "date_add(DATE'1994-01-01', CAST(floor(datediff(CAST(o_orderdate AS DATE), DATE'1995-01-01') / 30) * 120 AS INT))"
    " AS hearing_date",
    _cycle("o_orderkey % 11", CODE_SECTIONS) + " AS code_section",
    "CASE WHEN o_orderkey % 5 = 3 THEN 'Felony' WHEN o_orderkey % 5 = 4 AND o_orderkey % 4 = 0 THEN 'Infraction'"
    " ELSE 'Misdemeanor' END AS charge_type",
    _cycle("o_orderkey % 17", [CLASSES.get(i, "6") for i in range(17)]) + " AS charge_class",
    _cycle("(o_orderkey + o_custkey) % 13", DISPOSITIONS) + " AS disposition_code",
    _cycle("(o_orderkey * 3 + o_custkey) % 7", PLEAS) + " AS plea",
    _cycle("(o_custkey + o_orderkey % 3) % 12", RACES) + " AS race",
    _cycle("(o_custkey + o_orderkey) % 9", (None, "Female", "Female") + ("Male",) * 6) + " AS sex",
    "CAST((o_custkey * 7) % 1200 AS STRING) AS fips",
    "CASE WHEN o_orderkey % 41 > 0 THEN concat('County ', CAST((o_custkey + o_orderkey) % 50 AS STRING), ', North, VA') END"
    " AS locality",
)


def charges_from_orders(orders: DataFrame) -> DataFrame:
    """Charges view (schema of the ``charges`` table) from an ``orders`` DataFrame."""
    return orders.selectExpr(*CHARGES_SPARK_EXPRS)


def load_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return charges_from_orders(orders)


def _sql_case(expr: str, values, default=None) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    parts = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {parts} ELSE {lit(default)} END"


# DuckDB text of the same view (tables are pre-registered views in the oracle).
CHARGES_SQL = f"""
SELECT o_orderkey AS id, o_custkey AS person_id,
  CAST(DATE '1994-01-01' + CAST(((CAST(o_orderdate AS DATE) - DATE '1995-01-01') // 30) * 120 AS INTEGER) AS DATE)
    AS hearing_date,
  {_sql_case('o_orderkey % 11', CODE_SECTIONS)} AS code_section,
  CASE o_orderkey % 5 WHEN 3 THEN 'Felony'
    WHEN 4 THEN CASE WHEN o_orderkey % 4 = 0 THEN 'Infraction' ELSE 'Misdemeanor' END ELSE 'Misdemeanor' END
    AS charge_type,
  CASE o_orderkey % 17 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' WHEN 4 THEN NULL ELSE '6' END
    AS charge_class,
  {_sql_case('(o_orderkey + o_custkey) % 13', DISPOSITIONS)} AS disposition_code,
  {_sql_case('(o_orderkey * 3 + o_custkey) % 7', PLEAS)} AS plea,
  {_sql_case('(o_custkey + o_orderkey % 3) % 12', RACES)} AS race,
  CASE (o_custkey + o_orderkey) % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Female' WHEN 2 THEN 'Female' ELSE 'Male' END
    AS sex,
  CAST((o_custkey * 7) % 1200 AS VARCHAR) AS fips,
  CASE WHEN o_orderkey % 41 > 0 THEN 'County ' || CAST((o_custkey + o_orderkey) % 50 AS VARCHAR) || ', North, VA' END
    AS locality
FROM orders
"""
