"""Look-back flags of the feature prototype, on a per-(person, day) table.

For each charge, over the person's charges on strictly earlier days:
* ``seven_year``: a conviction (raw Guilty / Guilty In Absentia) at most 7 years back;
* ``ten_year``: a felony conviction at most 10 years back;
* ``class_12``: a class 1 or 2 felony conviction at any time before;
* ``class_34``: a class 3 or 4 felony conviction at most 20 years back.
Years are 365.25 days. Works on raw rows (no validity filter).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from eligo import constants as K
from eligo.functions.dates import day_number
from eligo.operators.history import DAY_KEYS, PERSON_KEYS, with_person_key

FLAGS = ("seven_year", "ten_year", "class_12", "class_34")


def lookback_flags(charges: DataFrame, days_per_year: float = K.DAYS_PER_YEAR_JULIAN) -> DataFrame:
    """Charge rows with the four look-back flags added (null hearing date -> all False)."""
    rows = with_person_key(charges)
    conv = F.coalesce(F.col("disposition_code").isin(*K.RAW_CONVICTION_CODES), F.lit(False))
    fel_conv = conv & F.coalesce(F.col("charge_type") == F.lit(K.FELONY), F.lit(False))
    days = (rows.filter(F.col("hearing_date").isNotNull())
            .groupBy(*DAY_KEYS)
            .agg(F.bool_or(conv).alias("_conv"), F.bool_or(fel_conv).alias("_fel"),
                 F.bool_or(fel_conv & F.coalesce(F.col("charge_class").isin("1", "2"), F.lit(False))).alias("_c12"),
                 F.bool_or(fel_conv & F.coalesce(F.col("charge_class").isin("3", "4"), F.lit(False))).alias("_c34"))
            .withColumn("_day", day_number("hearing_date")))
    ordered = Window.partitionBy(*PERSON_KEYS).orderBy("_day")

    def back(years):
        start = Window.unboundedPreceding if years is None else -math.floor(years * days_per_year)
        return ordered.rangeBetween(start, -1)

    days = days.select(*DAY_KEYS,
                       F.bool_or("_conv").over(back(7)).alias("seven_year"),
                       F.bool_or("_fel").over(back(10)).alias("ten_year"),
                       F.bool_or("_c12").over(back(None)).alias("class_12"),
                       F.bool_or("_c34").over(back(20)).alias("class_34"))
    out = rows.join(days, list(DAY_KEYS), "left")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in FLAGS}).drop(*PERSON_KEYS)


def flag_summary(flagged: DataFrame) -> DataFrame:
    """Total rows and rows with each flag set (one row)."""
    return flagged.agg(F.count(F.lit(1)).alias("total_rows"),
                       *[F.count_if(F.col(f)).alias(f"{f}_rows") for f in FLAGS])
