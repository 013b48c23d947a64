"""Scaling check: classification and look-back flags on larger inputs derived from sf0.1 ``orders``.

Usage: python tools/scaling.py SCRATCH_DIR [copies ...]   (default copies: 1 10 40)

``orders`` is replicated ``copies`` times with offset order and customer keys
(new charges and new persons, same history shapes) and written as multi-file
Parquet under SCRATCH_DIR; then each job is timed (best of 2, ``noop`` sink).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from eligo.config import RunConfig  # noqa: E402
from eligo.operators.lookback import lookback_flags  # noqa: E402
from eligo.plans.classify import classify  # noqa: E402
from eligo.session import get_spark  # noqa: E402
from eligo.sources.fixtures import PARITY_CUTOFF, charges_from_orders  # noqa: E402


def main():
    scratch = sys.argv[1]
    copies_list = [int(c) for c in sys.argv[2:]] or [1, 10, 40]
    spark = get_spark("local[8]", 8)
    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").select("o_orderkey", "o_custkey",
                                                                              "o_orderdate")
    cfg = RunConfig(cutoff_date=PARITY_CUTOFF)
    for copies in copies_list:
        path = f"{scratch}/orders_x{copies}"
        rep = orders.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        (rep.select((F.col("o_orderkey") + F.col("c").cast("long") * 10_000_000).alias("o_orderkey"),
                    (F.col("o_custkey") + F.col("c").cast("long") * 1_000_000).alias("o_custkey"), "o_orderdate")
            .repartition(max(8, copies)).write.mode("overwrite").parquet(path))
        charges = charges_from_orders(spark.read.parquet(path))
        n = charges.count()
        for name, make in (("classification", lambda: classify(charges, cfg)[1]),
                           ("look-back flags", lambda: lookback_flags(charges))):
            best = None
            for _ in range(2):
                t0 = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                elapsed = time.perf_counter() - t0
                best = elapsed if best is None else min(best, elapsed)
            print(f"{name:16s} charges={n:>10,d} time={best:7.2f}s rows/s={n / best:>11,.0f}")


if __name__ == "__main__":
    main()
