"""Temp views for ad-hoc SQL (``spark.sql``) over charges and a run's results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eligo.config import RunConfig
from eligo.plans.classify import classify_rows, split_tables


def register_views(charges: DataFrame, cfg: RunConfig | None = None, prefix: str = "") -> list[str]:
    """Register ``charges``, ``classified`` (wide), ``features`` and ``outcomes`` as temp views.

    The views are lazy plans; each SQL query over them is optimised together
    with the classification plan (filters and column pruning reach the scan).
    """
    cfg = (cfg or RunConfig()).resolved()
    wide = classify_rows(charges, cfg)
    features, outcomes = split_tables(wide)
    public = wide.select(*[c for c in wide.columns if not c.startswith("_")])
    views = {"charges": charges, "classified": public, "features": features, "outcomes": outcomes}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
