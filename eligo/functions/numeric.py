"""Numeric column formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mass_index(mass, height_cm) -> Column:
    """``mass / (height_cm / 100)^2`` (null when either input is null or the height is 0)."""
    mass = F.col(mass) if isinstance(mass, str) else mass
    height = F.col(height_cm) if isinstance(height_cm, str) else height_cm
    return mass / F.pow(F.nullif(height, F.lit(0)) / F.lit(100.0), F.lit(2))
