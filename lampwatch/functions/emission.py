"""emission estimate in kg, same operation order as the rule spec:
``seconds / 3600 * watts / 1000 * factor``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def emission_kg(seconds: Column, power_w: Column, factor: Column) -> Column:
    return ((seconds.cast("double") / F.lit(3600.0))
            * (power_w / F.lit(1000.0))
            * factor)
