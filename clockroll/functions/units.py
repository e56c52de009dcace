"""Unit allow-lists: which measures are aggregated, and which also get a standard deviation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the original job's lists for identical filtering):
# basic units get count/sum/min/max/mean/last, advanced units also the std family.
BASIC_UNITS = ("lx", "m/s")
ADVANCED_UNITS = ("%", "A", "ppm", "V", "W", "°C")


def is_target_unit(unit: Column, basic=BASIC_UNITS, advanced=ADVANCED_UNITS) -> Column:
    """Exact, case-sensitive membership; NULL unit -> false."""
    return F.coalesce(unit.isin(*basic, *advanced), F.lit(False))


def with_stdev(unit: Column, advanced=ADVANCED_UNITS) -> Column:
    return F.coalesce(unit.isin(*advanced), F.lit(False))
