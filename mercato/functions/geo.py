"""Great-circle distance as a Column expression (stays inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_

# fixed value: mean Earth radius in km used by the reference distance
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; NULL unless all four coordinates are present.

    ``a`` is clamped to 1 so rounding can never push ``asin`` out of its domain;
    the explicit mask matters because ``least`` skips NULL arguments.
    """
    c = [col_(x) for x in (lat1, lon1, lat2, lon2)]
    p1, p2 = F.radians(c[0]), F.radians(c[2])
    dlat = p2 - p1
    dlon = F.radians(c[3]) - F.radians(c[1])
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    valid = c[0].isNotNull() & c[1].isNotNull() & c[2].isNotNull() & c[3].isNotNull()
    return F.when(valid, F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0)))))
