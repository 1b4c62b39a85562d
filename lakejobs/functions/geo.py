"""Distances on the sphere."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in kilometres.
EARTH_RADIUS_KM = 6371


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines; NULL if any input is NULL.

    ``acos`` gives NaN just above 1, so its argument is clamped. ``greatest`` and
    ``least`` skip NULLs, so the clamp may only see a complete quadruple.
    """
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon2) - F.radians(lon1))
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.when((lat1 == lat2) & (lon1 == lon2), F.lit(0.0)).when(
        lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull(),
        F.acos(clamped) * F.lit(EARTH_RADIUS_KM),
    )


def speed(distance: Column, minutes: Column) -> Column:
    """Kilometres per minute.

    No time and no distance is speed 0; a distance in no time is infinitely fast.
    """
    return (
        F.when((minutes == 0) & (distance == 0), F.lit(0.0))
        .when((minutes == 0) & (distance > 0), F.lit(float("inf")))
        .otherwise(F.try_divide(distance, minutes))
    )
