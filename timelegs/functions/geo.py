"""Coordinates, great-circle distance and distance bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timelegs.functions.text import col

# Mean Earth radius and the upper edges of the distance bands.
EARTH_RADIUS_KM = 6371.0088
DISTANCE_BANDS = [
    (0.25, "Under 0.25 km"),
    (0.50, "0.25-0.50 km"),
    (1.00, "0.50-1.00 km"),
    (2.00, "1.00-2.00 km"),
]
WIDEST_BAND = "2.00 km or more"
ZERO_BAND = "Zero"
MISSING_BAND = "Missing"

# Plain decimal notation; the cast alone would also take Java suffixes such as ``1d``.
DECIMAL_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

LATITUDE_LIMIT = 90.0
LONGITUDE_LIMIT = 180.0


def valid_coordinate(text: Column | str, limit: float) -> Column:
    """The number in ``text`` when it lies within ±limit, else NULL."""
    trimmed = F.trim(col(text).cast("string"))
    number = trimmed.try_cast("double")
    return F.when(trimmed.rlike(DECIMAL_NUMBER) & number.between(-limit, limit), number)


def has_both(latitude: Column | str, longitude: Column | str) -> Column:
    """1 when both coordinates are known; 0.0 counts as known."""
    return (col(latitude).isNotNull() & col(longitude).isNotNull()).cast("int")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; NULL when any coordinate is NULL.

    ``least``/``greatest`` skip NULLs, so the guard is what keeps a gap a gap.
    """
    points = [col(c) for c in (lat1, lon1, lat2, lon2)]
    phi1, lambda1, phi2, lambda2 = points
    # Differences are taken in degrees and products from the left: distances that are equal but for
    # their last bit have an order, and it is that of the formula as it is usually written down.
    north, east = [F.sin(F.radians(angle) / 2.0) for angle in (phi2 - phi1, lambda2 - lambda1)]
    share = north * north + F.cos(F.radians(phi1)) * F.cos(F.radians(phi2)) * east * east
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))
    known = points[0].isNotNull()
    for c in points[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped)))


def distance_band(km: Column | str) -> Column:
    km = col(km)
    band = F.when(km.isNull(), MISSING_BAND).when(km == 0, ZERO_BAND)
    for upper_edge, label in DISTANCE_BANDS:
        band = band.when(km < upper_edge, label)
    return band.otherwise(WIDEST_BAND)
