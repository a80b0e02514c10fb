"""Distance on the sphere."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txscore.constants import EARTH_RADIUS_KM


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi1 - phi2) / 2
    half_dlambda = (F.radians(lon1) - F.radians(lon2)) / 2
    h = F.pow(F.sin(half_dphi), 2.0) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2.0)
    # Rounding may push h above 1 for antipodes. `least` would also turn null into 1.
    safe = F.when((h > 1.0) & ~F.isnan(h), F.lit(1.0)).otherwise(h)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(safe))
