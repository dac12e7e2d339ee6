"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Mean earth radius in km and the city-centre point of the data set.
EARTH_RADIUS_KM = 6371.0
CITY_CENTRE = (47.6062, -122.3321)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km; NULL if a coordinate is missing."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = F.pow(half_lat, F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_lon, F.lit(2.0))
    # Rounding can push the chord past 1, and asin of that would be NaN.
    bounded = F.when(chord.isNotNull(), F.least(F.lit(1.0), F.sqrt(chord)))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(bounded)


def distance_to(lat: Column, lon: Column, point: tuple[float, float] = CITY_CENTRE) -> Column:
    return haversine_km(lat, lon, F.lit(point[0]), F.lit(point[1]))
