"""Coordinates as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import as_column, ratio

WGS84 = "EPSG:4326"
LAMBERT93 = "EPSG:2154"
EARTH_RADIUS_KM = 6371.0

# Defining constants of the Lambert-93 projection on the GRS80 ellipsoid.
ECCENTRICITY = 0.08181919104281579
CONE_EXPONENT = 0.7256077650532670
CONE_CONSTANT = 11754255.4261
FALSE_EASTING = 700000.0
POLE_NORTHING = 12655612.0499
CENTRAL_MERIDIAN_DEG = 3.0


def crs(df: DataFrame, x: str = "x", y: str = "y") -> Column:
    """Degrees or metres, judged by the value range, as a scalar subquery."""
    degrees = (F.max(F.abs(x)) < 180) & (F.max(F.abs(y)) < 90)
    return df.agg(F.when(degrees, WGS84).otherwise(LAMBERT93).alias("crs")).scalar()


def lambert93_to_degrees(x: str | Column, y: str | Column, rounds: int = 6) -> tuple[Column, Column]:
    """Inverse conformal conic projection with a fixed number of latitude rounds."""
    dx = as_column(x) - FALSE_EASTING
    dy = F.lit(POLE_NORTHING) - as_column(y)
    lon = F.degrees(F.atan(dx / dy) / CONE_EXPONENT) + CENTRAL_MERIDIAN_DEG
    iso = -F.log(F.sqrt(dx * dx + dy * dy) / CONE_CONSTANT) / CONE_EXPONENT
    lat = 2 * F.atan(F.exp(iso)) - math.pi / 2
    for _ in range(rounds):
        # atanh keeps one reference to the previous round, so the expression stays linear.
        lat = 2 * F.atan(F.exp(iso + ECCENTRICITY * F.atanh(ECCENTRICITY * F.sin(lat)))) - math.pi / 2
    return lon, F.degrees(lat)


def with_degrees(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Add `lon` and `lat`, converting only when the table is in metres."""
    system = crs(df, x, y)
    lon, lat = lambert93_to_degrees(x, y)
    return df.withColumn("lon", F.when(system == WGS84, F.col(x)).otherwise(lon)).withColumn(
        "lat", F.when(system == WGS84, F.col(y)).otherwise(lat)
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))


def grid_cell(lon: str | Column, lat: str | Column, size_deg: float) -> Column:
    """Square cell id `column:row`."""
    col = F.floor(as_column(lon) / size_deg).cast("string")
    row = F.floor(as_column(lat) / size_deg).cast("string")
    return F.concat_ws(":", col, row)


def cell_summary(df: DataFrame, size_deg: float, value: str) -> DataFrame:
    return df.groupBy(grid_cell("lon", "lat", size_deg).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")
    )


def centroids(df: DataFrame, area: str = "code_insee", name: str = "nom_com", key: str = "imb_id") -> DataFrame:
    return df.groupBy(area).agg(
        F.min(name).alias(name), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"),
        F.count(key).alias("n_buildings"),
    )


def bounding_box(df: DataFrame, pad: float = 0.01) -> DataFrame:
    return df.agg(
        (F.min("lon") - pad).alias("min_lon"), (F.min("lat") - pad).alias("min_lat"),
        (F.max("lon") + pad).alias("max_lon"), (F.max("lat") + pad).alias("max_lat"),
    )


def morans_i(areas: DataFrame, neighbours: DataFrame, area: str, value: str) -> DataFrame:
    """Moran's I with row-standardised weights from an `(area, neighbour)` list."""
    mean = areas.agg(F.avg(value)).scalar()
    z = areas.select(F.col(area), (F.col(value) - mean).alias("z"))
    other = z.select(F.col(area).alias("neighbour"), F.col("z").alias("zn"))
    lagged = (
        neighbours.join(other, "neighbour").groupBy(area).agg(F.avg("zn").alias("lag"))
    )
    return z.join(lagged, area).agg(
        ratio(F.sum(F.col("z") * F.col("lag")), F.sum(F.col("z") * F.col("z"))).alias("morans_i"),
        F.count(F.lit(1)).alias("n_areas"),
    )
