"""Mean coordinates by zip prefix and by city."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import exact_mean, rounded


def zip_centroids(source: DataFrame) -> DataFrame:
    """One row per zip prefix; the place name is the alphabetically first one."""
    return (
        source.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"))
        .agg(
            rounded(exact_mean("geolocation_lat"), 4).alias("lat"),
            rounded(exact_mean("geolocation_lng"), 4).alias("lng"),
            F.min("geolocation_city").alias("city"),
            F.min("geolocation_state").alias("state"),
        )
    )


def _by_city(points: DataFrame, lat: str, lng: str) -> DataFrame:
    return points.groupBy("city", "state").agg(
        rounded(exact_mean(lat), 4).alias("lat"), rounded(exact_mean(lng), 4).alias("lng")
    )


def city_centroids(zips: DataFrame) -> DataFrame:
    """Mean of the zip means, so every zip weighs the same."""
    return _by_city(zips, "lat", "lng")


def city_centroids_by_point(source: DataFrame) -> DataFrame:
    """Mean of all points of a city."""
    return _by_city(
        source.select(
            F.col("geolocation_city").alias("city"), F.col("geolocation_state").alias("state"),
            "geolocation_lat", "geolocation_lng",
        ),
        "geolocation_lat", "geolocation_lng",
    )


def with_coordinates(people: DataFrame, centroids: DataFrame) -> DataFrame:
    return people.join(centroids, ["city", "state"], "left")
