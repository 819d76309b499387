"""Region rosters: small constant dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Named centres as (latitude, longitude), radius in nautical miles.
WORLD = {
    "delhi": (28.61, 77.20),
    "mumbai": (19.07, 72.87),
    "dubai": (25.20, 55.27),
    "doha": (25.28, 51.53),
    "istanbul": (41.00, 28.97),
    "london": (51.50, -0.12),
    "frankfurt": (50.11, 8.68),
    "new_york": (40.71, -74.00),
    "atlanta": (33.64, -84.42),
    "los_angeles": (33.94, -118.40),
    "toronto": (43.65, -79.38),
    "tokyo": (35.68, 139.76),
    "seoul": (37.56, 126.97),
    "beijing": (39.90, 116.40),
    "shanghai": (31.23, 121.47),
    "singapore": (1.35, 103.82),
    "sydney": (-33.86, 151.20),
    "sao_paulo": (-23.55, -46.63),
    "johannesburg": (-26.20, 28.04),
    "cairo": (30.04, 31.24),
    "atlantic_mid": (52.0, -30.0),
    "pacific_mid": (35.0, 170.0),
    "indian_ocean_mid": (-10.0, 80.0),
    "north_polar": (75.0, -40.0),
}
INDIA = {
    "hyderabad": (17.38, 78.48),
    "delhi": (28.61, 77.20),
    "mumbai": (19.08, 72.88),
    "bangalore": (12.97, 77.59),
}
INDIA_FIRST = {
    "hyderabad": (17.3850, 78.4867),
    "mumbai": (19.0760, 72.8777),
    "delhi": (28.6139, 77.2090),
}
ROSTERS = {"world": WORLD, "india": INDIA, "india_first": INDIA_FIRST}
RADIUS_NM = 250

_SCHEMA = "region STRING, centre_lat DOUBLE, centre_lon DOUBLE, radius_nm INT, label STRING"


def roster(spark: SparkSession, name: str = "world") -> DataFrame:
    """(region, centre_lat, centre_lon, radius_nm, label) of one roster."""
    rows = [
        (region, lat, lon, RADIUS_NM, region.replace("_", " ").title())
        for region, (lat, lon) in ROSTERS[name].items()
    ]
    return spark.createDataFrame(rows, _SCHEMA)


def with_region(df: DataFrame, column: str, name: str = "world") -> DataFrame:
    """Left lookup of the roster; its size is fixed, so it is broadcast."""
    small = roster(df.sparkSession, name).withColumnRenamed("region", column)
    return df.join(F.broadcast(small), column, "left")
