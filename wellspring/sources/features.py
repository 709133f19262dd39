"""Line features from GeoJSON, and centroids of feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.constants import LINE_FEATURE_PROPERTIES
from wellspring.functions.survey import line_centroid

_PROPERTIES = ",".join(f"`{p}`: string" for p in LINE_FEATURE_PROPERTIES)
FEATURES_SCHEMA = (
    f"features array<struct<properties: struct<{_PROPERTIES}>,"
    " geometry: struct<type: string, coordinates: array<array<double>>>>>"
)
TEXT_PROPERTIES = [
    c for c in LINE_FEATURE_PROPERTIES.values() if c not in ("segment_number", "length_m")
]


def parse_line_features(pages: DataFrame) -> DataFrame:
    """One row per line feature of GeoJSON pages (column ``value``).

    A line gives its end points, a single point is both; features without
    coordinates are left out. Missing text properties are blank.
    """
    feature = F.explode(F.from_json("value", FEATURES_SCHEMA)["features"])
    rows = pages.select(feature.alias("f")).select("f.*")
    points = F.col("geometry.coordinates")
    ends = {"from": F.get(points, F.lit(0)), "to": F.try_element_at(points, F.lit(-1))}
    named = {
        new: F.col(f"properties.`{old}`") for old, new in LINE_FEATURE_PROPERTIES.items()
    }
    named["length_m"] = named["length_m"].try_cast("double")
    for c in TEXT_PROPERTIES:
        named[c] = F.coalesce(named[c], F.lit(""))
    return rows.where(F.size(points) > 0).select(
        *[c.alias(n) for n, c in named.items()],
        *[
            F.get(point, F.lit(i)).alias(f"{end}_{axis}")
            for end, point in ends.items()
            for i, axis in ((1, "lat"), (0, "lon"))
        ],
        points.alias("coordinates"),
        F.lit("SK").alias("province"),
    )


def read_line_features(spark: SparkSession, path) -> DataFrame:
    """Pages as the feature service delivers them, one JSON document per file."""
    return parse_line_features(spark.read.text(path, wholetext=True))


def feature_centroids(df: DataFrame, coordinates: str = "coordinates") -> DataFrame:
    """Add centroid and length to a table with line coordinates."""
    at = line_centroid(F.col(coordinates))
    return df.withColumns(
        {"centroid_lon": at["lon"], "centroid_lat": at["lat"], "line_length": at["length"]}
    )
