"""Dominion Land Survey geometry as plain Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspring.constants import (
    DEGREES_PER_TOWNSHIP,
    KM_PER_DEGREE_AT_EQUATOR,
    RANGE_WIDTH_KM,
    SURVEY_BASE_LATITUDE,
    SURVEY_BASE_LONGITUDE,
    SURVEY_UWI,
)

SECTION = DEGREES_PER_TOWNSHIP / 6
SUBDIVISION = SECTION / 4


def _position(uwi: Column) -> tuple[Column, Column]:
    text = F.upper(F.trim(uwi))
    # one pass turns a valid UWI into LLSSTTTRRM, which is then cut by position
    digits = F.when(
        text.rlike(SURVEY_UWI), F.regexp_replace(text, SURVEY_UWI, "$2$3$4$5$7")
    )

    def number(start: int, length: int) -> Column:
        return F.substring(digits, start, length).cast("int")

    lsd, section = number(1, 2) - 1, number(3, 2) - 1
    base = F.create_map(*[F.lit(x) for kv in SURVEY_BASE_LONGITUDE.items() for x in kv])
    base_longitude = F.try_element_at(base, number(10, 1))

    # sections snake: odd rows run the other way
    row, column = F.floor(section / 6), F.pmod(section, F.lit(6))
    column = F.when(F.pmod(row, F.lit(2)) == 1, 5 - column).otherwise(column)
    latitude = (
        SURVEY_BASE_LATITUDE
        + (number(5, 3) - 1) * DEGREES_PER_TOWNSHIP
        + (row * SECTION + SECTION / 2)
        + (F.floor(lsd / 4) * SUBDIVISION + SUBDIVISION / 2)
    )
    degrees_per_range = RANGE_WIDTH_KM / (
        KM_PER_DEGREE_AT_EQUATOR * F.cos(F.radians(latitude))
    )
    longitude = (
        base_longitude
        - (number(8, 2) - 1) * degrees_per_range
        - (column * (degrees_per_range / 6) + degrees_per_range / 6 / 2)
        - (F.pmod(lsd, F.lit(4)) * (degrees_per_range / 24) + degrees_per_range / 24 / 2)
    )
    return F.when(base_longitude.isNotNull(), latitude), longitude


def uwi_lat(uwi: Column, digits: int = 6) -> Column:
    """Latitude of the legal subdivision centre; null for unknown patterns."""
    return F.round(_position(uwi)[0], digits)


def uwi_lon(uwi: Column, digits: int = 6) -> Column:
    return F.round(_position(uwi)[1], digits)


def line_centroid(points: Column) -> Column:
    """Length-weighted centroid of a line given as ``array<array<double>>``.

    A line without length (one point, or all points equal) is its first point.
    """
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(points) - 1),
        lambda i: _segment(F.element_at(points, i), F.element_at(points, i + 1)),
    )
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("length", "x", "y")])
    total = F.aggregate(
        F.when(F.size(points) > 1, pairs).otherwise(F.array()),
        zero,
        lambda acc, s: F.struct(
            (acc["length"] + s["length"]).alias("length"),
            (acc["x"] + s["x"] * s["length"]).alias("x"),
            (acc["y"] + s["y"] * s["length"]).alias("y"),
        ),
    )
    first = F.get(points, F.lit(0))
    has_length = total["length"] > 0
    return F.struct(
        F.when(has_length, total["x"] / F.nullif(total["length"], F.lit(0.0)))
        .otherwise(F.get(first, F.lit(0))).alias("lon"),
        F.when(has_length, total["y"] / F.nullif(total["length"], F.lit(0.0)))
        .otherwise(F.get(first, F.lit(1))).alias("lat"),
        total["length"].alias("length"),
    )


def _segment(a: Column, b: Column) -> Column:
    ax, ay, bx, by = (F.get(p, F.lit(i)) for p in (a, b) for i in (0, 1))
    return F.struct(
        F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)).alias("length"),
        ((ax + bx) / 2).alias("x"),
        ((ay + by) / 2).alias("y"),
    )
