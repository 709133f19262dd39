"""Well identifiers and legal locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspring.constants import COMPACT_PREFIX


def format_uwi(raw: Column) -> Column:
    """Compact identifier (``ABWI100010100308W402``) to the display form.

    Anything that is not 16 characters after the prefix passes through, and so
    does an event suffix that is not a number.
    """
    body = F.regexp_replace(raw, COMPACT_PREFIX, "")

    def part(start: int, length: int) -> Column:
        return F.substring(body, start, length)

    event = F.coalesce(part(15, 2).try_cast("int").cast("string"), part(15, 2))
    shown = F.concat(
        part(2, 2), F.lit("/"), part(4, 2), F.lit("-"), part(6, 2), F.lit("-"),
        part(8, 3), F.lit("-"), part(11, 4), F.lit("/"), event,
    )
    return F.when(F.length(body) == 16, shown).otherwise(body)


def normalized_uwi(province: Column, uwi: Column) -> Column:
    """Key that Saskatchewan wells join on; other provinces keep the UWI."""

    def piece(text: Column, separator: str, n: int) -> Column:
        return F.split_part(text, F.lit(separator), F.lit(n))

    legal = piece(uwi, "/", 2)
    key = F.concat(
        F.lit("1"),
        F.lpad(piece(uwi, "/", 1), 2, "0"),
        F.lpad(piece(legal, "-", 1), 2, "0"),
        F.lpad(piece(legal, "-", 2), 2, "0"),
        F.lpad(piece(legal, "-", 3), 3, "0"),
        piece(legal, "-", 4),
        piece(uwi, "/", 3),
        F.lit("0"),
    )
    return F.when((province == "SK") & uwi.contains("/"), key).otherwise(uwi)


def dls(lsd: Column, section: Column, township: Column, rng: Column, meridian: Column):
    """Survey string such as ``01-01-008-16W4``; null if any part is missing."""

    def padded(part: Column, width: int) -> Column:
        text = F.nullif(F.trim(part), F.lit(""))
        return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))

    return F.concat(
        padded(lsd, 2), F.lit("-"), padded(section, 2), F.lit("-"),
        padded(township, 3), F.lit("-"), padded(rng, 2), F.lit("W"),
        padded(meridian, 1),
    )


def sk_uwi(lsd: Column, section: Column, township: Column, rng: Column, meridian: Column):
    """UWI of a Saskatchewan well from its surface location (``W2`` meridians)."""
    bare = F.regexp_replace(F.trim(meridian), "(?i)^W", "")
    return F.concat(F.lit("00/"), dls(lsd, section, township, rng, bare), F.lit("/0"))


def township(uwi: Column) -> Column:
    return F.substring(uwi, 10, 3)


def range_meridian(uwi: Column) -> Column:
    """Range and meridian as published queries cut them (a slash remains)."""
    return F.substring(uwi, 14, 5)


def legal_key(uwi: Column) -> Column:
    """The 11-character location key published queries match wells on."""
    return F.substring(uwi, 4, 11)


def legal_location(uwi: Column) -> Column:
    """The whole legal location, for two- and three-digit exceptions alike."""
    return F.regexp_extract(uwi, r"/(\d{2}-\d{2}-\d{3}-\d{2}W\d)/", 1)
