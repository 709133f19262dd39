"""Dates, numbers, units and ratios."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import BARRELS_PER_M3, FEET_PER_METRE, MCF_PER_E3M3

VOLUME = "decimal(18,3)"
DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd", "MM/dd/yyyy")


def _as_iso(text: Column, shape: str) -> Column:
    """The text of one shape as ISO digits; null for other lengths or separators."""

    def cut(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    dash = F.lit("-")
    if shape == "yyyyMMdd":
        iso = F.concat(cut(1, 4), dash, cut(5, 2), dash, cut(7, 2))
    elif shape == "MM/dd/yyyy":
        iso = F.when(
            (cut(3, 1) == "/") & (cut(6, 1) == "/"),
            F.concat(cut(7, 4), dash, cut(1, 2), dash, cut(4, 2)),
        )
    elif shape == "yyyy-MM":
        iso = F.concat(text, F.lit("-01"))
    else:
        iso = text
    return F.when(F.length(text) == len(shape), iso)


# The shapes of lenient dates (digit 9, a run of letters a) and
# the pattern that reads each; month-first where day and month could swap.
DATE_SHAPES = {
    "9999/99/99": "yyyy/MM/dd",
    "9999/9/9": "yyyy/M/d",
    "9999/99/9": "yyyy/MM/d",
    "9999/9/99": "yyyy/M/dd",
    "9999-9-9": "yyyy-M-d",
    "9999-99-9": "yyyy-MM-d",
    "9999-9-99": "yyyy-M-dd",
    "9/9/9999": "M/d/yyyy",
    "99/9/9999": "MM/d/yyyy",
    "9/99/9999": "M/dd/yyyy",
    "99-99-9999": "MM-dd-yyyy",
    "9.9.9999": "d.M.yyyy",
    "99.99.9999": "dd.MM.yyyy",
    "a 9, 9999": "MMM d, yyyy",
    "a 99, 9999": "MMM d, yyyy",
    "a 9 9999": "MMM d yyyy",
    "a 99 9999": "MMM d yyyy",
    "9 a 9999": "d MMM yyyy",
    "99 a 9999": "d MMM yyyy",
    "99-a-9999": "dd-MMM-yyyy",
    "9-a-9999": "d-MMM-yyyy",
}
#: Date and time: the date before the time, in any of the shapes above.
TIME_TAIL = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([AaPp][Mm]|Z|[+-]\d{2}:?\d{2})?$"


def _shape(text: Column) -> Column:
    """Digits as 9 and each run of letters as a."""
    return F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]+", "a")


def _by_shape(text: Column) -> Column:
    """The date of a text whose shape is in DATE_SHAPES; one pattern parser per shape."""
    shape = _shape(text)
    chosen = None
    for form, pattern in DATE_SHAPES.items():
        parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("date")
        if "MMM" in pattern:  # short and long month names
            parsed = F.coalesce(parsed, F.try_to_timestamp(text, F.lit(pattern.replace("MMM", "MMMM"))).cast("date"))
        chosen = (F.when(shape == form, parsed) if chosen is None else chosen.when(shape == form, parsed))
    return chosen


def coerce_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First of ``formats`` that fits, else a lenient form; null for anything else.

    The listed formats are rearranged and cast, because a pattern parser pays
    an exception for every value that does not fit. Other texts are classed by
    their shape (digits 9, letter runs a): a date and time counts by its date,
    and a shape of ``DATE_SHAPES`` picks the one pattern that reads it; unknown
    shapes are null without any parser.
    """
    trimmed = F.trim(text)
    day = F.regexp_replace(trimmed, TIME_TAIL, "")
    fast = [_as_iso(t, f).try_cast("date") for t in (trimmed, day) for f in formats]
    return F.coalesce(*fast, _by_shape(day))


def coerce_dates(
    df: DataFrame, columns: Iterable[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Coerce those of the listed text columns that exist; dates stay dates."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: coerce_date(F.col(c), formats)
            if types[c] == "string"
            else F.col(c).cast("date")
            for c in columns
            if c in types
        }
    )


def coerce_num(text: Column) -> Column:
    """Volume as an exact decimal; anything unreadable counts as zero."""
    return F.coalesce(F.trim(text.cast("string")).try_cast(VOLUME), F.lit(0).cast(VOLUME))


def to_imperial(df: DataFrame) -> DataFrame:
    """Add imperial columns next to the metric ones the table has."""
    factors = {
        "oil_prod_vol": ("oil_bbl", BARRELS_PER_M3),
        "water_prod_vol": ("water_bbl", BARRELS_PER_M3),
        "gas_prod_vol": ("gas_mcf", MCF_PER_E3M3),
        "total_depth": ("total_depth_ft", FEET_PER_METRE),
    }
    return df.withColumns(
        {
            new: F.col(old).cast("decimal(28,3)") * F.lit(factor).cast("decimal(9,5)")
            for old, (new, factor) in factors.items()
            if old in df.columns
        }
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def month_start(month: Column) -> Column:
    """``2026-01`` -> DATE 2026-01-01."""
    return F.try_to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")


def months_crossed(start: Column, end: Column) -> Column:
    """Month boundaries between two dates (not whole months)."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
