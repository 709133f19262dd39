"""Text clean-up: keys, operator names, labels, encodings, file names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import (
    OPERATOR_SPELLINGS,
    STATISTICS_PRODUCTS,
)


def _cp1252_beyond_latin1() -> dict[str, str]:
    """Latin-1 control characters and what the same bytes mean in cp1252."""
    found = {}
    for byte in range(0x80, 0xA0):
        try:
            found[chr(byte)] = bytes([byte]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return found


CP1252 = _cp1252_beyond_latin1()


def clean_key(key: Column) -> Column:
    """Trimmed key; blank text and the text ``nan`` are real nulls."""
    trimmed = F.trim(key)
    return F.when(~trimmed.isin("", "nan", "None"), trimmed)


def trim_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Clean those of the listed columns that exist; apply before joining."""
    wanted = [c for c in columns if c in df.columns]
    return df.withColumns({c: clean_key(F.col(c)) for c in wanted})


def normalize_operator(name: Column) -> Column:
    out = F.coalesce(name, F.lit(""))
    for pattern, replacement in OPERATOR_SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.upper(F.trim(out))


def first_word(text: Column) -> Column:
    """First whitespace-separated word, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"^\s*(\S+)", 1), F.lit(""))


def first_token(text: Column) -> Column:
    """Text before the first single space, upper case (blank if it leads)."""
    return F.upper(F.trim(F.split_part(text, F.lit(" "), F.lit(1))))


def status_label(active: Column) -> Column:
    return F.when(active, "Active").when(~active, "Inactive")


def file_date(name: Column) -> Column:
    """``2026-02-21_Report.csv`` -> DATE; null without a date."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def file_period(name: Column) -> Column:
    """Year or year-month in a file name, as text."""
    found = F.regexp_extract(name, r"(\d{4}(-\d{2})?)", 1)
    return F.nullif(found, F.lit(""))


def file_year(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(\d{4})", 1), F.lit(""))


def file_product(name: Column) -> Column:
    """Product named in a statistics file; price files get a suffix."""
    lowered = F.lower(name)
    product = F.coalesce(
        *[F.when(lowered.contains(p), F.lit(p)) for p in STATISTICS_PRODUCTS],
        F.lit("unknown"),
    )
    return F.when(lowered.contains("prices"), F.concat(product, F.lit("_prices"))).otherwise(
        product
    )


def decode_text(raw: Column, encoding: Column | None = None) -> Column:
    """Bytes read as UTF-8 text, re-read in the right encoding.

    ``encoding`` is the choice made for the whole file (see
    ``sources.lines``); without it each value is judged on its own.
    """
    data = raw.cast("binary")
    if encoding is None:
        encoding = best_encoding(F.is_valid_utf8(raw), ~has_undefined_cp1252(raw))
    latin = F.decode(data, "ISO-8859-1")
    text = (
        F.when(encoding == "utf-8", raw)
        .when(encoding == "cp1252", F.translate(latin, "".join(CP1252), "".join(CP1252.values())))
        .otherwise(latin)
    )
    return F.regexp_replace(text, "^﻿", "")


def has_undefined_cp1252(raw: Column) -> Column:
    """Five byte values have no meaning in that code page."""
    return F.hex(raw.cast("binary")).rlike("^(..)*(81|8D|8F|90|9D)")


def best_encoding(valid_utf8: Column, valid_cp1252: Column) -> Column:
    return (
        F.when(valid_utf8, "utf-8").when(valid_cp1252, "cp1252").otherwise("latin-1")
    )
