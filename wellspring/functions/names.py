"""Column names: normalising headers and picking aliased columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import NAME_CAMEL, NAME_SEPARATORS


def normalize_name(name: str) -> str:
    """``Well/Facility ID`` -> ``well_facility_id``."""
    joined = re.sub(NAME_SEPARATORS, "_", name.strip())
    split = re.sub(NAME_CAMEL, r"\1_\2", joined).lower()
    return "_".join(word for word in split.split("_") if word)


def normalize_name_column(name: Column) -> Column:
    """The same rule for header cells that arrive as data."""
    joined = F.regexp_replace(F.trim(name), NAME_SEPARATORS, "_")
    split = F.lower(F.regexp_replace(joined, NAME_CAMEL, "$1_$2"))
    return F.btrim(F.regexp_replace(split, "_+", "_"), F.lit("_"))


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def without_number_prefix(name: str) -> str:
    """``07.StatCurr`` -> ``statcurr``; exports number their headers."""
    bare = re.sub(r"^\d{2}\.", "", name).replace("#", "_no")
    return bare.strip().lower().replace(" ", "_")


def canonicalize(df: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """One column per canonical name, from the aliases that are present.

    Several aliases in one table fill each other's nulls in the listed order;
    a canonical column with no alias present becomes a null string column, so
    the schema never depends on the file. Other columns are kept.
    """
    present = set(df.columns)
    found = {
        target: [c for c in names if c in present] for target, names in aliases.items()
    }
    used = {c for names in found.values() for c in names}
    chosen = [
        (F.coalesce(*names) if names else F.lit(None).cast("string")).alias(target)
        for target, names in found.items()
    ]
    kept = [c for c in df.columns if c not in used and c not in aliases]
    return df.select(*chosen, *kept)


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select([c for c in columns if c in df.columns])


def drop_metadata(df: DataFrame) -> DataFrame:
    """Columns starting with an underscore describe the load, not the record."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])
