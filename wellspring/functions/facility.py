"""Facility classification from free text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import (
    FACILITY_CLASS_DEFAULT,
    FACILITY_CLASSES,
    FACILITY_COMMODITIES,
    FACILITY_COMMODITY_DEFAULT,
    FACILITY_GROUP_DEFAULT,
    FACILITY_GROUPS,
    FACILITY_TEXT_COLUMNS,
)


def facility_text(df: DataFrame) -> Column:
    """The best text column the table has; blank when there is none."""
    column = next((c for c in FACILITY_TEXT_COLUMNS if c in df.columns), None)
    return F.coalesce(F.col(column), F.lit("")) if column else F.lit("")


def _label(text: Column, rules, default: str) -> Column:
    """First rule for which each word set has a word in the text."""
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def holds(word_sets) -> Column:
        any_word = [
            reduce(Column.__or__, [lowered.contains(w) for w in words])
            for words in word_sets
        ]
        return reduce(Column.__and__, any_word)

    return F.coalesce(
        *[F.when(holds(word_sets), F.lit(label)) for label, word_sets in rules],
        F.lit(default),
    )


def facility_class(text: Column) -> Column:
    return _label(text, FACILITY_CLASSES, FACILITY_CLASS_DEFAULT)


def facility_commodity(text: Column) -> Column:
    return _label(text, FACILITY_COMMODITIES, FACILITY_COMMODITY_DEFAULT)


def facility_group(cls: Column) -> Column:
    pairs = [(c, group) for group, classes in FACILITY_GROUPS.items() for c in classes]
    lookup = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.coalesce(F.try_element_at(lookup, cls), F.lit(FACILITY_GROUP_DEFAULT))


def classify(df: DataFrame) -> DataFrame:
    """Add class, group and commodity to a facility table."""
    text = facility_text(df)
    return df.withColumns(
        {"facility_class": facility_class(text), "facility_commodity": facility_commodity(text)}
    ).withColumn("facility_group", facility_group(F.col("facility_class")))
