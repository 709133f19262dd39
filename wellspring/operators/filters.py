"""Row filters shared by the silver tables and the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def activity(df: DataFrame, code: str = "PROD") -> DataFrame:
    return df.where(F.col("activityid") == code)


def is_producing() -> Column:
    return (F.col("oil_prod_vol") > 0) | (F.col("gas_prod_vol") > 0)


def producing(df: DataFrame) -> DataFrame:
    return df.where(is_producing())


def max_of(df: DataFrame, column: str, where: Column | None = None) -> Column:
    """Scalar subquery: the largest value of a column."""
    rows = df if where is None else df.where(where)
    return rows.select(F.max(column)).scalar()


def latest_month(df: DataFrame, province: str | None = None) -> DataFrame:
    """Rows of the newest production month (of one province, if given)."""
    where = None if province is None else F.col("province") == province
    rows = df if where is None else df.where(where)
    return rows.where(F.col("productionmonth") == max_of(df, "productionmonth", where))


def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.trim(column) != ""))


def within_days(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Rows dated no more than ``days`` before the as-of date."""
    return df.where(F.col(column) >= F.date_sub(as_of, days))


def drop_html(df: DataFrame) -> DataFrame:
    """Drop columns and rows that come from an HTML error page."""
    markup = "(?i)<!doctype|<html"
    bad = [c for c in df.columns if "<!doctype" in c.lower() or "<html" in c.lower()]
    kept = df.drop(*bad)
    text = [c for c, t in kept.dtypes if t == "string"]
    if not text:
        return kept
    return kept.where(~F.coalesce(F.concat_ws(" ", *text).rlike(markup), F.lit(False)))
